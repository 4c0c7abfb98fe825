"""Exact top-k by inner product with a KD-tree per shard.

Vectors are dealt to shards of about 4,096 by a hash of their id. Each shard becomes a tree:
median splits along the widest side, tight boxes, leaves of 256. A block of queries visits
one shard first; the k-th score found there goes with the block to all other shards. In a
tree a query goes best first: the largest inner product any point of a box can have decides
the order, and boxes that cannot reach the k-th score are never opened. Boxes that only tie
are opened, because ties go to smaller ids.

Edge cases: vectors that are NULL, empty, or hold NULL or non-finite components, and rows
with a NULL id, take no part; only vectors of one length meet; a query with fewer than k
others gets all of them; a row never finds its own id; an empty table gives an empty result;
repeated ids are candidates as often as they occur, but never for a query with that id; equal
query rows have one list, query rows with one id and other vectors a list each; further
columns are dropped.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verisift.llm.lets import require
from verisift.session import scratch_path

SHARD_ROWS = 4096
BLOCK_ROWS = 512
LEAF_ROWS = 256


def quantised(vectors: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """vec_id and floor(scale * x) of every usable vector, with its length."""
    require(vectors, id_column, vector_column)
    v = F.col(vector_column)
    usable = (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    whole = F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return vectors.filter(F.col(id_column).isNotNull() & v.isNotNull() & F.coalesce(usable, F.lit(False))).select(
        F.col(id_column).cast("long").alias("vec_id"), whole.alias("v"), F.size(v).alias("dim")
    )


class Tree:
    """A KD-tree over integer points, flat arrays only."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF_ROWS):
        order = np.argsort(ids, kind="stable")
        self.low, self.high, self.kids, self.span, self.first = [], [], [], [], []
        self.order, self.points = order, points
        self._ids = ids
        self._split(0, len(ids), leaf)
        self.ids, self.points = ids[self.order], points[self.order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _split(self, begin: int, end: int, leaf: int) -> int:
        own = self.points[self.order[begin:end]]
        node = len(self.kids)
        low, high = own.min(axis=0), own.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.span.append((begin, end))
        self.first.append(int(self._ids[self.order[begin:end]].min()))
        self.kids.append(None)
        if end - begin > leaf and (high > low).any():
            axis = int(np.argmax(high - low))
            middle = (end - begin) // 2
            part = np.argpartition(own[:, axis], middle)
            self.order[begin:end] = self.order[begin:end][part]
            left = self._split(begin, begin + middle, leaf)
            self.kids[node] = (left, self._split(begin + middle, end, leaf))
        return node

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, least: list[tuple[int, int] | None]):
        """The best k of this shard for each query, as lists of (score, id); ``least`` is the
        (score, id) of the k-th found elsewhere."""
        exact = float(np.abs(queries).max()) * float(max(np.abs(self.low).max(), np.abs(self.high).max())) * queries.shape[1]
        kind = np.float64 if exact < 2**53 else np.int64
        points, q = self.points.astype(kind), queries.astype(kind)
        most = np.maximum(q, 0) @ self.high.T.astype(kind) + np.minimum(q, 0) @ self.low.T.astype(kind)
        for row, own in enumerate(ids):
            bounds, known = most[row].tolist(), least[row]
            # worst of the best k first; larger ids are worse at equal scores
            best: list[tuple[float, int]] = []
            todo = [(-bounds[0], 0)]
            while todo:
                bound, node = heapq.heappop(todo)
                worst = best[0] if len(best) == k else None
                limit = max((x for x in (worst, (known[0], -known[1]) if known else None) if x), default=None)
                if limit and -bound < limit[0]:
                    break
                if limit and -bound == limit[0] and -self.first[node] < limit[1]:
                    continue
                if self.kids[node]:
                    for kid in self.kids[node]:
                        heapq.heappush(todo, (-bounds[kid], kid))
                    continue
                begin, end = self.span[node]
                scores = points[begin:end] @ q[row]
                near = np.flatnonzero(scores >= limit[0]) if limit else np.arange(end - begin)
                # every row with the query's id goes before the best are cut off
                near = near[self.ids[begin:end][near] != own]
                if len(near) > k:
                    near = near[np.lexsort((self.ids[begin:end][near], -scores[near]))[:k]]
                for at in near.tolist():
                    found = (int(scores[at]), -int(self.ids[begin + at]))
                    if known and found < (known[0], -known[1]):
                        continue
                    if len(best) < k:
                        heapq.heappush(best, found)
                    elif found > best[0]:
                        heapq.heapreplace(best, found)
            yield [(score, -minus) for score, minus in best]


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _trees(rows: DataFrame) -> DataFrame:
    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(group["vec_id"].to_numpy(), np.stack(group["v"].to_numpy()).astype(np.int64))
        return pd.DataFrame({"dim": group["dim"].iloc[:1], "shard": group["shard"].iloc[:1], "tree": [pickle.dumps(tree)]})

    return rows.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, tree binary")


def _blocks(rows: DataFrame) -> DataFrame:
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        data = (group["vec_id"].to_numpy(), group["name"].to_numpy(), np.stack(group["v"].to_numpy()).astype(np.int64))
        return pd.DataFrame({"dim": group["dim"].iloc[:1], "block": group["block"].iloc[:1], "queries": [pickle.dumps(data)]})

    return rows.groupBy("dim", "block").applyInPandas(pack, "dim int, block int, queries binary")


def _visit(met: DataFrame, k: int) -> DataFrame:
    """One row per block and shard: the packed results of its queries."""

    def run(batches):
        for frame in batches:
            for row in frame.itertuples(index=False):
                ids, names, queries = pickle.loads(row.queries)
                known = pickle.loads(row.known) if row.known is not None else [None] * len(ids)
                found = list(pickle.loads(row.tree).search(ids, queries, k, known)) if row.tree is not None else [[]] * len(ids)
                yield pd.DataFrame({"dim": [row.dim], "block": [row.block], "found": [pickle.dumps((ids, names, found))]})

    return met.select("dim", "block", "queries", "known", "tree").mapInPandas(run, "dim int, block int, found binary")


def _kth(found: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for frame in batches:
            for row in frame.itertuples(index=False):
                _, _, lists = pickle.loads(row.found)
                known = [min(((s, -i) for s, i in best), default=None) if len(best) == k else None for best in lists]
                known = [None if x is None else (x[0], -x[1]) for x in known]
                yield pd.DataFrame({"dim": [row.dim], "block": [row.block], "known": [pickle.dumps(known)]})

    return found.mapInPandas(run, "dim int, block int, known binary")


def _spread(found: DataFrame) -> DataFrame:
    def run(batches):
        for frame in batches:
            for packed in frame["found"]:
                ids, names, lists = pickle.loads(packed)
                rows = [(int(q), int(n), i, s) for q, n, best in zip(ids, names, lists, strict=True) for s, i in best]
                yield pd.DataFrame(rows, columns=["query_id", "name", "vec_id", "score"]).astype("int64")

    return found.select("found").mapInPandas(run, "query_id long, name long, vec_id long, score long")


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 64.0,
) -> DataFrame:
    """query_id, rank, vec_id and score of the best k candidates of every query."""
    rows = quantised(vectors, id_column, vector_column, scale)
    asked = quantised(queries, id_column, vector_column, scale).dropDuplicates(["vec_id", "v"])
    asked = asked.withColumn("name", F.xxhash64("vec_id", "v"))
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    n_blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    place = F.xxhash64("vec_id")
    trees = _saved(_trees(rows.withColumn("shard", F.pmod(place, F.lit(shards)).cast("int"))), "topk-trees")
    blocks = _saved(_blocks(asked.withColumn("block", F.pmod(place, F.lit(n_blocks)).cast("int"))), "topk-blocks")
    home = F.col("block") % shards
    near = blocks.withColumn("shard", home).join(trees, ["dim", "shard"], "left")
    first = _saved(_visit(near.withColumn("known", F.lit(None).cast("binary")), k), "topk-first")
    known = blocks.join(_kth(first, k), ["dim", "block"])
    far = known.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter(F.col("shard") != home)
    rest = _visit(far.repartition(F.col("block"), F.col("shard")).join(trees, ["dim", "shard"]), k)
    best = Window.partitionBy("query_id", "name").orderBy(F.col("score").desc(), "vec_id")
    ranked = _spread(first.unionByName(rest)).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
