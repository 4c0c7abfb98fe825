"""A random forest for two classes, grown level by level from sums over bins.

Features are cut into bins at exact quantiles. Rows with equal bins, class and weight are one
row with a number; a bootstrap of so many rows takes a Poisson number of them, so nothing is
lost by folding them and a large table is no more rows than its bins allow. A level of all
trees is one job: every partition sums the rows and weights drawn for a tree by node, feature,
bin and class; the sums of a tree are added and only the splits found in them reach the driver.
Where the folded rows fit one task, a task grows whole trees, from the same sums.

A row's probability depends on its bins alone. Where the cuts allow few enough of them, every
combination of bins is scored once and a row looks its own up.

Draws come from the seed, the tree and the block of a row, a hash of it, and the weights are
rounded to multiples of a power of two that keeps all sums exact in doubles. The forest
depends on the rows alone, not on partitions, order or machine.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from verisift.functions.running import exact_quantiles
from verisift.models.boosting import _NEVER, _added, _grid, _route

#: Rows of a block, and of a partition where there are more cores than partitions.
BLOCK_ROWS, PARTITION_ROWS = 1 << 16, 1 << 18
#: Folded rows from which whole trees are grown in a task, and combinations of bins that are scored once.
WHOLE_ROWS, MOST_CELLS = 1 << 21, 1 << 22
Block = tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class _Columns(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol):
    pass


class ForestModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Complete binary trees in heap order; a row goes right where its value is above the cut.

    A leaf has the share of class 1; the probability is its mean over the trees.
    """

    feature = Param(Params._dummy(), "feature", "feature by tree and inner node")
    cut = Param(Params._dummy(), "cut", "highest value that goes left, by tree and inner node; null: any")
    leaf = Param(Params._dummy(), "leaf", "share of class 1 by tree and leaf")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        feature, leaf = (np.array(self.getOrDefault(p)) for p in (self.feature, self.leaf))
        cut = np.array([[math.inf if c is None else c for c in tree] for tree in self.getOrDefault(self.cut)])
        cuts = cut < math.inf
        used = sorted(set(feature[cuts].tolist()))
        edges = [np.unique(cut[cuts & (feature == f)]) for f in used]
        cells = math.prod(len(e) + 1 for e in edges)
        table = _cells(feature, cut, leaf, used, edges) if cells <= MOST_CELLS else None
        shared = dataset.sparkSession.sparkContext.broadcast((feature, cut, leaf, used, edges, table))

        @F.pandas_udf("double")
        def share(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                # a single column arrives without its tuple
                parts = columns if isinstance(columns, tuple) else (columns,)
                yield pd.Series(_shares([c.to_numpy(dtype=float) for c in parts], *shared.value))

        probability, prediction = self.getProbabilityCol(), self.getPredictionCol()
        values = f"{self.uid}_values"
        found = dataset.withColumn(values, vector_to_array(self.getFeaturesCol()))
        # a forest without a cut reads one value to have a column
        found = found.withColumn(probability, share(*[F.col(values)[f] for f in used or [0]])).drop(values)
        return found.withColumns(
            {
                prediction: (F.col(probability) > 0.5).cast("double"),
                probability: array_to_vector(F.array(1 - F.col(probability), F.col(probability))),
            }
        )


class Forest(Estimator, _Columns, HasWeightCol, HasSeed):
    """Classes 0 and 1; the parameters have the names, meanings and defaults of MLlib's forest.

    Nodes choose among ``ceil(sqrt(features))`` features by the loss of Gini impurity.
    """

    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "fewest rows of a node", TypeConverters.toInt)
    minInfoGain = Param(Params._dummy(), "minInfoGain", "least gain of a split", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "rows drawn for a tree, as a share", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction",
        probabilityCol: str = "probability", weightCol: str | None = None, seed: int = 0, numTrees: int = 20,
        maxDepth: int = 5, maxBins: int = 32, minInstancesPerNode: int = 1, minInfoGain: float = 0.0, subsamplingRate: float = 1.0,
    ):
        super().__init__()
        self._setDefault(
            seed=0, numTrees=20, maxDepth=5, maxBins=32, minInstancesPerNode=1, minInfoGain=0.0, subsamplingRate=1.0
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ForestModel:
        weight = F.col(self.getWeightCol()).cast("double") if self.isDefined(self.weightCol) else F.lit(1.0)
        bad_weight = F.raise_error(F.lit("weights must not be NULL or negative")).cast("double")
        rows = dataset.select(
            vector_to_array(self.getFeaturesCol()).alias("x"),
            F.coalesce(F.col(self.getLabelCol()).cast("boolean"), F.raise_error(F.lit("labels must not be NULL"))).alias("label"),
            F.when(weight >= 0, weight).otherwise(bad_weight).alias("weight"),
        ).where("weight > 0").persist()
        known = rows.agg(F.max(F.size("x")).alias("features"), F.sum("weight").alias("weight")).first()
        if not known["features"]:
            raise ValueError("training needs rows")
        names = [f"x{i}" for i in range(known["features"])]
        columns = rows.select(*[F.col("x")[i].alias(c) for i, c in enumerate(names)])
        quantiles = exact_quantiles(columns, names, self.getOrDefault(self.maxBins))
        edges = [np.array(quantiles.get(c) or [], float) for c in names]
        blocks = _blocks(rows, edges, _grid(4.0 * known["weight"])).persist(StorageLevel.MEMORY_AND_DISK)
        feature, cut, leaf = self._grown(blocks, len(names))
        for held in (blocks, rows):
            held.unpersist()

        def threshold(f: int, c: int) -> float | None:
            return float(edges[f][c - 1]) if c <= len(edges[f]) else None

        model = ForestModel()
        for param in (self.featuresCol, self.labelCol, self.predictionCol, self.probabilityCol):
            model._set(**{param.name: self.getOrDefault(param)})
        cuts = [[threshold(f, c) for f, c in zip(fs, cs)] for fs, cs in zip(feature.tolist(), cut.tolist())]
        return model._set(feature=feature.tolist(), cut=cuts, leaf=leaf.tolist())

    def _grown(self, blocks: RDD, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features, cuts (as bins) and leaves of all trees, a job per level."""
        trees, depth, seed, bins, least, gain, rate = (
            self.getOrDefault(p)
            for p in (
                self.numTrees, self.maxDepth, self.seed, self.maxBins, self.minInstancesPerNode, self.minInfoGain,
                self.subsamplingRate,
            )
        )
        some = math.ceil(math.sqrt(features)) if trees > 1 else features
        context = blocks.context
        if blocks.map(lambda block: len(block[2])).sum() <= WHOLE_ROWS:
            one = blocks.coalesce(1).persist(StorageLevel.MEMORY_AND_DISK)
            one.count()
            shares = min(trees, context.defaultParallelism)

            def whole(part: Iterable[Block], first: int) -> Iterator[tuple]:
                held = list(part)
                for tree in range(first, trees, shares):
                    yield tree, *_tree(held, tree, depth, features, some, bins + 2, seed, rate, least, gain)

            grown = context.union([one.mapPartitions(lambda part, first=first: whole(part, first)) for first in range(shares)])
            _, *found = zip(*sorted(grown.collect(), key=lambda r: r[0]))
            one.unpersist()
            return tuple(np.array(column) for column in found)
        inner = (1 << depth) - 1
        feature, cut = np.zeros((trees, inner), np.int64), np.full((trees, inner), _NEVER, np.int64)
        opened, value = np.ones((trees, 1), bool), np.zeros((trees, 1))
        for level in range(max(depth, 1)):
            found = (feature, cut, opened)

            def sums(part: Iterable[Block], level=level, found=found) -> Iterator[tuple[int, np.ndarray]]:
                held = list(part)
                for tree in range(trees):
                    picks = _picks(seed, tree, level, features, some)
                    total = None
                    for block in held:
                        total = _added(total, _sums(block, tree, level, picks, tuple(f[tree] for f in found), bins + 2, seed, rate))
                    if total is not None:
                        yield tree, total

            def best(pair: tuple[int, np.ndarray], level=level) -> tuple:
                tree, total = pair
                return tree, *_best(total, _picks(seed, tree, level, features, some), least, gain)

            parts = blocks.getNumPartitions()
            splits = sorted(blocks.mapPartitions(sums).reduceByKey(_added, parts).map(best).collect(), key=lambda r: r[0])
            _, chosen, at, own, sides = (np.array(column) for column in zip(*splits))
            if not level:
                value = own
            split = opened & (chosen >= 0) if depth else np.zeros_like(opened)
            if depth:
                here = slice((1 << level) - 1, (1 << (level + 1)) - 1)
                feature[:, here], cut[:, here] = np.where(split, chosen, 0), np.where(split, at, _NEVER)
                # children of a node without a split have its value
                value = np.where(split[..., None], sides, value[..., None]).reshape(trees, -1)
                opened = np.repeat(split, 2, axis=1)
        return feature, cut, value


def _cells(feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray, used: list[int], edges: list[np.ndarray]) -> np.ndarray:
    """The sum over the trees for every combination of bins of the used features, bins between the edges."""
    total, inner = np.zeros([len(e) + 1 for e in edges]), feature.shape[1]
    axis = {f: i for i, f in enumerate(used)}
    whole = tuple((0, n) for n in total.shape)
    for features, cuts, leaves in zip(feature.tolist(), cut.tolist(), leaf.tolist()):
        open_ = [(0, whole)]
        while open_:
            at, box = open_.pop()
            if at >= inner:
                total[tuple(slice(*side) for side in box)] += leaves[at - inner]
            elif cuts[at] == math.inf:  # nothing is above
                open_.append((2 * at + 1, box))
            else:
                i = axis[features[at]]
                low, high = box[i]
                middle = int(np.searchsorted(edges[i], cuts[at])) + 1
                if low < middle:
                    open_.append((2 * at + 1, (*box[:i], (low, min(high, middle)), *box[i + 1 :])))
                if middle < high:
                    open_.append((2 * at + 2, (*box[:i], (max(low, middle), high), *box[i + 1 :])))
    return total


def _shares(columns, feature, cut, leaf, used, edges, table) -> np.ndarray:
    """The mean share of class 1 over the trees, of rows given by the columns of the used features.

    A missing value goes left everywhere, as it is above no cut.
    """
    n, inner = len(columns[0]), feature.shape[1]
    if table is not None:
        at = np.zeros(n, np.int64)
        for x, e in zip(columns, edges):
            at = at * (len(e) + 1) + np.where(np.isnan(x), 0, np.searchsorted(e, x, side="left"))
        return table.ravel().take(at) / len(feature)
    total, flat = np.zeros(n), np.concatenate(columns)
    place = np.zeros(max(used) + 1, np.int64)
    place[used] = np.arange(len(used)) * n
    rows = np.arange(n)
    for f, c, v in zip(feature, cut, leaf):
        at, start = np.zeros(n, np.int64), place.take(f)
        for _ in range(int(inner + 1).bit_length() - 1):
            at = 2 * at + 1 + (flat.take(start.take(at) + rows) > c.take(at))
        total += v.take(at - inner)
    return total / len(feature)


def _blocks(rows: DataFrame, edges: list[np.ndarray], grid: float) -> RDD:
    """Blocks (number, bins by feature, class, weight, count) of rows folded by equal values."""

    kind = np.uint8 if max(map(len, edges)) < 255 else np.uint16
    sizes = [len(e) + 2 for e in edges]

    def found_in(columns) -> np.ndarray:
        return np.array([np.searchsorted(e, c, side="left") + 1 for c, e in zip(columns, edges)], kind)

    def packed_rows(found: np.ndarray) -> pd.Series:
        return pd.Series([row.tobytes() for row in np.ascontiguousarray(found.T)])

    @F.pandas_udf("binary")
    def binned(*x: pd.Series) -> pd.Series:
        return packed_rows(found_in(x))

    # one number for all bins of a row, where it fits, is folded faster than bytes
    @F.pandas_udf("long")
    def numbered(*x: pd.Series) -> pd.Series:
        code = np.zeros(len(x[0]), np.int64)
        for column, size in zip(found_in(x), sizes):
            code = code * size + column
        return pd.Series(code)

    @F.pandas_udf("binary")
    def unnumbered(code: pd.Series) -> pd.Series:
        return packed_rows(np.array(np.unravel_index(code.to_numpy(np.int64), sizes), kind).reshape(len(sizes), -1))

    weight, values = F.rint(F.col("weight") * grid) / grid, [F.col("x")[i] for i in range(len(edges))]
    short = math.prod(sizes) < 1 << 62
    folded = rows.select((numbered if short else binned)(*values).alias("bins"), "label", weight.alias("weight"))
    folded = folded.groupBy("bins", "label", "weight").agg(F.count(F.lit(1)).alias("n"))
    folded = (folded.withColumn("bins", unnumbered("bins")) if short else folded).persist()
    n = folded.count()

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["bins", "label", "weight"])
        arrays = [part["label"].to_numpy(bool), part["weight"].to_numpy(float), part["n"].to_numpy(np.int64)]
        packed = {"block": part["block"].iloc[:1].tolist(), "bins": [b"".join(part["bins"])]}
        return pd.DataFrame(packed | {c: [a.tobytes()] for c, a in zip(("label", "weight", "n"), arrays)})

    def unpack(row) -> Block:
        bins = np.frombuffer(row["bins"], kind).reshape(-1, len(edges)).T.copy()
        return row["block"], bins, np.frombuffer(row["label"], bool), np.frombuffer(row["weight"]), np.frombuffer(row["n"], np.int64)

    block = F.pmod(F.xxhash64("bins", "label", "weight"), F.lit(-(-n // BLOCK_ROWS)))
    kinds = "block long, bins binary, label binary, weight binary, n binary"
    packed = folded.withColumn("block", block).groupBy("block").applyInPandas(pack, kinds)
    parts = min(-(-n // PARTITION_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    blocks = packed.repartition(parts).rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
    blocks.count()
    folded.unpersist()
    return blocks


def _picks(seed: int, tree: int, level: int, features: int, some: int) -> np.ndarray:
    """The features that each node of a level may split on."""
    draw = np.random.default_rng([seed & (2**63 - 1), tree, level, 1]).random((1 << level, features))
    return draw.argsort(axis=1)[:, :some]


@functools.cache
def _single(rate: float) -> np.ndarray:
    """Poisson numbers of a row, by 16 random bits."""
    chances = np.cumsum([math.exp(-rate) * rate**k / math.factorial(k) for k in range(20)])
    return np.searchsorted(chances, (np.arange(1 << 16) + 0.5) / (1 << 16))


def _drawn(rng: np.random.Generator, count: np.ndarray, rate: float) -> np.ndarray:
    """Poisson numbers with the mean ``rate * count``."""
    drawn = _single(rate).take(rng.integers(0, 1 << 16, len(count), np.uint16))
    more = np.flatnonzero(count > 1)
    drawn[more] = rng.poisson(rate * count[more])
    return drawn


def _sums(block: Block, tree: int, level: int, picks: np.ndarray, found, bins: int, seed: int, rate: float) -> np.ndarray:
    """Rows drawn and their weight, by node, picked feature, bin and class."""
    number, columns, label, weight, count = block
    feature, cut, opened = found
    drawn = _drawn(np.random.default_rng([seed & (2**63 - 1), tree, number, 2]), count, rate)
    taken = np.flatnonzero(drawn)
    at = _route(columns[:, taken], feature, cut, level) - (len(picks) - 1)
    alive = opened.take(at)
    taken, at = taken[alive], at[alive]
    return _sums_of(block, taken, at, drawn.take(taken).astype(float), picks, bins)


def _sums_of(block: Block, taken: np.ndarray, at: np.ndarray, times: np.ndarray, picks: np.ndarray, bins: int) -> np.ndarray:
    """Rows and their weight, of the rows ``taken`` so many times in the nodes ``at``."""
    _, columns, label, weight, _ = block
    (nodes, some), flat = picks.shape, columns.ravel()
    second, of_class = label.take(taken), [weight[label == c] for c in (False, True)]
    same = all(w.size == 0 or w.min() == w.max() for w in of_class)
    kinds = (times,) if same else (times, times * weight.take(taken))
    out = np.zeros((2, nodes * some * bins * 2))
    for k in range(some):
        value = flat.take(picks[:, k].take(at) * columns.shape[1] + taken)
        cell = ((at * some + k) * bins + value) * 2 + second
        for i, values in enumerate(kinds):
            out[i] += np.bincount(cell, values, out.shape[1])
    out = out.reshape(2, nodes, some, bins, 2)
    if same:  # one weight per class, so the weights need no sums of their own
        out[1] = out[0] * [w[:1].sum() for w in of_class]
    return out


def _tree(held: list[Block], tree: int, depth: int, features: int, some: int, bins: int, seed: int, rate: float, least: int, gain: float):
    """One tree from all rows: what the levels of ``Forest._grown`` find, with one draw and one step down a level."""
    inner = (1 << depth) - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, _NEVER, np.int64)
    opened, value, rows = np.ones(1, bool), np.zeros(1), []
    for block in held:
        drawn = _drawn(np.random.default_rng([seed & (2**63 - 1), tree, block[0], 2]), block[4], rate)
        taken = np.flatnonzero(drawn)
        rows.append((taken, np.zeros(len(taken), np.int64), drawn.take(taken).astype(float)))
    for level in range(max(depth, 1)):
        picks, total = _picks(seed, tree, level, features, some), None
        for block, mine in zip(held, rows):
            total = _added(total, _sums_of(block, *mine, picks, bins))
        chosen, at, own, sides = _best(total, picks, least, gain)
        if not level:
            value = own
        if not depth:
            break
        split = opened & (chosen >= 0)
        here = slice((1 << level) - 1, (1 << (level + 1)) - 1)
        feature[here], cut[here] = np.where(split, chosen, 0), np.where(split, at, _NEVER)
        value, opened = np.where(split[:, None], sides, value[:, None]).ravel(), np.repeat(split, 2)
        for i, (block, (taken, node, times)) in enumerate(zip(held, rows)):
            alive = split.take(node)
            taken, node, times = taken[alive], node[alive], times[alive]
            above = block[1].ravel().take(chosen.take(node) * block[1].shape[1] + taken) > at.take(node)
            rows[i] = (taken, 2 * node + above, times)
    return feature, cut, value


def _best(sums: np.ndarray, picks: np.ndarray, least: int, gain: float):
    """Per node the feature (-1 without a split) and bin of the best cut, its share of class 1,
    and the shares left and right of the cut."""
    left = sums.cumsum(axis=3)
    whole = left[:, :, :1, -1:]
    right = whole - left

    def impurity(w: np.ndarray) -> np.ndarray:
        total = w.sum(axis=-1)
        return total - np.divide((w * w).sum(axis=-1), total, out=np.zeros_like(total), where=total > 0)

    def share(w: np.ndarray) -> np.ndarray:
        total = w.sum(axis=-1)
        return np.divide(w[..., 1], total, out=np.zeros_like(total), where=total > 0)

    weight = np.maximum(whole[1].sum(axis=-1), 1e-300)
    won = (impurity(whole[1]) - impurity(left[1]) - impurity(right[1])) / weight
    enough = (left[0].sum(axis=-1) >= max(least, 1)) & (right[0].sum(axis=-1) >= max(least, 1))
    won = np.where(enough, won, -1.0)
    nodes, _, bins = won.shape
    flat = won.reshape(nodes, -1)
    best, n = flat.argmax(axis=1), np.arange(nodes)
    pick, cut = np.divmod(best, bins)
    split = flat[n, best] > max(gain, 1e-12)
    sides = np.stack([share(left[1])[n, pick, cut], share(right[1])[n, pick, cut]], axis=1)
    return np.where(split, picks[n, pick], -1), cut, share(whole[1])[:, 0, 0], sides
