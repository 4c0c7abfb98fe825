"""Leakage detection: an isolation forest grown and applied in Spark tasks.

Follows the published algorithm (Liu, Ting and Zhou, 2008): each tree isolates the
rows of a small random sample; a row's score is 2^(-E[path length]/c(sample size)).
Trees see a fixed number of rows whatever the size of the table, so each is grown
in one small group, and the forest is a bounded object shipped to the scoring tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from verisift.functions.audit import stamp_audit
from verisift.functions.running import value_at_share
from verisift.session import scratch_path

# Default size of the model.
DEFAULTS = {"n_trees": 200, "contamination": 0.05, "sample_size": 256, "seed": 42}
EULER = 0.5772156649015329

NODES = "tree INT, feature ARRAY<INT>, cut ARRAY<DOUBLE>, left ARRAY<INT>, right ARRAY<INT>, depth ARRAY<DOUBLE>"


@dataclass(frozen=True)
class IsolationForest:
    feature_cols: tuple[str, ...]
    trees: tuple[Mapping[str, np.ndarray], ...]
    sample_size: int
    offset: float = 0.0
    metrics: Mapping[str, float] = field(default_factory=dict)

    def save(self, path: str) -> None:
        """One row per tree, as Parquet."""
        head = (list(self.feature_cols), self.sample_size, self.offset, dict(self.metrics))
        rows = [
            (i, *[t[c].tolist() for c in ("feature", "cut", "children", "depth")], *head) for i, t in enumerate(self.trees)
        ]
        kinds = (
            "tree INT, feature ARRAY<BIGINT>, cut ARRAY<DOUBLE>, children ARRAY<BIGINT>, depth ARRAY<DOUBLE>, "
            "feature_cols ARRAY<STRING>, sample_size INT, offset DOUBLE, metrics MAP<STRING, DOUBLE>"
        )
        SparkSession.active().createDataFrame(rows, kinds).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> IsolationForest:
        rows = spark.read.parquet(path).orderBy("tree").collect()
        kinds = {"feature": np.int64, "cut": float, "children": np.int64, "depth": float}
        trees = tuple({c: np.array(r[c], dtype=kind) for c, kind in kinds.items()} for r in rows)
        first = rows[0]
        return IsolationForest(tuple(first["feature_cols"]), trees, first["sample_size"], first["offset"], first["metrics"])


def mean_path(n: float) -> float:
    """Average depth of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def _grow(rows: np.ndarray, rng: np.random.Generator, limit: int) -> dict[str, list]:
    """One tree as parallel node arrays; a leaf has feature -1 and its expected depth."""
    nodes: dict[str, list] = {"feature": [], "cut": [], "left": [], "right": [], "depth": []}

    def add(block: np.ndarray, level: int) -> int:
        here = len(nodes["feature"])
        for key, empty in (("feature", -1), ("cut", 0.0), ("left", -1), ("right", -1)):
            nodes[key].append(empty)
        nodes["depth"].append(level + mean_path(len(block)))
        if level >= limit or len(block) <= 1:
            return here
        low, high = block.min(axis=0), block.max(axis=0)
        open_features = np.flatnonzero(high > low)
        if not len(open_features):
            return here
        chosen = int(rng.choice(open_features))
        cut = float(rng.uniform(low[chosen], high[chosen]))
        below = block[:, chosen] < cut
        nodes["feature"][here], nodes["cut"][here] = chosen, cut
        nodes["left"][here] = add(block[below], level + 1)
        nodes["right"][here] = add(block[~below], level + 1)
        return here

    add(rows, 0)
    return nodes


def _packed(nodes: Mapping[str, Sequence]) -> dict[str, np.ndarray]:
    """Node arrays for traversal: a leaf leads back to itself, so every row takes as many steps."""
    feature = np.array(nodes["feature"], dtype=np.int64)
    leaf = feature < 0
    here = np.arange(len(feature))
    left = np.where(leaf, here, np.array(nodes["left"], dtype=np.int64))
    right = np.where(leaf, here, np.array(nodes["right"], dtype=np.int64))
    return {
        "feature": np.where(leaf, 0, feature),
        "cut": np.array(nodes["cut"], dtype=float),
        "children": np.column_stack([left, right]).ravel(),
        "depth": np.array(nodes["depth"], dtype=float),
    }


def _depth(
    values: np.ndarray, trees: Sequence[Mapping[str, np.ndarray]], steps: int
) -> np.ndarray:
    """Mean path length of every row over the trees, all rows of a batch at once."""
    total = np.zeros(len(values))
    flat, start = values.ravel(), np.arange(len(values)) * values.shape[1]
    for tree in trees:
        at = np.zeros(len(values), dtype=np.int64)
        for _ in range(steps):
            value = flat.take(start + tree["feature"].take(at))
            at = tree["children"].take(2 * at + (value >= tree["cut"].take(at)))
        total += tree["depth"].take(at)
    return total / max(len(trees), 1)


def _steps(sample_size: int) -> int:
    """Largest depth of a tree."""
    return max(1, math.ceil(math.log2(max(sample_size, 2))))


def _samples(df: DataFrame, cols: Sequence[str], rows: int, chosen: Mapping) -> tuple[DataFrame, int]:
    """Tree samples ``tree, _features``, drawn from the whole table on one path for all sizes.

    Equal rows are folded to their number. A hash of the values decides how many draws
    a row and its copies get, whole draws for certain and the rest by chance, and which
    trees take them; so neither partitions nor a retry change a sample.
    """
    size, n_trees, seed = min(int(chosen["sample_size"]), rows), int(chosen["n_trees"]), F.lit(int(chosen["seed"]))
    # Each tree draws more rows than it needs, seven deviations and a few; the lowest draws are its sample.
    wanted = size + 7.0 * math.sqrt(size) + 16.0
    share = n_trees * min(1.0, wanted / rows)
    values = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("_features"))
    folded = values.groupBy("_features").agg(F.count(F.lit(1)).alias("_copies"))
    span = 2**53
    chance = F.pmod(F.xxhash64("_features", seed), F.lit(span)) / F.lit(float(span))
    draws = folded.withColumn("_draws", F.floor(F.col("_copies") * share + chance)).where("_draws > 0")
    order = F.array_sort(
        F.transform(
            F.sequence(F.lit(0), F.lit(n_trees - 1)),
            lambda t: F.struct(F.xxhash64("_features", t, seed).alias("at"), t.alias("tree")),
        )
    )
    rest = F.pmod(F.col("_draws"), F.lit(n_trees))
    dealt = F.transform(
        order,
        lambda t, i: F.struct(
            t["tree"].alias("tree"),
            (F.floor(F.col("_draws") / n_trees) + (i < rest).cast("long")).alias("times"),
        ),
    )
    taken = draws.select("_features", F.explode(F.filter(dealt, lambda t: t["times"] > 0)).alias("_taken"))
    each = taken.select(
        "_features",
        F.col("_taken.tree").alias("tree"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("_taken.times"))).alias("_copy"),
    )
    draw = F.xxhash64("tree", "_copy", "_features", seed)
    return each.select("_features", "tree", draw.alias("_draw"), F.col("_copy").alias("_row")), size


def train(
    df: DataFrame, feature_cols: Sequence[str], *, params: Mapping[str, float] | None = None
) -> IsolationForest:
    """Grow the forest and set the offset so that the contamination share scores below 0."""
    chosen = {**DEFAULTS, **(params or {})}
    cols = tuple(feature_cols)
    data = df.select(*cols).dropna()
    rows = data.count()
    if rows == 0:
        raise ValueError("training needs rows")
    drawn, size = _samples(data, cols, rows, chosen)
    limit = _steps(size)
    seed = int(chosen["seed"])

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(sample["tree"].iloc[0])
        sample = sample.sort_values(["_draw", "_row"]).head(size)
        rng = np.random.default_rng([seed, tree])
        nodes = _grow(np.array(sample["_features"].tolist(), dtype=float), rng, limit)
        return pd.DataFrame({"tree": [tree], **{k: [v] for k, v in nodes.items()}})

    grown = drawn.groupBy("tree").applyInPandas(grow, NODES).orderBy("tree").collect()
    trees = tuple(_packed(t.asDict()) for t in grown)
    raw = with_anomaly_score(IsolationForest(cols, trees, size), data)
    # one scoring; everything else comes from the counted scores
    path = scratch_path(df.sparkSession, "scores")
    raw.groupBy("anomaly_score").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    counted = df.sparkSession.read.parquet(path)
    offset = value_at_share(counted, "anomaly_score", "n", float(chosen["contamination"]))
    found = counted.agg(
        (F.sum(F.col("anomaly_score") * F.col("n")) / F.sum("n")).alias("mean"),
        F.sum("n").alias("rows"),
        (F.sum(F.when(F.col("anomaly_score") < offset, F.col("n")).otherwise(0)) / F.sum("n")).alias("rate"),
    ).first()
    metrics = {
        "anomaly_rate": float(found["rate"]),
        "mean_anomaly_score": float(found["mean"] - offset),
        "training_samples": float(found["rows"]),
    }
    return IsolationForest(cols, trees, size, offset, metrics)


def with_anomaly_score(forest: IsolationForest, df: DataFrame) -> DataFrame:
    """Add ``anomaly_score``: minus the isolation score less the offset, low for anomalies."""
    fixed = (forest.trees, mean_path(forest.sample_size), _steps(forest.sample_size))
    shared = df.sparkSession.sparkContext.broadcast(fixed)
    offset = forest.offset

    @F.pandas_udf("double")
    def decision(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees, usual, steps = shared.value
        for columns in batches:
            # a single column arrives without its tuple
            parts = columns if isinstance(columns, tuple) else (columns,)
            values = np.column_stack([c.to_numpy(dtype=float) for c in parts])
            score = -np.exp2(-_depth(values, trees, steps) / (usual or 1.0)) - offset
            score[np.isnan(values).any(axis=1)] = np.nan
            yield pd.Series(score)

    found = decision(*[F.col(c).cast("double") for c in forest.feature_cols])
    return df.withColumn("anomaly_score", F.nanvl(found, F.lit(None).cast("double")))


def score(
    forest: IsolationForest,
    df: DataFrame,
    *,
    model_version: str,
    correlation_id: str | None = None,
) -> DataFrame:
    """Add ``anomaly_score``, ``is_leakage`` and the audit columns; a row with a gap is not flagged."""
    scored = with_anomaly_score(forest, df).withColumn(
        "is_leakage", F.coalesce(F.col("anomaly_score") < 0, F.lit(False))
    )
    return stamp_audit(
        scored,
        model_version=model_version,
        correlation_id=correlation_id,
        pipeline_name="leakage_detection_batch",
    )
