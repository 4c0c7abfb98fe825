"""Running totals and exact ranks over ranges of data-made number."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from verisift.functions import running
from verisift.models import leakage, metrics
from verisift.operators import drift


def _ranges(df):
    return df.agg(F.countDistinct("bucket")).first()[0]


def test_ranges_grow_with_the_rows(spark, monkeypatch):
    points = spark.range(4000).select((F.col("id") * 7919 % 4000).alias("x"), (F.col("id") % 5).alias("n"))
    assert _ranges(running.in_ranges(points, "x")) == 1
    for size, least in ((1000, 4), (100, 30)):
        monkeypatch.setattr(running, "RANGE_ROWS", size)
        ranged = running.in_ranges(points, "x")
        assert least <= _ranges(ranged) <= math.ceil(4000 / size)
        edges = [(r["low"], r["high"]) for r in ranged.groupBy("bucket").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("bucket").collect()]
        assert all(a[1] < b[0] for a, b in zip(edges, edges[1:]))


@pytest.mark.parametrize("size", [1_000_000, 60])
def test_totals_before(spark, monkeypatch, size):
    monkeypatch.setattr(running, "RANGE_ROWS", size)
    points = spark.range(600).select(F.col("id") % 3, F.floor(F.col("id") / 3), (F.col("id") % 11)).toDF("g", "x", "n")
    rows = [tuple(r) for r in points.collect()]
    found = {(r["g"], r["x"]): (r["n_before"], r["n_all"]) for r in running.totals_before(points, "g", "x", "n").collect()}
    for g, x, _ in rows:
        assert found[g, x] == (sum(n for h, y, n in rows if h == g and y < x), sum(n for h, _, n in rows if h == g))


def test_metrics_over_many_ranges(spark, monkeypatch):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(int(y), float(s)) for y, s in zip(rng.integers(0, 2, 500), rng.normal(size=500))], "y int, s double")
    other = df.withColumn("s", F.col("s") * 1.3 + 0.1)
    whole = metrics.auc(df, "y", "s").first()[0], drift.kolmogorov_smirnov(df, other, "s").first()["ks"]
    edges = running.exact_quantiles(df, ["s"], 10)
    monkeypatch.setattr(running, "RANGE_ROWS", 40)
    assert (metrics.auc(df, "y", "s").first()[0], drift.kolmogorov_smirnov(df, other, "s").first()["ks"]) == pytest.approx(whole)
    assert running.exact_quantiles(df, ["s"], 10) == edges
    values = sorted(r["s"] for r in df.collect())
    assert edges["s"] == [values[math.ceil(i * 50) - 1] for i in range(1, 10)]


def test_exact_rank_among_five_million_scores(spark):
    n = 5_000_000
    scores = spark.range(n).select((F.col("id") * 2654435761 % n).cast("double").alias("s"), F.lit(1).cast("long").alias("n"))
    assert running.value_at_share(scores, "s", "n", 0.05) == n // 20 - 1
    few = spark.createDataFrame([(1.0, 3), (2.0, 1), (5.0, 6)], "s double, n long")
    assert [running.value_at_share(few, "s", "n", p) for p in (0.0, 0.3, 0.31, 0.4, 0.41, 1.0)] == [1.0, 1.0, 2.0, 2.0, 5.0, 5.0]
    assert running.value_at_share(few.limit(0), "s", "n", 0.5) is None


def test_a_stored_forest_scores_alike(spark, tmp_path):
    df = spark.range(800).select((F.xxhash64("id") % 1000).cast("double").alias("a"))
    forest = leakage.train(df, ["a"], params={"n_trees": 10})
    forest.save(str(tmp_path / "forest"))
    again = leakage.IsolationForest.load(spark, str(tmp_path / "forest"))
    assert again.offset == forest.offset and again.metrics == forest.metrics and again.sample_size == forest.sample_size
    one, two = (leakage.with_anomaly_score(f, df).orderBy("a").collect() for f in (forest, again))
    assert one == two
    scores = sorted(r["anomaly_score"] for r in one)
    # the offset is the score at the fortieth of 800 rows
    assert scores[39] == pytest.approx(0.0, abs=1e-15)
