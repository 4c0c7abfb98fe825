"""Distribution drift between a baseline and a current frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from verisift.functions.exprs import ratio
from verisift.functions.running import chain_buckets, in_buckets, quantile_map

# Share used for an empty bin, so that its logarithm exists.
EMPTY_SHARE = 1e-4


def _bin_counts(df: DataFrame, columns: Sequence[str], edges: Column, name: str) -> DataFrame:
    """Rows per column and bin; the values are unpivoted and combined before the shuffle."""
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.when(F.col(c).isNull(), F.lit(-1))
                .otherwise(F.size(F.filter(F.col("_edges")[c], lambda e: e < F.col(c).cast("double"))))
                .alias("bin"),
            )
            for c in columns
        ]
    )
    placed = df.select(*columns).withColumn("_edges", edges).select(F.inline(cells))
    return placed.groupBy("column", "bin").agg(F.count(F.lit(1)).alias(name))


def population_stability(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], *, bins: int = 10
) -> DataFrame:
    """Population stability index per column over the baseline's quantile bins.

    NULL is a bin of its own. The edges are exact, from counted distinct values of all
    columns at once; one pass over each frame makes the counts.
    """
    edges = quantile_map(baseline, columns, bins).scalar()
    zero = F.lit(0)
    both = (
        _bin_counts(baseline, columns, edges, "_b")
        .withColumn("_c", zero)
        .unionByName(_bin_counts(current, columns, edges, "_c").withColumn("_b", zero))
        .groupBy("column", "bin")
        .agg(F.sum("_b").alias("_b"), F.sum("_c").alias("_c"))
    )
    # At most bins + 1 rows per column reach the window.
    whole = W.partitionBy("column")
    floor = F.lit(EMPTY_SHARE)
    before = F.greatest(floor, ratio(F.col("_b"), F.sum("_b").over(whole)))
    after = F.greatest(floor, ratio(F.col("_c"), F.sum("_c").over(whole)))
    return (
        both.select("column", before.alias("_before"), after.alias("_after"))
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("bins"),
            F.sum(
                (F.col("_after") - F.col("_before")) * F.ln(F.col("_after") / F.col("_before"))
            ).alias("psi"),
        )
    )


def kolmogorov_smirnov(baseline: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Largest distance between the two cumulative distributions of a column."""
    zero = F.lit(0)

    def counted(df: DataFrame, name: str) -> DataFrame:
        value = F.col(column).cast("double").alias("value")
        return df.where(F.col(column).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias(name))

    points = (
        counted(baseline, "b")
        .withColumn("c", zero)
        .unionByName(counted(current, "c").withColumn("b", zero))
        .groupBy("value")
        .agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    )
    totals = points.agg(F.struct(F.sum("b").alias("b"), F.sum("c").alias("c"))).scalar()
    gap = ratio(F.col("b_in") + F.col("b"), F.col("_all")["b"]) - ratio(
        F.col("c_in") + F.col("c"), F.col("_all")["c"]
    )
    buckets = (
        in_buckets(points, "value", ["b", "c"])
        .withColumn("_all", totals)
        .groupBy("bucket")
        .agg(
            F.min(gap).alias("low"),
            F.max(gap).alias("high"),
            F.sum("b").alias("b"),
            F.sum("c").alias("c"),
        )
    )
    # Earlier buckets shift all gaps of a bucket by the same amount.
    shift = ratio(F.col("b_before"), F.sum("b").over(W.partitionBy())) - ratio(
        F.col("c_before"), F.sum("c").over(W.partitionBy())
    )
    shifted = chain_buckets(buckets, ["b", "c"]).withColumn("_shift", shift)
    widest = F.greatest(F.abs(F.col("low") + F.col("_shift")), F.abs(F.col("high") + F.col("_shift")))
    return shifted.agg(F.lit(column).alias("column"), F.max(widest).alias("ks"))
