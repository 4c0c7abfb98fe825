"""Running totals over a global order without gathering it into one task.

The rows are cut into ranges of the order, as many as they need, and a metric over a
running total is computed inside the ranges first; the results of the ranges, one row each,
are then combined in order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from verisift.session import scratch_path

#: Rows of a range, about.
RANGE_ROWS = 1_000_000


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def in_ranges(points: DataFrame, *order: str) -> DataFrame:
    """The rows with ``bucket``, the number of their range of the order, from 0.

    The points are stored to be counted, and stored again with their ranges, which come from
    a sample: whoever reads them later, also after a failure, sees the same ranges.
    """
    stored = _stored(points, "points")
    ranges = math.ceil(stored.count() / RANGE_ROWS)
    if ranges <= 1:
        return stored.withColumn("bucket", F.lit(0))
    dealt = stored.repartitionByRange(ranges, *order).withColumn("bucket", F.spark_partition_id())
    return _stored(dealt, "ranges")


def in_buckets(points: DataFrame, order: str, values: Sequence[str]) -> DataFrame:
    """Add ``bucket`` and ``<value>_in``: the bucket's total over rows with a smaller ``order``.

    ``points`` holds one row per distinct ``order`` value. Buckets are numbered in the
    order; their number grows with the rows.
    """
    smaller = W.partitionBy("bucket").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return in_ranges(points, order).withColumns(
        {f"{v}_in": F.coalesce(F.sum(v).over(smaller), F.lit(0)) for v in values}
    )


def chain_buckets(totals: DataFrame, values: Sequence[str]) -> DataFrame:
    """Add ``<value>_before``: the total over earlier buckets; one row per bucket in ``totals``.

    A row stands for about ``RANGE_ROWS`` points, so the unpartitioned window is small.
    """
    earlier = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    return totals.withColumns(
        {f"{v}_before": F.coalesce(F.sum(v).over(earlier), F.lit(0)) for v in values}
    )


def totals_before(points: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """Add ``<value>_before`` and ``<value>_all``: totals over the group's smaller rows and over all of it.

    ``points`` holds one row per group and distinct ``order`` value; a range may end one group
    and begin the next.
    """
    placed = in_ranges(points, by, order)
    earlier = W.partitionBy(by).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    # one row per range of the group
    totals = placed.groupBy(by, "bucket").agg(F.sum(value).alias("_total")).select(
        F.col(by).alias("_by"),
        F.col("bucket").alias("_range"),
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_shift"),
        F.sum("_total").over(W.partitionBy(by)).alias(f"{value}_all"),
    )
    smaller = W.partitionBy(by, "bucket").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    inside = placed.withColumn("_in", F.coalesce(F.sum(value).over(smaller), F.lit(0)))
    met = F.col(by).eqNullSafe(F.col("_by")) & (F.col("bucket") == F.col("_range"))
    return inside.join(totals, met).select(
        *points.columns, (F.col("_shift") + F.col("_in")).alias(f"{value}_before"), f"{value}_all"
    )


def value_at_share(points: DataFrame, value: str, count: str, share: float) -> float | None:
    """The least value that at least this share of the rows does not exceed, exactly.

    ``points`` holds one row per distinct value with its number of rows; None without rows.
    """
    one = points.select(F.lit(0).alias("_all_of"), F.col(value).alias("_value"), F.col(count).alias("_n"))
    placed = totals_before(one, "_all_of", "_value", "_n")
    # the rank is a whole number: the share of the rows, but for rounding, upwards
    rank = F.greatest(F.ceil(F.round(F.lit(float(share)) * F.col("_n_all"), 6)), F.lit(1))
    found = placed.where((F.col("_n_before") < rank) & (rank <= F.col("_n_before") + F.col("_n"))).first()
    return None if found is None else found["_value"]


def quantile_map(df: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """One row: ``edges``, a map from column to its distinct exact quantiles, the least values
    that reach each share of its known values."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    points = (
        df.select(F.inline(cells))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    placed = totals_before(points, "column", "value", "n")
    # the first share beyond the smaller values, as a whole number of bins
    share = F.expr(f"({bins} * n_before) div n_all") + 1
    reached = (share < bins) & (share * F.col("n_all") <= bins * (F.col("n_before") + F.col("n")))
    return (
        placed.where(reached)
        .groupBy("column")
        .agg(F.sort_array(F.collect_list("value")).alias("edges"))
        .agg(F.map_from_entries(F.collect_list(F.struct("column", "edges"))).alias("edges"))
    )


def exact_quantiles(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """The edges of ``quantile_map``; NaN counts as unknown."""
    known = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    return dict(quantile_map(known, columns, bins).first()["edges"] or {})
