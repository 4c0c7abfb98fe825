"""Near-duplicate records by date and amount, without pairs of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Grid of the amounts: decimals of four places.
TICKS = 10_000
#: Length of the spans of days, in tolerances.
SPAN_DAYS = 16


def _same(columns: Sequence[str]) -> Column:
    """Equality of the columns with their copies named ``_k_``, NULL equal to NULL."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return condition


def with_duplicate_closeness(
    df: DataFrame,
    block: Sequence[str],
    date_column: str,
    amount_column: str,
    *,
    max_days: int = 7,
    max_amount: float = 1.0,
) -> DataFrame:
    """How close the nearest other record of the block is in both date and amount.

    ``feat_duplicate_closeness`` is ``(1 - days / (max_days + 1)) * (1 - amount / (max_amount +
    0.0001))`` at its largest over the other records within both tolerances, rounded to four
    places: 1 for an equal record, 0 without such a record, without a date or an amount.

    Records with equal block, day and amount fold to one point. A point is asked for on every
    day of its block within the tolerance that has points at all; points without such a day or
    another point on their own are left out. Points lie in cells as wide
    as the amount tolerance and are offered to the cells beside their own, so each question
    meets the nearest amount below and above it in one sorted cell: work grows with the
    points and the days in reach, never with pairs of records.
    """
    block = list(block)
    ticks = F.round(F.col(amount_column).cast("double") * TICKS).cast("long")
    width = max(1, round(max_amount * TICKS))
    known = F.col(date_column).isNotNull() & F.col(amount_column).isNotNull()
    points = (
        df.where(known)
        .select(*[F.col(c).alias(f"_k_{c}") for c in block], F.col(date_column).cast("date").alias("_day"), ticks.alias("_ticks"))
        .groupBy(*[f"_k_{c}" for c in block], "_day", "_ticks")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    own = [f"_k_{c}" for c in block]
    # the days of a block, with their points, come together by spans of the calendar, to whose
    # edges the days beyond them are added; a NULL in the block is a value like any other
    span = SPAN_DAYS * (max_days + 1)
    day = F.unix_date("_day")
    spans = F.explode(F.sequence(F.floor((day - max_days) / span), F.floor((day + max_days) / span)))
    days = points.groupBy(*own, "_day").agg(F.count(F.lit(1)).alias("_points"))
    listed = days.select(*own, F.struct("_day", "_points").alias("_at"), spans.alias("_span")).groupBy(*own, "_span").agg(
        F.collect_list("_at").alias("_all")
    )
    mine = listed.select(*own, "_span", "_all", F.inline("_all")).where(F.floor(day / span) == F.col("_span"))
    # the day itself is asked only for its other points
    near = F.filter(
        "_all",
        lambda d: (F.abs(F.datediff(d["_day"], F.col("_day"))) <= max_days) & ((d["_day"] != F.col("_day")) | (F.col("_points") > 1)),
    )
    reach = mine.select(*own, "_day", F.transform(near, lambda d: d["_day"]).alias("_days")).where(F.size("_days") > 0)

    here = [*own, "_day"]
    asked_by = F.lit(True)
    for c in here:
        asked_by = asked_by & F.col(c).eqNullSafe(F.col(f"_r{c}"))
    # a day is in reach of those it reaches, so other days have nothing to ask or to offer
    reaching = points.join(reach.select(*[F.col(c).alias(f"_r{c}") for c in here], "_days"), asked_by)
    at = F.floor(F.col("_ticks") / width)
    asks = F.transform("_days", lambda d: F.struct(d.alias("_on"), F.col("_day").alias("_from"), at.alias("_cell"), F.lit(False).alias("_offer")))
    beside = F.array(
        *[
            F.struct(F.col("_day").alias("_on"), F.lit(None).cast("date").alias("_from"), (at + k).alias("_cell"), F.lit(True).alias("_offer"))
            for k in (-1, 0, 1)
        ]
    )
    told = reaching.select(*own, "_ticks", F.inline(F.concat(asks, beside)))
    cell = W.partitionBy(*own, "_on", "_cell")
    offered = F.when(F.col("_offer"), F.col("_ticks"))
    up, down = cell.orderBy("_ticks"), cell.orderBy(F.col("_ticks").desc())
    # on another day an equal amount counts, on the same day it is the point itself
    away = F.col("_from") != F.col("_on")
    below, above = {}, {}
    for other, last in ((True, 0), (False, -1)):
        below[other] = F.max(offered).over(up.rangeBetween(W.unboundedPreceding, last))
        above[other] = F.min(offered).over(down.rangeBetween(W.unboundedPreceding, last))
    met = (
        told.select(
            "*",
            F.when(away, below[True]).otherwise(below[False]).alias("_below"),
            F.when(away, above[True]).otherwise(above[False]).alias("_above"),
        )
        .where(~F.col("_offer"))
    )
    gap = F.least(F.col("_ticks") - F.col("_below"), F.col("_above") - F.col("_ticks"))
    in_days = 1.0 - F.abs(F.datediff("_from", "_on")) / F.lit(float(max_days + 1))
    in_amount = 1.0 - gap / F.lit(float(round(max_amount * TICKS) + 1))
    best = (
        met.where(gap <= round(max_amount * TICKS))
        .groupBy(*own, F.col("_from").alias("_day"), "_ticks")
        .agg(F.max(in_days * in_amount).alias("_best"))
    )
    copied = points.where("_n > 1").select(*own, "_day", "_ticks", F.lit(1.0).alias("_best"))
    scored = best.unionByName(copied).groupBy(*own, "_day", "_ticks").agg(F.max("_best").alias("_closeness"))
    condition = _same(block) & (F.col(date_column).cast("date") == F.col("_day")) & (ticks == F.col("_ticks"))
    return df.join(scored, condition, "left").select(
        *df.columns, F.round(F.coalesce("_closeness", F.lit(0.0)), 4).alias("feat_duplicate_closeness")
    )
