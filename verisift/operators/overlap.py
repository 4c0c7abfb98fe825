"""Overlaps of dated rows by sweeping their events, without pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from verisift.functions.exprs import ref_day


def _swept(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: overlapping pairs, days of overlap summed over pairs, and the most rows at once.

    Events are totals per key and day, so a key has no more rows than the calendar has days.
    """
    daily = events.groupBy(*keys, "_day").agg(F.sum("_begins").alias("_begins"), F.sum("_ends").alias("_ends"))
    in_order = W.partitionBy(*keys).orderBy("_day")
    wide = "decimal(38,0)"
    begins = F.col("_begins").cast(wide)
    running = daily.withColumn("_now", F.sum(F.col("_begins") - F.col("_ends")).over(in_order)).withColumn(
        "_until", F.lead("_day").over(in_order)
    )
    now = F.col("_now").cast(wide)
    # those that begin meet all that go on and each other
    met = begins * (now - begins) + (begins * (begins - 1) / 2).cast(wide)
    days = F.coalesce(F.datediff("_until", "_day"), F.lit(0)).cast(wide)
    return running.groupBy(*keys).agg(
        F.sum(met).cast(wide).alias("_pairs"),
        F.sum((now * (now - 1) / 2).cast(wide) * days).cast(wide).alias("_days"),
        F.max("_now").alias("_most"),
    )


def contract_overlap_between(
    contracts: DataFrame,
    date_from: object,
    date_to: object,
    *,
    groups: Sequence[str] = ("customer_id", "product_id"),
) -> DataFrame:
    """Overlaps among the contracts of a customer on one product between two days, both included.

    ``overlapping_pairs`` counts pairs of contracts with different ids that are in force on a
    common day, ``overlap_days`` sums the common days over these pairs, and ``most_active`` is
    the largest number of rows of one product in force on one day. A contract without an end
    stays in force; rows without a group value, id or begin, and rows that end before they
    begin, are left out. Customers without an overlap are not listed.
    """
    first, last = ref_day(date_from), ref_day(date_to)
    begin = F.greatest("effective_date", first)
    end = F.least(F.coalesce("expiration_date", last), last)
    known = F.lit(True)
    for c in (*groups, "contract_id", "effective_date"):
        known = known & F.col(c).isNotNull()
    ordered = F.coalesce(F.col("expiration_date") >= F.col("effective_date"), F.lit(True))
    dated = contracts.where(known & ordered).select(*groups, "contract_id", begin.alias("_begin"), end.alias("_end"))
    marks = F.array(
        F.struct(F.col("_begin").alias("_day"), F.lit(1).alias("_begins"), F.lit(0).alias("_ends")),
        F.struct(F.date_add("_end", 1).alias("_day"), F.lit(0).alias("_begins"), F.lit(1).alias("_ends")),
    )
    events = dated.where("_begin <= _end").select(*groups, "contract_id", F.inline(marks))
    # folded once per id; both sweeps start from these totals
    events = events.groupBy(*groups, "contract_id", "_day").agg(F.sum("_begins").alias("_begins"), F.sum("_ends").alias("_ends"))
    together = _swept(events, groups)
    of_one_id = _swept(events, [*groups, "contract_id"])
    minus = [(-F.col(c)).alias(c) for c in ("_pairs", "_days")]
    owner = groups[0]
    both = together.select(owner, "_pairs", "_days", "_most").unionByName(
        of_one_id.select(owner, *minus, F.lit(0).cast("long").alias("_most"))
    )
    return (
        both.groupBy(owner)
        .agg(
            F.sum("_pairs").cast("long").alias("overlapping_pairs"),
            F.sum("_days").cast("long").alias("overlap_days"),
            F.max("_most").alias("most_active"),
        )
        .where("overlapping_pairs > 0")
    )
