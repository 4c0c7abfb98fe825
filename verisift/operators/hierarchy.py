"""Hierarchies whose links are dated: who belonged to whom on a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from verisift.functions.exprs import ref_day
from verisift.session import ensure_checkpoint_dir

FIRST, LAST = "0001-01-01", "9999-12-31"
SPAN = ["member", "ancestor", "valid_from", "valid_to"]


def dated_closure(links: DataFrame) -> DataFrame:
    """Every way up: ``member, ancestor, valid_from, valid_to, level``.

    ``links`` holds ``child, parent, valid_from, valid_to``, both days included and NULL for no
    limit. A way is valid while all its links are. Each round adds one link to the ways found in
    the last round; ways with the same ends and days are one, at their lowest level, and no
    way leads back to its member, so cycles end. Rows without a child or parent, from a
    child to itself or that end before they begin are left out.
    """
    ensure_checkpoint_dir(links.sparkSession)
    first, last = F.lit(FIRST).cast("date"), F.lit(LAST).cast("date")
    steps = (
        links.where("child IS NOT NULL AND parent IS NOT NULL AND child <> parent")
        .select(
            F.col("child").alias("member"),
            F.col("parent").alias("ancestor"),
            F.coalesce("valid_from", first).alias("valid_from"),
            F.coalesce("valid_to", last).alias("valid_to"),
        )
        .where("valid_from <= valid_to")
        .distinct()
    ).checkpoint()
    up = steps.select(
        F.col("member").alias("ancestor"),
        F.col("ancestor").alias("_next"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
    )
    found, newest, level = steps.withColumn("level", F.lit(1)), steps, 1
    while True:
        level += 1
        longer = (
            newest.join(up, "ancestor")
            .where("member <> _next AND valid_from <= _to AND _from <= valid_to")
            .select(
                "member",
                F.col("_next").alias("ancestor"),
                F.greatest("valid_from", "_from").alias("valid_from"),
                F.least("valid_to", "_to").alias("valid_to"),
            )
            .distinct()
        )
        newest = longer.join(found, SPAN, "left_anti").checkpoint()
        if newest.isEmpty():
            return found
        found = found.unionByName(newest.withColumn("level", F.lit(level)))


def hierarchy_as_of(closure: DataFrame, as_of: object = None) -> DataFrame:
    """``member, ancestor, level`` on one day, each pair at its lowest level."""
    day = ref_day(as_of)
    return (
        closure.where((F.col("valid_from") <= day) & (F.col("valid_to") >= day))
        .groupBy("member", "ancestor")
        .agg(F.min("level").alias("level"))
    )


def rolled_up(facts: DataFrame, closure: DataFrame, *, member: str, at: str, value: str) -> DataFrame:
    """Totals of the facts per ancestor, by who belonged to whom on the day of each fact.

    Facts are added up per member and day first. A member counts once for an ancestor however
    many ways lead there, at the lowest level.
    """
    daily = facts.groupBy(F.col(member).alias("member"), F.col(at).alias("_at")).agg(
        F.sum(value).alias("_value"), F.count(F.lit(1)).alias("_rows")
    )
    reached = (
        daily.join(closure, "member")
        .where("_at BETWEEN valid_from AND valid_to")
        .groupBy("member", "_at", "ancestor", "_value", "_rows")
        .agg(F.min("level").alias("level"))
    )
    return reached.groupBy("ancestor", "level").agg(
        F.sum("_value").alias("total"), F.sum("_rows").alias("row_count"), F.countDistinct("member").alias("members")
    )
