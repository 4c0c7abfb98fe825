"""Quality gate: score every record, keep the good ones, quarantine the rest."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from verisift.functions.scoring import SCORE_COLUMN, with_quality_score
from verisift.operators.rules import push_results
from verisift.session import ensure_checkpoint_dir
from verisift.sources.layout import Layout

# Minimum score per environment.
THRESHOLDS = {"dev": 30.0, "staging": 40.0, "prod": 40.0}
DEFAULT_THRESHOLD = THRESHOLDS["prod"]
BELOW_THRESHOLD = "below_dq_threshold"
NO_SCORE = "missing_dq_score"
#: Partition column of what is written for one ingest day.
DAY_COLUMN = "ingest_date"


@dataclass(frozen=True)
class GateResult:
    passed: DataFrame
    quarantined: DataFrame
    total_count: int
    passed_count: int
    quarantined_count: int
    mean_dq_score: float
    score_sum: float = 0.0
    score_count: int = 0


def split_by_score(
    scored: DataFrame, threshold: float = DEFAULT_THRESHOLD
) -> tuple[DataFrame, DataFrame]:
    """Passed and quarantined rows; a row without a score is quarantined."""
    good = F.coalesce(F.col(SCORE_COLUMN) >= threshold, F.lit(False))
    return scored.where(good), scored.where(~good)


def gate_summary(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Counts and mean score as one row, from one aggregate."""
    return scored.agg(*_summary(threshold))


def _summary(threshold: float):
    good = F.count_if(F.col(SCORE_COLUMN) >= threshold)
    return (
        F.count(F.lit(1)).alias("total_count"),
        good.alias("passed_count"),
        (F.count(F.lit(1)) - good).alias("quarantined_count"),
        F.coalesce(F.round(F.avg(SCORE_COLUMN), 2), F.lit(0.0)).alias("mean_dq_score"),
    )


def _observed(threshold: float):
    """The summary with what means of several gates are made of."""
    total = F.coalesce(F.sum(F.col(SCORE_COLUMN).cast("double")), F.lit(0.0))
    return (*_summary(threshold), total.alias("score_sum"), F.count(SCORE_COLUMN).alias("score_count"))


def with_quarantine_reason(df: DataFrame, reason: str = BELOW_THRESHOLD) -> DataFrame:
    """Add ``_quarantine_reason`` and ``_quarantined_at``."""
    why = F.lit(reason)
    if SCORE_COLUMN in df.columns:
        why = F.when(F.col(SCORE_COLUMN).isNull(), NO_SCORE).otherwise(reason)
    return df.withColumns(
        {"_quarantine_reason": why, "_quarantined_at": F.current_timestamp()}
    )


def write_quarantine(
    df: DataFrame, entity: str, layout: Layout, *, reason: str = BELOW_THRESHOLD, day: str | None = None
) -> int:
    """Write the rows with their reason to the quarantine and return their number.

    With a ``day`` they replace that day's folder, so a repeated run leaves one copy;
    without they are appended.
    """
    seen = Observation()
    (
        with_quarantine_reason(df, reason)
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite" if day else "append")
        .parquet(_folder(layout.quarantine(entity), day))
    )
    return seen.get["rows"]


def _folder(root: str, day: str | None) -> str:
    return f"{root}/{DAY_COLUMN}={day}" if day else root


def write_silver(df: DataFrame, entity: str, layout: Layout, *, date_column: str | None = None) -> None:
    """Replace the entity, or only the dates present in ``df`` when partitioned by date.

    Rebalancing groups the rows of a date into few files and splits a large date
    over several tasks.
    """
    writer = df.write.mode("overwrite")
    if date_column:
        writer = (
            df.hint("rebalance", date_column)
            .write.mode("overwrite")
            .partitionBy(date_column)
            .option("partitionOverwriteMode", "dynamic")
        )
    writer.parquet(layout.silver(entity))


def run_gate(
    df: DataFrame,
    entity: str,
    *,
    layout: Layout | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    weights: Mapping[str, float] | None = None,
    date_column: str | None = None,
    day: str | None = None,
    count_score_column: bool = False,
    checkpoint: bool = False,
) -> GateResult:
    """Score and split ``df``; with a ``layout`` also write both parts.

    The counts are observed while the passed rows are written, so the input is read
    once, and a second time only when there is something to quarantine. Set
    ``checkpoint`` when ``df`` is costly to compute (shuffles, not just a scan): it is
    then stored once and both parts are written from there. With a ``day`` both parts
    replace that day only, the quarantine first: a run that fails or is repeated neither
    loses nor doubles a row, and other days stay.
    """
    scored = with_quality_score(df, weights=weights, count_score_column=count_score_column)
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        scored = scored.checkpoint()
    if layout is None:
        passed, quarantined = split_by_score(scored, threshold)
        found = scored.agg(*_observed(threshold)).first().asDict()
    elif day:
        seen = Observation()
        _, rejected = split_by_score(scored.observe(seen, *_observed(threshold)), threshold)
        write_quarantine(rejected, entity, layout, day=day)
        passed, quarantined = split_by_score(scored, threshold)
        passed.write.mode("overwrite").parquet(_folder(layout.silver(entity), day))
        found = seen.get
    else:
        seen = Observation()
        watched, _ = split_by_score(scored.observe(seen, *_observed(threshold)), threshold)
        write_silver(watched, entity, layout, date_column=date_column)
        found = seen.get
        passed, quarantined = split_by_score(scored, threshold)
        if found["quarantined_count"]:
            write_quarantine(quarantined, entity, layout)
    return GateResult(passed=passed, quarantined=quarantined, **found)


def quarantine_notice(
    spark: SparkSession, entity: str, count: int, reason: str = BELOW_THRESHOLD
) -> DataFrame:
    """A failed result row for the catalog about quarantined records."""
    return spark.createDataFrame(
        [(f"quarantine-{entity}", False, (entity, count, reason))],
        "rule_id STRING, passed BOOLEAN, "
        "details STRUCT<entity: STRING, count: BIGINT, reason: STRING>",
    )


def notify_quarantine(
    spark: SparkSession, entity: str, count: int, layout: Layout, reason: str = BELOW_THRESHOLD
) -> None:
    push_results(quarantine_notice(spark, entity, count, reason), layout)
