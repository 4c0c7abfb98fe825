"""The quality gate on a stream of raw files.

Adapters, score and split are projections and filters, so they run unchanged on a
streaming frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from verisift.functions.scoring import with_quality_score
from verisift.operators.adapters import Adapter
from verisift.operators.gate import DEFAULT_THRESHOLD, split_by_score, with_quarantine_reason
from verisift.sources.layout import Layout
from verisift.sources.raw import READER_OPTIONS


def raw_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    file_format: str = "csv",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.format(file_format).schema(schema)
    reader = reader.options(**READER_OPTIONS.get(file_format, {}))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def scored_stream(raw: DataFrame, adapter: Adapter) -> DataFrame:
    return with_quality_score(adapter.transform(raw))


def start_gate(
    raw: DataFrame,
    adapter: Adapter,
    entity: str,
    layout: Layout,
    *,
    checkpoint: str,
    threshold: float = DEFAULT_THRESHOLD,
) -> StreamingQuery:
    """Process all files present and stop. Each batch replaces its own ``batch=`` folder, so
    a batch repeated after a failure leaves every row once."""

    def write_batch(batch: DataFrame, number: int) -> None:
        passed, quarantined = split_by_score(batch, threshold)
        passed.write.mode("overwrite").parquet(f"{layout.silver(entity)}/batch={number}")
        with_quarantine_reason(quarantined).write.mode("overwrite").parquet(
            f"{layout.quarantine(entity)}/batch={number}"
        )

    return (
        scored_stream(raw, adapter)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
