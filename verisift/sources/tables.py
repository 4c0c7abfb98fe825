"""Reading, writing and publishing of external tables through any Spark format."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from verisift.functions.audit import stamp_audit


def read_table(
    spark: SparkSession,
    table: str,
    *,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a table; ``table`` is a path for file formats and ``dbtable`` for the others."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt in FILE_FORMATS:
        return reader.load(table)
    return reader.option("dbtable", table).load()


def write_table(
    df: DataFrame,
    table: str,
    *,
    mode: str = "append",
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """Write a table; see ``read_table`` for the meaning of ``table``."""
    writer = df.write.format(fmt).options(**(options or {})).mode(mode)
    if fmt in FILE_FORMATS:
        writer.save(table)
    else:
        writer.option("dbtable", table).save()


def publish_scores(
    df: DataFrame,
    table: str,
    *,
    model_version: str,
    correlation_id: str | None = None,
    mode: str = "append",
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> int:
    """Stamp the audit columns, write the scores and return the number of rows."""
    stamped = stamp_audit(
        df,
        model_version=model_version,
        correlation_id=correlation_id,
        pipeline_name="gold_publisher",
    )
    seen = Observation()
    write_table(
        stamped.observe(seen, F.count(F.lit(1)).alias("rows")),
        table,
        mode=mode,
        fmt=fmt,
        options=options,
    )
    return seen.get["rows"]


# Spark formats addressed by path.
FILE_FORMATS = ("parquet", "orc", "csv", "json", "text", "avro", "delta")
