"""Raw ingestion and the reading of raw partitions."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from verisift.sources.layout import Layout

# Reader options every source of the format is read with. CSV stays text
# so that the type of a column does not depend on the values of one delivery.
READER_OPTIONS = {
    "csv": {"header": "true", "inferSchema": "false"},
    "json": {"multiLine": "false", "primitivesAsString": "true", "mode": "FAILFAST"},
}
# A JSON file holds one object per line, or is one document that spans lines.
JSON_DOCUMENTS = {"lines": "false", "array": "true"}


def read_raw(
    spark: SparkSession,
    path: str,
    *,
    file_format: str = "csv",
    document: str = "lines",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read files of any Spark format; options of the caller win over the defaults.

    JSON is read line by line, so large files are split; ``document="array"`` reads each
    file as one array or object over many lines. Text that is not JSON fails the read.
    """
    merged = dict(READER_OPTIONS.get(file_format, {}))
    if file_format == "json":
        merged["multiLine"] = JSON_DOCUMENTS[document]
    merged |= options or {}
    return spark.read.format(file_format).options(**merged).load(path)


def ingest(
    spark: SparkSession,
    path: str,
    entity: str,
    layout: Layout,
    *,
    file_format: str = "csv",
    date: str | None = None,
    document: str = "lines",
    options: Mapping[str, str] | None = None,
) -> int:
    """Append the files to the raw layer under ``date=`` and return the number of rows.

    The count is observed while writing; the source is read once.
    """
    return ingest_frame(
        read_raw(spark, path, file_format=file_format, document=document, options=options), entity, layout, date=date
    )


def ingest_frame(df: DataFrame, entity: str, layout: Layout, *, date: str | None = None) -> int:
    """Append a frame to the raw layer under ``date=`` (today in UTC unless given)."""
    day = date or datetime.now(timezone.utc).date().isoformat()
    seen = Observation()
    (
        df.withColumn("date", F.lit(day))
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("append")
        .partitionBy("date")
        .parquet(layout.bronze(entity))
    )
    return seen.get["rows"]


def partition_dates(spark: SparkSession, root: str) -> list[str]:
    """Dates of the raw partitions, from one folder listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    names = [
        status.getPath().getName()
        for status in path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(path)
    ]
    return sorted(n.removeprefix("date=") for n in names if n.startswith("date="))


def read_partition(
    spark: SparkSession, entity: str, layout: Layout, *, date: str | None = "latest"
) -> DataFrame:
    """One date of a raw entity, the latest date, or all dates (``date=None``).

    The date is a filter on the partition column, so Spark lists and reads that
    partition alone and the column stays available.
    """
    root = layout.bronze(entity)
    df = spark.read.parquet(root)
    if date is None:
        return df
    if date == "latest":
        dates = partition_dates(spark, root)
        if not dates:
            raise ValueError(f"no raw partition of {entity!r} below {root}")
        date = dates[-1]
    return df.where(F.col("date") == F.lit(date).cast("date"))
