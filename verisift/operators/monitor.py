"""Feature monitoring: null rates, health, profiles, joins of feature tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from verisift.functions.exprs import ratio, ref_instant
from verisift.operators.checks import measure, null_share

MICROS_PER_DAY = 86_400_000_000.0


def null_rates(df: DataFrame) -> DataFrame:
    """Null rate of every column, from one aggregate; 1 for an empty frame."""
    return measure(df, null_share(*df.columns))


def feature_health(
    df: DataFrame, name: str, *, timestamp_col: str | None = None, as_of: object = None
) -> DataFrame:
    """One row per column: record count, null rate, mean, deviation and days since the newest row.

    Everything comes from one aggregate. Mean and deviation are NULL for columns that
    are not numeric.
    """
    stats = [F.count(F.lit(1)).alias("_rows")]
    newest = F.lit(None).cast("timestamp")
    if timestamp_col and timestamp_col in df.columns:
        stats.append(F.max(timestamp_col).cast("timestamp").alias("_newest"))
        newest = F.col("_newest")
    age = (F.unix_micros(ref_instant(as_of)) - F.unix_micros(newest)) / F.lit(MICROS_PER_DAY)
    nothing = F.lit(None).cast("double")
    rows = []
    for i, field in enumerate(df.schema.fields):
        stats.append(F.count(F.col(field.name)).alias(f"_c{i}"))
        mean = deviation = nothing
        if isinstance(field.dataType, NumericType):
            value = F.col(field.name).cast("double")
            stats += [F.avg(value).alias(f"_m{i}"), F.stddev_samp(value).alias(f"_s{i}")]
            mean, deviation = F.col(f"_m{i}"), F.col(f"_s{i}")
        filled = F.coalesce(ratio(F.col(f"_c{i}"), F.col("_rows")), F.lit(0.0))
        rows.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.lit(field.name).alias("column"),
                F.col("_rows").alias("record_count"),
                (1.0 - filled).alias("null_rate"),
                mean.alias("mean"),
                deviation.alias("stddev"),
                age.alias("freshness_days"),
            )
        )
    return df.agg(*stats).select(F.inline(F.array(*rows)))


def profile(df: DataFrame) -> DataFrame:
    """Type, count, mean, deviation, smallest and largest value and fill rate of each column."""
    stats = [F.count(F.lit(1)).alias("_rows")]
    nothing = F.lit(None).cast("double")
    rows = []
    for i, field in enumerate(df.schema.fields):
        column = F.col(field.name)
        kind = field.dataType
        stats.append(F.count(column).alias(f"_c{i}"))
        mean = deviation = nothing
        if isinstance(kind, NumericType):
            value = column.cast("double")
            stats += [F.avg(value).alias(f"_m{i}"), F.stddev_samp(value).alias(f"_s{i}")]
            mean, deviation = F.col(f"_m{i}"), F.col(f"_s{i}")
        low = high = F.lit(None).cast("string")
        if isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)) or (
            kind.simpleString() == "string"
        ):
            stats += [F.min(column).alias(f"_lo{i}"), F.max(column).alias(f"_hi{i}")]
            low, high = F.col(f"_lo{i}").cast("string"), F.col(f"_hi{i}").cast("string")
        rows.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(kind.simpleString()).alias("type"),
                F.col(f"_c{i}").alias("count"),
                mean.alias("mean"),
                deviation.alias("stddev"),
                low.alias("min"),
                high.alias("max"),
                F.coalesce(ratio(F.col(f"_c{i}"), F.col("_rows")), F.lit(0.0)).alias(
                    "non_null_rate"
                ),
            )
        )
    return df.agg(*stats).select(F.inline(F.array(*rows)))


def training_join(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Feature tables joined to the first one on a common key, which every table must have."""
    missing = [i for i, t in enumerate(tables) if key not in t.columns]
    if missing:
        raise ValueError(f"column {key!r} is missing in feature table(s) {missing}")
    return reduce(lambda left, right: left.join(right, key, "left"), tables)
