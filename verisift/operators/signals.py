"""Per-record data-quality signals (``feat_*`` columns)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from verisift.functions.exprs import data_columns, ref_day


def with_source_completeness(df: DataFrame) -> DataFrame:
    """Share of data columns that are neither NULL nor an empty text."""
    columns = data_columns(df.columns)
    filled = sum(
        (F.coalesce(F.col(c).cast("string") != "", F.lit(False)).cast("int") for c in columns),
        F.lit(0),
    )
    return df.withColumn(
        "feat_source_completeness", F.round(filled / F.lit(float(len(columns) or 1)), 4)
    )


def with_staleness_days(df: DataFrame, date_column: str, *, as_of: object = None) -> DataFrame:
    """Days from the record date to the reference day."""
    return df.withColumn("feat_staleness_days", F.datediff(ref_day(as_of), F.col(date_column)))


def with_match_confidence(
    df: DataFrame,
    keys: Sequence[str],
    reference: DataFrame,
    reference_keys: Sequence[str],
    *,
    mode: str = "any",
) -> DataFrame:
    """Share of the record's keys found in the reference.

    ``mode="any"`` looks every key up by itself, ``mode="all"`` asks for one reference
    row with all keys and gives 0 or 1. The reference is made distinct, so records
    are never multiplied.
    """
    if len(keys) != len(reference_keys):
        raise ValueError("keys and reference_keys must have the same length")
    if mode == "all":
        groups = [list(zip(keys, reference_keys))]
    elif mode == "any":
        groups = [[pair] for pair in zip(keys, reference_keys)]
    else:
        raise ValueError(f"mode is 'any' or 'all', not {mode!r}")
    out = df
    hits = F.lit(0)
    for i, pairs in enumerate(groups):
        found = f"_found_{i}"
        known = (
            reference.select(*[F.col(r).alias(f"_ref_{i}_{r}") for _, r in pairs])
            .dropna()
            .distinct()
            .withColumn(found, F.lit(1))
        )
        condition = F.lit(True)
        for key, ref in pairs:
            condition = condition & (F.col(key) == F.col(f"_ref_{i}_{ref}"))
        out = out.join(known, condition, "left")
        hits = hits + F.coalesce(F.col(found), F.lit(0))
    share = F.round(hits / F.lit(float(len(groups))), 4)
    return out.select(*df.columns, share.alias("feat_match_confidence"))


def with_duplicate_probability(
    df: DataFrame,
    block: Sequence[str],
    date_column: str,
    *,
    max_days: int = 7,
) -> DataFrame:
    """How close in time the nearest other record with the same block values is.

    1 on the same day, falling to 0 beyond ``max_days``. Records are counted per block
    and day and only neighbouring days are compared, so no pairs are built.
    """
    days = df.groupBy(*block, date_column).agg(F.count(F.lit(1)).alias("_n"))
    by_day = W.partitionBy(*block).orderBy(date_column)
    day = F.col(date_column)
    nearest = F.when(F.col("_n") > 1, F.lit(0)).otherwise(
        F.least(
            F.datediff(day, F.lag(date_column).over(by_day)),
            F.datediff(F.lead(date_column).over(by_day), day),
        )
    )
    probability = F.coalesce(
        F.greatest(F.lit(0.0), 1.0 - nearest / F.lit(float(max_days + 1))), F.lit(0.0)
    )
    keys = [*block, date_column]
    scored = days.where(day.isNotNull()).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.round(probability, 4).alias("feat_duplicate_probability"),
    )
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    probability_or_zero = F.coalesce(F.col("feat_duplicate_probability"), F.lit(0.0))
    return df.join(scored, condition, "left").select(
        *df.columns, probability_or_zero.alias("feat_duplicate_probability")
    )
