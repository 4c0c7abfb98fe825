"""Composite 0-100 quality score of a record, as one projection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from verisift.functions.exprs import data_columns, share

# Share of each quality dimension in the score.
DIMENSION_WEIGHTS = {
    "completeness": 0.25,
    "uniqueness": 0.15,
    "consistency": 0.20,
    "timeliness": 0.10,
    "accuracy": 0.20,
    "validity": 0.10,
}
SCORE_COLUMN = "dq_score"


def _dimensions(df: DataFrame, count_score_column: bool) -> dict[str, Column]:
    counted = [
        c for c in data_columns(df.columns) if count_score_column or c != SCORE_COLUMN
    ]
    filled = sum((F.col(c).isNotNull().cast("int") for c in counted), F.lit(0))
    perfect = F.lit(1.0)
    flags = set(df.columns)

    def flagged(column: str, value: Column) -> Column:
        return value if column in flags else perfect

    stale = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_staleness_score")))
    return {
        "completeness": filled / F.lit(float(len(counted))) if counted else perfect,
        "uniqueness": flagged("_is_duplicate", 1.0 - share(F.col("_is_duplicate"))),
        "consistency": flagged("_dq_consistency", F.col("_dq_consistency").cast("double")),
        "timeliness": flagged("_staleness_score", 1.0 - stale),
        "accuracy": flagged("_dq_accuracy", F.col("_dq_accuracy").cast("double")),
        "validity": flagged("_valid", share(F.col("_valid"))),
    }


def with_quality_score(
    df: DataFrame,
    *,
    weights: Mapping[str, float] | None = None,
    count_score_column: bool = False,
) -> DataFrame:
    """Set ``dq_score`` from the record itself and the flags earlier steps left on it.

    ``_is_duplicate``, ``_valid``, ``_staleness_score``, ``_dq_consistency`` and
    ``_dq_accuracy`` are read when present; a dimension without its flag is perfect.
    ``count_score_column`` counts the still empty score as a missing value.
    """
    weights = dict(weights or DIMENSION_WEIGHTS)
    if set(weights) != set(DIMENSION_WEIGHTS):
        raise ValueError(f"weights must name exactly {sorted(DIMENSION_WEIGHTS)}")
    if abs(sum(weights.values()) - 1.0) > 1e-9:
        raise ValueError("weights must sum to 1")
    parts = _dimensions(df, count_score_column)
    total = sum((parts[name] * F.lit(weight) for name, weight in weights.items()), F.lit(0.0))
    return df.withColumn(SCORE_COLUMN, F.round(total * 100, 2))
