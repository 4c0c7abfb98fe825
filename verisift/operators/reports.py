"""Summaries behind the monitoring pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from verisift.functions.exprs import ratio

STALE_AFTER_DAYS = 1.0
# Fixed value: stability index from which a shift counts as drift.
DRIFT_PSI = 0.2


def accrual_health(accruals: DataFrame) -> DataFrame:
    """Accuracy, mean variance and over/under counts of all accruals with an actual."""
    missed = ratio(F.sum(F.abs("variance")), F.sum(F.abs("actual_amount")))
    return _with_actual(accruals).agg(
        (1.0 - missed).alias("accrual_accuracy"),
        ratio(F.sum("variance"), F.count("variance")).alias("mean_variance"),
        F.count_if(F.col("variance") > 0).alias("over_accrual_count"),
        F.count_if(F.col("variance") < 0).alias("under_accrual_count"),
    )


def accrual_trend(accruals: DataFrame) -> DataFrame:
    """Total and absolute variance per period."""
    return (
        _with_actual(accruals)
        .groupBy("period")
        .agg(
            F.sum("variance").alias("total_variance"),
            F.sum(F.abs("variance")).alias("absolute_variance"),
            F.count(F.lit(1)).alias("accrual_count"),
        )
    )


def top_variance_drivers(accruals: DataFrame, limit: int = 10) -> DataFrame:
    """The customer and product pairs with the largest total variance either way."""
    totals = (
        _with_actual(accruals)
        .groupBy("customer_id", "product_id")
        .agg(F.sum("variance").alias("total_variance"))
    )
    return totals.orderBy(F.abs("total_variance").desc(), "customer_id", "product_id").limit(limit)


def _with_actual(accruals: DataFrame) -> DataFrame:
    return accruals.where(F.col("actual_amount").isNotNull())


def leakage_summary(scored: DataFrame, *, amount: str = "claim_amount", by: str = "claim_status") -> DataFrame:
    """Flagged claims and their amount per status."""
    flagged = F.col("is_leakage")
    return scored.groupBy(by).agg(
        F.count_if(flagged).alias("total_flagged"),
        F.coalesce(F.sum(F.when(flagged, F.col(amount))), F.lit(0)).alias("estimated_leakage"),
        ratio(F.count_if(flagged), F.count(F.lit(1))).alias("leakage_rate"),
    )


def feature_fleet(health: DataFrame, drift: DataFrame, *, max_null_rate: float = 0.1) -> DataFrame:
    """Number of features in all, healthy, stale and drifting, from health and drift rows."""
    per_feature = (
        health.join(drift.select("feature", "column", "psi"), ["feature", "column"], "left")
        .groupBy("feature")
        .agg(
            F.max("null_rate").alias("_nulls"),
            F.max("freshness_days").alias("_age"),
            F.max("psi").alias("_psi"),
        )
    )
    stale = F.coalesce(F.col("_age") > STALE_AFTER_DAYS, F.lit(False))
    drifting = F.coalesce(F.col("_psi") >= DRIFT_PSI, F.lit(False))
    healthy = (F.col("_nulls") <= max_null_rate) & ~stale & ~drifting
    return per_feature.agg(
        F.count(F.lit(1)).alias("total_features"),
        F.count_if(healthy).alias("healthy"),
        F.count_if(stale).alias("stale"),
        F.count_if(drifting).alias("drift_alerts"),
    )


def governance_summary(runs: DataFrame, *, metric: str) -> DataFrame:
    """Models, last training and the relation of data quality to a metric, per stage."""
    return runs.groupBy("stage").agg(
        F.count_distinct("model_name").alias("models"),
        F.max("started_at").alias("last_trained_at"),
        F.corr(F.col("data_quality"), F.col("metrics")[metric]).alias("quality_metric_corr"),
    )
