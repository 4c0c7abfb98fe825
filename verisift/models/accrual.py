"""Accrual forecast: gradient-boosted trees."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from verisift.functions.audit import stamp_audit
from verisift.models.boosting import BoostedTrees, boost, with_prediction
from verisift.models.training import FOLDS, WEIGHT, Trained, measured, quality_weight

TARGET = "accrual_amount"
# Default size of the model.
DEFAULTS = {"maxIter": 200, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8}


def train(
    df: DataFrame,
    feature_cols: Sequence[str],
    *,
    target: str = TARGET,
    params: Mapping[str, object] | None = None,
    folds: int = FOLDS,
) -> Trained:
    """Fit on rows weighted by quality; metrics are the cross-validated MAE."""
    chosen = {**DEFAULTS, **(params or {})}
    data = df.select(
        *feature_cols,
        F.col(target).cast("double").alias("_label"),
        quality_weight(df).cast("double").alias(WEIGHT),
    )
    model, errors = boost(
        data,
        feature_cols,
        trees=int(chosen["maxIter"]),
        depth=int(chosen["maxDepth"]),
        rate=float(chosen["stepSize"]),
        subsample=float(chosen["subsamplingRate"]),
        folds=folds,
    )
    mean, deviation = (np.mean(errors), np.std(errors)) if errors else (None, None)
    return Trained(
        model, tuple(feature_cols), measured(cv_mae_mean=mean, cv_mae_std=deviation)
    )


def score(
    model: BoostedTrees, df: DataFrame, *, model_version: str, correlation_id: str | None = None
) -> DataFrame:
    """Add ``predicted_accrual`` and the audit columns; gaps among the features are allowed."""
    return stamp_audit(
        with_prediction(model, df, "predicted_accrual"),
        model_version=model_version,
        correlation_id=correlation_id,
        pipeline_name="accrual_forecast_batch",
    )
