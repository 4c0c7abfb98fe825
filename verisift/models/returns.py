"""Returns propensity: random forest with balanced classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from verisift.functions.audit import stamp_audit
from verisift.models.forest import Forest
from verisift.models.metrics import auc
from verisift.models.training import (
    FOLDS,
    SEED,
    WEIGHT,
    Trained,
    assembler,
    fit,
    measured,
    quality_weight,
)

TARGET = "is_returned"
# Default size of the model. A split of at least 10 rows corresponds to
# leaves of at least 5.
DEFAULTS = {"numTrees": 300, "maxDepth": 8, "minInstancesPerNode": 5}


class Auc(Evaluator):
    """Exact area under the ROC curve of the positive class probability."""

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select("_label", vector_to_array("_probability")[1].alias("_score"))
        return auc(scored, "_label", "_score").first()["auc_roc"]


def train(
    df: DataFrame,
    feature_cols: Sequence[str],
    *,
    target: str = TARGET,
    params: Mapping[str, object] | None = None,
    folds: int = FOLDS,
) -> Trained:
    """Fit with classes weighted inversely to their size, times the quality weight."""
    data = df.select(
        *feature_cols,
        F.col(target).cast("int").cast("double").alias("_label"),
        quality_weight(df).alias("_quality"),
    )
    sizes = data.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_label") == 1.0).alias("returned")
    ).first()
    kept = sizes["rows"] - sizes["returned"]
    if not sizes["returned"] or not kept:
        raise ValueError("training needs rows of both classes")
    balance = F.when(F.col("_label") == 1.0, sizes["rows"] / (2.0 * sizes["returned"])).otherwise(
        sizes["rows"] / (2.0 * kept)
    )
    forest = Forest(
        featuresCol="_features",
        labelCol="_label",
        predictionCol="_prediction",
        probabilityCol="_probability",
        weightCol=WEIGHT,
        seed=SEED,
        **{**DEFAULTS, **(params or {})},
    )
    weighted = data.withColumn(WEIGHT, balance * F.col("_quality"))
    model, mean, deviation = fit([assembler(feature_cols), forest], weighted, Auc(), folds=folds)
    return Trained(
        model,
        tuple(feature_cols),
        measured(
            cv_auc_mean=mean, cv_auc_std=deviation, return_rate=sizes["returned"] / sizes["rows"]
        ),
    )


def score(
    model: PipelineModel, df: DataFrame, *, model_version: str, correlation_id: str | None = None
) -> DataFrame:
    """Add ``return_probability``, ``predicted_return`` and the audit columns."""
    scored = (
        model.transform(df)
        .withColumn("return_probability", vector_to_array("_probability")[1])
        .withColumn("predicted_return", F.col("_prediction").cast("int"))
        .drop("_features", "_probability", "_prediction")
    )
    return stamp_audit(
        scored,
        model_version=model_version,
        correlation_id=correlation_id,
        pipeline_name="returns_prediction_batch",
    )
