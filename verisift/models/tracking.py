"""Training runs, model cards and model stages as tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from verisift.schemas import MODEL_STAGES
from verisift.sources.layout import Layout

RUN_ROWS = (
    "run_id STRING, model_name STRING, use_case STRING, version STRING, stage STRING, "
    "params MAP<STRING,STRING>, metrics MAP<STRING,DOUBLE>, tags MAP<STRING,STRING>, "
    "data_quality DOUBLE, started_at TIMESTAMP"
)
CARD_ROWS = (
    "name STRING, version STRING, description STRING, use_case STRING, "
    "training_dataset STRING, feature_versions MAP<STRING,STRING>, "
    "metrics MAP<STRING,DOUBLE>, parameters MAP<STRING,STRING>, limitations STRING, "
    "ethical_considerations STRING"
)


@dataclass(frozen=True)
class ModelCard:
    name: str
    description: str
    use_case: str
    training_dataset: str
    version: str = "0.0.0"
    feature_versions: Mapping[str, str] = field(default_factory=dict)
    metrics: Mapping[str, float] = field(default_factory=dict)
    parameters: Mapping[str, object] = field(default_factory=dict)
    limitations: str = ""
    ethical_considerations: str = ""


def _texts(values: Mapping[str, object] | None) -> dict[str, str]:
    return {k: str(v) for k, v in (values or {}).items()}


def record_run(
    spark: SparkSession,
    layout: Layout,
    *,
    model_name: str,
    use_case: str,
    metrics: Mapping[str, float],
    params: Mapping[str, object] | None = None,
    tags: Mapping[str, str] | None = None,
    version: str = "0.0.0",
    stage: str = "experimental",
    data_quality: float | None = None,
) -> str:
    """Append a training run and return its id."""
    _known_stage(stage)
    run_id = uuid.uuid4().hex
    row = (
        run_id,
        model_name,
        use_case,
        version,
        stage,
        _texts(params),
        {k: float(v) for k, v in metrics.items()},
        {**_texts(tags), "use_case": use_case, "model_name": model_name},
        data_quality,
        datetime.now(timezone.utc),
    )
    spark.createDataFrame([row], RUN_ROWS).write.mode("append").parquet(layout.catalog("model_runs"))
    return run_id


def record_card(spark: SparkSession, layout: Layout, card: ModelCard) -> None:
    """Append a model card."""
    values = asdict(card)
    values["parameters"] = _texts(card.parameters)
    values["metrics"] = {k: float(v) for k, v in card.metrics.items()}
    row = tuple(values[part.split(" ")[0]] for part in CARD_ROWS.split(", "))
    spark.createDataFrame([row], CARD_ROWS).write.mode("append").parquet(
        layout.catalog("model_cards")
    )


def promote(spark: SparkSession, layout: Layout, run_id: str, stage: str) -> None:
    """Append the run again under a new stage."""
    _known_stage(stage)
    runs = spark.read.schema(RUN_ROWS).parquet(layout.catalog("model_runs"))
    newest = latest(runs.where(F.col("run_id") == run_id), "run_id")
    (
        newest.withColumns({"stage": F.lit(stage), "started_at": F.current_timestamp()})
        .write.mode("append")
        .parquet(layout.catalog("model_runs"))
    )


def latest(rows: DataFrame, *keys: str, order: str = "started_at") -> DataFrame:
    """The newest row of every key."""
    whole = F.struct(*rows.columns)
    # equal or missing times are told apart by the row itself
    newest = F.max_by(whole, F.struct(order, F.xxhash64(F.to_json(whole))))
    return rows.groupBy(*keys).agg(newest.alias("_row")).select("_row.*")


def model_stages(runs: DataFrame) -> DataFrame:
    """The newest run of every model in every stage; a run counts in its last stage only."""
    return latest(latest(runs, "run_id"), "model_name", "stage")


def _known_stage(stage: str) -> None:
    if stage not in MODEL_STAGES:
        raise ValueError(f"stage is one of {MODEL_STAGES}, not {stage!r}")
