"""End-to-end jobs: raw to silver, features, and train-score-publish."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from verisift.functions.audit import new_correlation_id
from verisift.models import accrual, deduction, leakage, returns
from verisift.models.boosting import BoostedTrees
from verisift.models.tracking import record_run
from verisift.models.training import FOLDS, Trained
from verisift.operators import contract, customer, monitor, rebate, seasonal
from verisift.operators.adapters import adapter_for
from verisift.operators.enrich import enrich
from verisift.operators.gate import DEFAULT_THRESHOLD, GateResult, notify_quarantine, run_gate
from verisift.sources.feature_store import read_feature_table, write_feature_table
from verisift.sources.layout import Layout
from verisift.sources.raw import partition_dates, read_partition
from verisift.sources.tables import publish_scores


def silver_job(
    spark: SparkSession,
    entity: str,
    layout: Layout,
    *,
    date: str | None = "latest",
    threshold: float = DEFAULT_THRESHOLD,
) -> GateResult:
    """Map raw partitions to their canonical entity, score them and write both outcomes.

    Each ingest date is replaced on its own (``date=None``: every date there is), so other
    dates stay and a repeated run changes nothing.
    """
    days = partition_dates(spark, layout.bronze(entity))
    if not days:
        raise ValueError(f"no raw partition of {entity!r} below {layout.bronze(entity)}")
    chosen = days if date is None else [days[-1] if date == "latest" else date]
    adapter = adapter_for(entity)
    results = [
        run_gate(
            adapter.transform(read_partition(spark, entity, layout, date=day)),
            entity,
            layout=layout,
            threshold=threshold,
            day=day,
        )
        for day in chosen
    ]
    scored, score_sum = sum(r.score_count for r in results), sum(r.score_sum for r in results)
    result = GateResult(
        passed=reduce(DataFrame.unionByName, [r.passed for r in results]),
        quarantined=reduce(DataFrame.unionByName, [r.quarantined for r in results]),
        total_count=sum(r.total_count for r in results),
        passed_count=sum(r.passed_count for r in results),
        quarantined_count=sum(r.quarantined_count for r in results),
        mean_dq_score=round(score_sum / max(scored, 1), 2),
        score_sum=score_sum,
        score_count=scored,
    )
    if result.quarantined_count:
        notify_quarantine(spark, entity, result.quarantined_count, layout)
    return result


@dataclass(frozen=True)
class FeatureJob:
    domain: str
    name: str
    inputs: tuple[str, ...]
    compute: Callable[..., DataFrame]
    dated: bool = False
    #: Attributes that it reads of the product or customer of a transaction.
    attributes: tuple[str, ...] = ()


# Every table-valued feature by domain; inputs name the canonical entities it reads.
FEATURE_JOBS = (
    FeatureJob("customer_behavior", "purchase_velocity", ("transaction",), customer.purchase_velocity),
    FeatureJob("customer_behavior", "ordering_regularity", ("transaction",), customer.ordering_regularity),
    FeatureJob("customer_behavior", "mix_entropy", ("transaction",), customer.mix_entropy, attributes=("product_category",)),
    FeatureJob("customer_behavior", "loyalty_index", ("transaction",), customer.loyalty_index),
    FeatureJob("contract_complexity", "contract_features", ("contract",), contract.contract_complexity, dated=True),
    FeatureJob("contract_complexity", "days_to_expiration", ("contract",), contract.days_to_expiration, dated=True),
    FeatureJob("contract_complexity", "contract_overlap", ("contract",), contract.contract_overlap, dated=True),
    FeatureJob("rebate_dynamics", "rebate_to_sales_ratio", ("rebate_accrual", "transaction"), rebate.rebate_to_sales_ratio),
    FeatureJob("rebate_dynamics", "claim_submission_lag", ("chargeback", "transaction"), rebate.submission_lag),
    FeatureJob("rebate_dynamics", "over_under_payment", ("rebate_accrual",), rebate.over_under_payment),
    FeatureJob("rebate_dynamics", "rebate_velocity", ("rebate_accrual",), rebate.rebate_velocity),
    FeatureJob("rebate_dynamics", "distributor_errors", ("chargeback",), rebate.distributor_errors),
    FeatureJob("seasonal_market", "seasonal_index", ("transaction",), seasonal.seasonal_indices, attributes=("product_category",)),
    FeatureJob("seasonal_market", "yoy_growth", ("transaction",), seasonal.yoy_growth),
)


def feature_job(
    entities: Mapping[str, DataFrame],
    layout: Layout,
    *,
    domain: str | None = None,
    as_of: object = None,
) -> dict[str, int]:
    """Compute and write the features of a domain (or all) and return their new versions.

    Where a feature reads the category or segment of transactions, these come from the entities
    ``product`` and ``customer`` if these are given. ``as_of`` is the day of the dated features, today
    unless given; a repeated run with the same day writes the same rows.
    """
    looked_up = {"product_category": "product", "customer_segment": "customer"}
    written = {}
    for job in FEATURE_JOBS:
        if domain in (None, job.domain) and all(name in entities for name in job.inputs):
            day = {"as_of": as_of} if job.dated else {}
            inputs = {name: entities[name] for name in job.inputs}
            if "transaction" in inputs:
                # an attribute changes no rows, so only the features that read it look it up
                lookups = {f"{looked_up[a]}s": entities.get(looked_up[a]) for a in job.attributes}
                inputs["transaction"] = enrich(inputs["transaction"], **lookups)
            features = job.compute(*inputs.values(), **day)
            written[f"{job.domain}/{job.name}"] = write_feature_table(
                features, layout, job.domain, job.name
            )
    return written


def training_table(
    spark: SparkSession, layout: Layout, features: Sequence[tuple[str, str]], key: str
) -> DataFrame:
    """Stored feature tables joined on their common key."""
    tables = [read_feature_table(spark, layout, domain, name) for domain, name in features]
    return monitor.training_join(tables, key)


def _published(
    trained: Trained | leakage.IsolationForest,
    use_case: str,
    layout: Layout,
    scoring: DataFrame,
    *,
    load: Callable[[SparkSession, str], object],
    score: Callable[..., DataFrame],
    params: Mapping[str, object],
    model_version: str,
) -> None:
    """Record the run, store the model, score a frame with the stored one and publish the scores."""
    spark = scoring.sparkSession
    record_run(
        spark,
        layout,
        model_name=use_case,
        use_case=use_case,
        metrics=trained.metrics,
        params=params,
        version=model_version,
    )
    path = layout.gold(f"models/{use_case}/{model_version}")
    trained.save(path)
    run = new_correlation_id()
    scored = score(load(spark, path), scoring, model_version=model_version, correlation_id=run)
    publish_scores(
        scored, layout.gold(SCORE_TABLES[use_case]), model_version=model_version, correlation_id=run
    )


# The published table of each use case.
SCORE_TABLES = {
    "accrual_forecast": "accrual_scores",
    "leakage_detection": "leakage_scores",
    "deduction_classification": "deduction_scores",
    "returns_prediction": "returns_scores",
}


def _pipeline(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)


def accrual_job(
    training: DataFrame,
    scoring: DataFrame,
    feature_cols: Sequence[str],
    layout: Layout,
    *,
    model_version: str,
    params: Mapping[str, object] | None = None,
    folds: int = FOLDS,
) -> Trained:
    """Train the forecast, record the run, score a frame and publish the scores."""
    trained = accrual.train(training, feature_cols, params=params, folds=folds)
    _published(
        trained, "accrual_forecast", layout, scoring, load=BoostedTrees.load, score=accrual.score,
        params={**accrual.DEFAULTS, **(params or {})}, model_version=model_version,
    )
    return trained


def leakage_job(
    training: DataFrame,
    scoring: DataFrame,
    feature_cols: Sequence[str],
    layout: Layout,
    *,
    model_version: str,
    params: Mapping[str, float] | None = None,
) -> leakage.IsolationForest:
    """The same for the isolation forest."""
    forest = leakage.train(training, feature_cols, params=params)
    _published(
        forest, "leakage_detection", layout, scoring, load=leakage.IsolationForest.load, score=leakage.score,
        params={**leakage.DEFAULTS, **(params or {})}, model_version=model_version,
    )
    return forest


def deduction_job(
    training: DataFrame,
    scoring: DataFrame,
    layout: Layout,
    *,
    model_version: str,
    params: Mapping[str, float] | None = None,
    folds: int = FOLDS,
) -> Trained:
    """The same for the types of remittance texts."""
    trained = deduction.train(training, params=params, folds=folds)
    _published(
        trained, "deduction_classification", layout, scoring, load=_pipeline, score=deduction.score,
        params={**deduction.DEFAULTS, **(params or {})}, model_version=model_version,
    )
    return trained


def returns_job(
    training: DataFrame,
    scoring: DataFrame,
    feature_cols: Sequence[str],
    layout: Layout,
    *,
    model_version: str,
    params: Mapping[str, object] | None = None,
    folds: int = FOLDS,
) -> Trained:
    """The same for the propensity of returns."""
    trained = returns.train(training, feature_cols, params=params, folds=folds)
    _published(
        trained, "returns_prediction", layout, scoring, load=_pipeline, score=returns.score,
        params={**returns.DEFAULTS, **(params or {})}, model_version=model_version,
    )
    return trained
