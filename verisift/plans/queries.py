"""The registered queries: every operator over the whole test tables.

Results leave here in plain types (bigint, double, text, boolean) so that they can
be compared across engines; clock columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType, FractionalType, IntegralType, TimestampType

from verisift.functions.audit import new_correlation_id, stamp_audit
from verisift.functions.scoring import with_quality_score
from verisift.models import accrual, deduction, leakage, metrics, returns, tracking
from verisift.models.training import quality_weight
from verisift.operators import (
    allocation,
    checks,
    contract,
    customer,
    drift,
    duplicates,
    gate,
    hierarchy,
    monitor,
    overlap,
    rebate,
    reconcile,
    reports,
    rules,
    seasonal,
    signals,
    texts,
    whatif,
)
from verisift.operators.adapters import adapter_for
from verisift.plans import bindings as b
from verisift.plans import jobs
from verisift.session import scratch_path, stored
from verisift.sources import catalog, feature_store, raw, tables
from verisift.sources.layout import Layout

AS_OF = "1998-06-30"
#: Rows of a raw JSON array, at most about.
ARRAY_ROWS = 1_000_000
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    out = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DecimalType, FractionalType)):
            # Six places by the same arithmetic as the SQL twins; adding 0 removes a
            # negative zero.
            value = F.round(value.cast("double") * 1e6) / 1e6 + F.lit(0.0)
        elif isinstance(field.dataType, IntegralType):
            value = value.cast("bigint")
        elif isinstance(field.dataType, (DateType, TimestampType)):
            value = value.cast("string")
        out.append(value.alias(field.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def _layout(spark: SparkSession, label: str) -> Layout:
    return Layout(scratch_path(spark, label))


# -- sources ---------------------------------------------------------------------


@query
def ingest_roundtrip(spark, sf):
    layout = _layout(spark, "ingest")
    raw.ingest(
        spark,
        f"{sf}/lineitem.parquet",
        "lineitem",
        layout,
        file_format="parquet",
        date="2024-01-31",
    )
    rows = raw.read_partition(spark, "lineitem", layout, date="2024-01-31")
    return rows.groupBy("date", "l_returnflag").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
    )


@query
def latest_partition(spark, sf):
    layout = _layout(spark, "latest")
    orders = b.table(spark, sf, "orders")
    is_open = F.col("o_orderstatus") == "O"
    raw.ingest_frame(orders.where(~is_open), "orders", layout, date="2024-01-01")
    raw.ingest_frame(orders.where(is_open), "orders", layout, date="2024-02-01")
    return (
        raw.read_partition(spark, "orders", layout)
        .groupBy("date", "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query
def published_scores(spark, sf):
    path = _layout(spark, "publish").gold("scores")
    scores = b.transactions(spark, sf, "transaction_id", "customer_id", "gross_amount")
    tables.publish_scores(scores, path, model_version="1.2.0", correlation_id="run-1", fmt="orc")
    return tables.read_table(spark, path, fmt="orc").drop("_audit_scored_at")


# -- adapters --------------------------------------------------------------------


def _adapted(entity: str, binding) -> Query:
    def run(spark, sf):
        return adapter_for(entity).transform(binding(spark, sf)).drop("ingested_at", "dq_score")

    return run


for _name, _entity, _binding in (
    ("adapter_867", "edi_867", b.raw_867),
    ("adapter_844", "edi_844", b.raw_844),
    ("adapter_849", "edi_849", b.raw_849),
    ("adapter_erp", "erp", b.raw_erp),
    ("adapter_claims", "claims", b.raw_claims),
    ("adapter_contracts", "contracts", b.raw_contracts),
):
    _run = _adapted(_entity, _binding)
    _run.__name__ = _name
    query(_run)


@query
def audit_columns(spark, sf):
    return stamp_audit(
        b.transactions(spark, sf, "transaction_id"),
        model_version="1.2.0",
        feature_versions='{"purchase_velocity": 3}',
        correlation_id="run-1",
        pipeline_name="gold_publisher",
    ).drop("_audit_scored_at")


# -- checks ----------------------------------------------------------------------


@query
def required_columns(spark, sf):
    terms = b.contracts(spark, sf)
    return checks.measure(terms, checks.required("contract_id", "expiration_date", "product_id"))


@query
def expected_periods(spark, sf):
    months = [f"{y}-{m:02d}" for y in range(1994, 2003) for m in range(1, 13)]
    tx = b.transactions(spark, sf, "transaction_date")
    return checks.missing_periods(tx, "transaction_date", months)


@query
def feed_completeness(spark, sf):
    feeds = ["0", "7", "warehouse-east", "9", "-1"]
    return checks.missing_sources(b.transactions(spark, sf, "distributor_id"), "distributor_id", feeds)


TX_KEY = ("transaction_id",)
TX_ORDER = ("distributor_id", "product_id", "quantity", "gross_amount", "transaction_type")


def _sortable(spark, sf):
    return b.transactions(spark, sf, *TX_KEY, *TX_ORDER)


@query
def duplicate_rate(spark, sf):
    return checks.duplicate_rate(b.transactions(spark, sf, *TX_KEY), TX_KEY)


@query
def flag_duplicates(spark, sf):
    return checks.flag_duplicates(_sortable(spark, sf), TX_KEY, TX_ORDER)


@query
def deduplicate(spark, sf):
    return checks.deduplicate(_sortable(spark, sf), TX_KEY, TX_ORDER)


def _reference_customers(spark, sf):
    """All customers; those of other segments under keys that no sale has."""
    known = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "").otherwise("X-")
    return b.table(spark, sf, "customer").select(
        F.concat(known, F.col("c_custkey").cast("string")).alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
    )


@query
def referential_integrity(spark, sf):
    return checks.referential_integrity(
        b.transactions(spark, sf, "customer_id"),
        "customer_id",
        _reference_customers(spark, sf),
        "customer_id",
    )


@query
def cross_source_alignment(spark, sf):
    columns = ["distributor_id", "product_id", "customer_id"]
    claims = b.chargebacks(spark, sf, "transaction_ref_id", *columns)
    return checks.cross_source_alignment(
        b.transactions(spark, sf, "transaction_id", *columns),
        claims.withColumnRenamed("transaction_ref_id", "transaction_id"),
        "transaction_id",
        columns,
    )


def _ordered_and_shipped(spark, sf):
    lines = b.table(spark, sf, "lineitem")
    orders = b.table(spark, sf, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_orderdate").cast("date").alias("ordered"),
        F.col("l_shipdate").cast("date").alias("shipped"),
    )


@query
def sla_compliance(spark, sf):
    return checks.measure(
        _ordered_and_shipped(spark, sf), [checks.within_sla("ordered", "shipped", 30)]
    )


@query
def staleness_score(spark, sf):
    tx = b.transactions(spark, sf, "transaction_id", "transaction_date")
    return checks.with_staleness(tx, "transaction_date", as_of=AS_OF)


@query
def value_range(spark, sf):
    tx = b.transactions(spark, sf, "quantity")
    return checks.measure(tx, [checks.in_range("quantity", 5, 40)])


@query
def outliers(spark, sf):
    tx = b.transactions(spark, sf, "transaction_id", "gross_amount")
    return checks.flag_outliers(tx, "gross_amount", z_threshold=1.5)


@query
def outliers_by_category(spark, sf):
    tx = b.transactions(spark, sf, "transaction_id", "gross_amount", "product_category")
    return checks.flag_outliers(
        tx, "gross_amount", z_threshold=1.5, within=["product_category"]
    )


@query
def valid_codes(spark, sf):
    claims = b.chargebacks(spark, sf, "claim_status")
    return checks.measure(claims, [checks.valid_codes("claim_status", ["approved", "pending"])])


@query
def date_logic(spark, sf):
    return checks.measure(_ordered_and_shipped(spark, sf), [checks.date_order("ordered", "shipped")])


@query
def positive_values(spark, sf):
    terms = b.contracts(spark, sf)
    return checks.measure(terms, checks.positive("discount_pct", "rebate_pct", "tier_count"))


# -- rules -----------------------------------------------------------------------


@query
def expectation_suite(spark, sf):
    return rules.run_suite(b.transactions(spark, sf), rules.TRANSACTION_SUITE)


@query
def feature_expectation_suite(spark, sf):
    return rules.run_suite(purchase_velocity(spark, sf), rules.FEATURE_SUITE)


def _rule_results(spark, sf):
    catalog_rules = spark.createDataFrame(
        [
            ("R-1", "in_range:quantity", 0.5),
            ("R-2", "positive", 0.95),
            ("R-3", "valid_codes:transaction_type", 0.9),
            ("R-4", "within_sla", 0.9),
        ],
        "id STRING, name STRING, threshold DOUBLE",
    )
    measured = checks.measure(
        b.transactions(spark, sf, "quantity", "gross_amount", "transaction_type"),
        [
            checks.in_range("quantity", 5, 40),
            *checks.positive("gross_amount"),
            checks.valid_codes("transaction_type", ["A", "R"]),
        ],
    )
    return rules.apply_rules(catalog_rules, measured)


@query
def rule_results(spark, sf):
    return _rule_results(spark, sf).select("rule_id", "passed", F.col("details.rate").alias("rate"))


# -- score and gate --------------------------------------------------------------

CLAIM_ORDER = ("distributor_id", "customer_id", "claim_amount", "claim_status")
GATE_THRESHOLD = 92.0


def _flagged_claims(spark, sf):
    claims = adapter_for("edi_844").transform(b.raw_844(spark, sf))
    marked = checks.flag_duplicates(claims.drop("ingested_at"), ["claim_id"], CLAIM_ORDER)
    return checks.with_staleness(marked, "claim_date", as_of=AS_OF, max_days=900)


def _claim_view(df):
    return df.select("claim_id", "distributor_id", "claim_amount", "_is_duplicate", "dq_score")


@query
def dq_score(spark, sf):
    return _claim_view(with_quality_score(_flagged_claims(spark, sf)))


@query
def dq_score_coded(spark, sf):
    return _claim_view(with_quality_score(_flagged_claims(spark, sf), count_score_column=True))


def _gated(spark, sf) -> Layout:
    layout = _layout(spark, "gate")
    gate.run_gate(
        _flagged_claims(spark, sf),
        "claims",
        layout=layout,
        threshold=GATE_THRESHOLD,
        checkpoint=True,
    )
    return layout


@query
def gate_passed(spark, sf):
    return _claim_view(spark.read.parquet(_gated(spark, sf).silver("claims")))


@query
def gate_quarantined(spark, sf):
    rows = spark.read.parquet(_gated(spark, sf).quarantine("claims"))
    return rows.select("claim_id", "claim_status", "dq_score", "_quarantine_reason")


@query
def gate_summary(spark, sf):
    return gate.gate_summary(with_quality_score(_flagged_claims(spark, sf)), GATE_THRESHOLD)


# -- features --------------------------------------------------------------------


def _sales(spark, sf, *more):
    return b.transactions(spark, sf, "customer_id", "transaction_date", "gross_amount", *more)


@query
def purchase_velocity(spark, sf):
    return customer.purchase_velocity(_sales(spark, sf))


@query
def velocity_rows(spark, sf):
    return customer.with_purchase_velocity(_sales(spark, sf, "transaction_id"))


@query
def ordering_regularity(spark, sf):
    return customer.ordering_regularity(_sales(spark, sf))


@query
def mix_entropy(spark, sf):
    return customer.mix_entropy(b.transactions(spark, sf, "customer_id", "product_category"))


@query
def loyalty_index(spark, sf):
    return customer.loyalty_index(_sales(spark, sf, "distributor_id"))


@query
def rate_of_change(spark, sf):
    monthly = (
        _sales(spark, sf)
        .groupBy("customer_id", F.date_format("transaction_date", "yyyy-MM").alias("period"))
        .agg(F.sum("gross_amount").alias("sales"))
    )
    return customer.with_rate_of_change(monthly, ["customer_id"], "period", "sales", lags=(1, 3))


@query
def contract_complexity(spark, sf):
    return contract.contract_complexity(b.contracts(spark, sf), as_of=AS_OF)


@query
def days_to_expiration(spark, sf):
    return contract.days_to_expiration(b.contracts(spark, sf), as_of=AS_OF)


@query
def contract_overlap(spark, sf):
    return contract.contract_overlap(b.contracts(spark, sf), as_of=AS_OF)


@query
def tier_proximity(spark, sf):
    tiers = (
        contract.active_contracts(b.contracts(spark, sf), AS_OF)
        .select(
            "contract_id",
            "customer_id",
            F.transform(
                F.sequence(F.lit(1), F.col("tier_count")),
                lambda i: (i * 50000).cast("decimal(18,4)"),
            ).alias("thresholds"),
        )
    )
    return contract.tier_proximity(tiers, _sales(spark, sf), as_of=AS_OF)


@query
def rebate_ratio(spark, sf):
    return rebate.rebate_to_sales_ratio(b.accruals(spark, sf), _sales(spark, sf))


def _claims_with_sales(spark, sf):
    claims = b.chargebacks(
        spark, sf, "distributor_id", "transaction_ref_id", "claim_date", "submission_count"
    )
    return claims, b.transactions(spark, sf, "transaction_id", "transaction_date")


@query
def submission_counts(spark, sf):
    return rebate.submission_counts(_claims_with_sales(spark, sf)[0])


@query
def submission_lag(spark, sf):
    return rebate.submission_lag(*_claims_with_sales(spark, sf))


@query
def over_under(spark, sf):
    return rebate.over_under_payment(b.accruals(spark, sf))


@query
def rebate_velocity(spark, sf):
    return rebate.rebate_velocity(b.accruals(spark, sf))


@query
def rebate_velocity_rows(spark, sf):
    return rebate.rebate_velocity(b.accruals(spark, sf), frame="rows")


@query
def distributor_errors(spark, sf):
    claims = b.chargebacks(spark, sf, "distributor_id", "claim_status", "submission_count")
    return rebate.distributor_errors(claims)


def _market(spark, sf, *more):
    return b.transactions(spark, sf, "transaction_date", "gross_amount", "product_category", *more)


@query
def seasonal_index(spark, sf):
    return seasonal.seasonal_index(_market(spark, sf), "PROMO")


@query
def seasonal_indices(spark, sf):
    return seasonal.seasonal_indices(_market(spark, sf))


@query
def regional_cycle(spark, sf):
    return seasonal.seasonal_indices(_market(spark, sf, "region"), ["region", "product_category"])


@query
def yoy_growth(spark, sf):
    return seasonal.yoy_growth(_sales(spark, sf, "product_id"))


@query
def vaccine_season(spark, sf):
    tx = b.transactions(spark, sf, "transaction_id", "transaction_date")
    return seasonal.with_vaccine_season(tx, "transaction_date")


@query
def source_completeness(spark, sf):
    return signals.with_source_completeness(b.contracts(spark, sf))


@query
def staleness_days(spark, sf):
    tx = b.transactions(spark, sf, "transaction_id", "transaction_date")
    return signals.with_staleness_days(tx, "transaction_date", as_of=AS_OF)


def _matched(spark, sf, mode):
    tx = b.transactions(spark, sf, "transaction_id", "customer_id", "customer_segment")
    return signals.with_match_confidence(
        tx,
        ["customer_id", "customer_segment"],
        _reference_customers(spark, sf)
        .withColumn("segment", F.when(F.col("segment") == "BUILDING", "BUILDING").otherwise("OTHER"))
        .unionByName(
            _reference_customers(spark, sf).withColumn("segment", F.lit("MACHINERY"))
        ),
        ["customer_id", "segment"],
        mode=mode,
    )


@query
def match_any(spark, sf):
    return _matched(spark, sf, "any")


@query
def match_all(spark, sf):
    return _matched(spark, sf, "all")


@query
def near_duplicates(spark, sf):
    claims = b.chargebacks(spark, sf, "claim_id", "customer_id", "distributor_id", "claim_date")
    return signals.with_duplicate_probability(
        claims, ["customer_id", "distributor_id"], "claim_date", max_days=30
    )


# -- store, catalog, lineage -----------------------------------------------------


@query
def feature_versions(spark, sf):
    layout = _layout(spark, "features")
    velocity = customer.purchase_velocity(_sales(spark, sf))
    large = F.col("purchase_velocity_90d") >= 200000
    place = (layout, "customer_behavior", "purchase_velocity")
    feature_store.write_feature_table(velocity.where(large), *place)
    second = feature_store.write_feature_table(velocity.where(~large), *place, mode="append")
    feature_store.write_feature_table(velocity.where(large), *place)
    return feature_store.read_feature_table(spark, *place, version=second)


@query
def feature_pipeline(spark, sf):
    """Raw lines to Silver, enriched, to stored features of one domain."""
    layout = _layout(spark, "pipeline-features")
    raw.ingest_frame(b.raw_867(spark, sf), "edi_867", layout, date="2024-01-31")
    silver = jobs.silver_job(spark, "edi_867", layout).passed
    products = b.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_type").alias("product_category")
    )
    customers = b.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_mktsegment").alias("customer_segment")
    )
    entities = {"transaction": silver, "product": products, "customer": customers}
    jobs.feature_job(entities, layout, domain="customer_behavior")
    return feature_store.read_feature_table(spark, layout, "customer_behavior", "mix_entropy")


@query
def feature_manifest(spark, sf):
    layout = _layout(spark, "manifest")
    place = (layout, "contract_complexity", "contract_features")
    complexity = contract.contract_complexity(b.contracts(spark, sf), as_of=AS_OF)
    feature_store.write_feature_table(complexity, *place)
    feature_store.write_feature_table(
        complexity, *place, mode="append", partition_by=["active_contract_count"]
    )
    return feature_store.feature_versions(spark, *place).select(
        "version", F.size("parts").alias("part_count"), "row_count"
    )


def _registrations(spark, sf):
    """Parts as feature registrations; sizes as versions, keys as time."""
    return b.table(spark, sf, "part").select(
        F.col("p_name").alias("name"),
        F.col("p_size").cast("string").alias("version"),
        F.col("p_brand").alias("domain"),
        F.col("p_type").alias("definition"),
        F.timestamp_seconds("p_partkey").alias("registered_at"),
    )


@query
def catalog_search(spark, sf):
    return catalog.search_features(_registrations(spark, sf), "RING")


@query
def catalog_get(spark, sf):
    return catalog.get_feature_definition(_registrations(spark, sf), "red widget")


@query
def lineage_upstream(spark, sf):
    def edge(df, source, target):
        return df.select(source.alias("source"), target.alias("target"))

    def node(kind, column):
        return F.concat_ws("-", F.lit(kind), F.col(column))

    orders, customers = b.table(spark, sf, "orders"), b.table(spark, sf, "customer")
    edges = (
        edge(orders, node("customer", "o_custkey"), node("order", "o_orderkey"))
        .unionByName(edge(customers, node("nation", "c_nationkey"), node("customer", "c_custkey")))
        .unionByName(
            edge(
                b.table(spark, sf, "nation"),
                node("region", "n_regionkey"),
                node("nation", "n_nationkey"),
            )
        )
    )
    return catalog.upstream(edges, orders.select(node("order", "o_orderkey").alias("asset")))


# -- monitoring ------------------------------------------------------------------


@query
def null_rates(spark, sf):
    return monitor.null_rates(b.accruals(spark, sf))


@query
def feature_health(spark, sf):
    complexity = contract.contract_complexity(b.contracts(spark, sf), as_of=AS_OF)
    newest = b.contracts(spark, sf).groupBy("customer_id").agg(
        F.max("effective_date").alias("newest_contract")
    )
    return monitor.feature_health(
        complexity.join(newest, "customer_id"),
        "contract_features",
        timestamp_col="newest_contract",
        as_of="2002-01-01 12:00:00",
    )


@query
def training_join(spark, sf):
    return monitor.training_join(
        [
            purchase_velocity(spark, sf),
            contract_complexity(spark, sf),
            ordering_regularity(spark, sf),
        ],
        "customer_id",
    )


@query
def profile(spark, sf):
    return monitor.profile(
        b.transactions(
            spark, sf, "transaction_id", "customer_id", "transaction_date", "quantity", "gross_amount"
        )
    )


@query
def drift_psi(spark, sf):
    lines = b.table(spark, sf, "lineitem").select(
        "l_quantity", "l_discount", "l_linenumber", "l_linestatus"
    )
    return drift.population_stability(
        lines.where(F.col("l_linestatus") == "F"),
        lines.where(F.col("l_linestatus") == "O"),
        ["l_quantity", "l_discount", "l_linenumber"],
    )


@query
def drift_ks(spark, sf):
    lines = b.table(spark, sf, "lineitem").select("l_extendedprice", "l_linestatus")
    return drift.kolmogorov_smirnov(
        lines.where(F.col("l_linestatus") == "F"),
        lines.where(F.col("l_linestatus") == "O"),
        "l_extendedprice",
    )


# -- metrics ---------------------------------------------------------------------


def _price_guess(spark, sf):
    lines, part = b.table(spark, sf, "lineitem"), b.table(spark, sf, "part")
    predicted = lines.join(part, lines["l_partkey"] == part["p_partkey"]).select(
        F.col("l_extendedprice").alias("actual"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("predicted"),
    )
    return metrics.regression_metrics(predicted, "actual", "predicted")


@query
def regression_metrics(spark, sf):
    return _price_guess(spark, sf)


def _suspected(spark, sf):
    claims = b.chargebacks(spark, sf, "claim_amount", "claim_status")
    return claims.withColumn("is_leakage", F.col("claim_amount") > 4000)


@query
def leakage_metrics(spark, sf):
    return metrics.leakage_metrics(_suspected(spark, sf))


def _classes(spark, sf):
    lines = b.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus")
    guess = F.when(F.col("l_linestatus") == "F", "R").otherwise("N")
    return metrics.confusion(lines.withColumn("guess", guess), "l_returnflag", "guess")


@query
def class_metrics(spark, sf):
    return metrics.class_metrics(_classes(spark, sf))


@query
def class_report(spark, sf):
    return metrics.class_report(_classes(spark, sf))


@query
def returns_metrics(spark, sf):
    lines = b.table(spark, sf, "lineitem").select(
        F.col("l_returnflag") == "R",
        (F.col("l_discount") >= 0.05).alias("guess"),
        "l_extendedprice",
    ).toDF("returned", "guess", "score")
    return metrics.returns_metrics(lines, "returned", "guess", "score")


# -- models ----------------------------------------------------------------------


def _customer_features(spark, sf, keep=lambda df: df):
    return monitor.training_join(
        [
            keep(ordering_regularity(spark, sf)),
            keep(purchase_velocity(spark, sf)),
            keep(customer.mix_entropy(b.transactions(spark, sf, "customer_id", "product_category"))),
        ],
        "customer_id",
    )


ACCRUAL_FEATURES = ["avg_order_gap_days", "purchase_velocity_30d", "purchase_velocity_90d", "species_mix_entropy"]


def _accrual_training(spark, sf):
    """One row per customer, stored. The joins of all lines behind it run once and one after the other, and the
    shuffles of each go before the next one."""

    def keep(df):
        return stored(df, "accrual-features")

    accrued = keep(b.accruals(spark, sf).groupBy("customer_id").agg(F.sum("accrual_amount").alias("accrual_amount")))
    training = _customer_features(spark, sf, keep).join(accrued, "customer_id").select(
        "customer_id", "accrual_amount", *[F.col(c).cast("double").alias(c) for c in ACCRUAL_FEATURES]
    )
    return stored(training, "accrual-training")


@query
def accrual_model(spark, sf):
    training = _accrual_training(spark, sf)
    trained = accrual.train(training, ACCRUAL_FEATURES)
    scored = accrual.score(trained.model, training, model_version="1.0.0")
    return scored.select("customer_id", "accrual_amount", "predicted_accrual")


@query
def accrual_model_report(spark, sf):
    """What must hold of every forecast: each row scored, better than the mean, also left out."""
    training = _accrual_training(spark, sf)
    trained = accrual.train(training, ACCRUAL_FEATURES)
    scored = accrual.score(trained.model, training, model_version="1.0.0")
    y, p = F.col("accrual_amount").cast("double"), F.col("predicted_accrual")
    mean = training.agg(F.avg(F.col("accrual_amount").cast("double"))).scalar()
    return scored.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(p.isNotNull() & ~F.isnan(p)).alias("scored"),
        F.sum("accrual_amount").alias("accrual_amount"),
        (F.avg(F.abs(y - p)) < F.avg(F.abs(y - mean))).alias("fits_better_than_mean"),
        (F.lit(trained.metrics["cv_mae_mean"]) < F.avg(F.abs(y - mean))).alias("predicts_better_than_mean"),
        F.lit(len(trained.model.feature)).alias("trees"),
    )


CLAIM_FEATURES = ["claim_amount", "l_quantity", "l_discount", "l_tax"]


def _leakage_scores(spark, sf):
    """Every line as a claim, scored by a forest of all of them that went through storage."""
    claims = b.table(spark, sf, "lineitem").select(
        F.concat_ws("-", F.lit("CB"), "l_orderkey", "l_linenumber", "l_partkey").alias("claim_id"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("claim_amount"),
        "l_quantity",
        "l_discount",
        "l_tax",
    )
    place = _layout(spark, "leakage").gold("models/leakage/1.0.0")
    leakage.train(claims, CLAIM_FEATURES).save(place)
    return leakage.score(leakage.IsolationForest.load(spark, place), claims, model_version="1.0.0")


@query
def leakage_model(spark, sf):
    return _leakage_scores(spark, sf).select("claim_id", "claim_amount", "anomaly_score", "is_leakage")


@query
def leakage_model_report(spark, sf):
    """What must hold of every forest: each claim scored, the share below the offset as asked."""
    scored = _leakage_scores(spark, sf)
    share = F.count_if("is_leakage") / F.count(F.lit(1))
    known = F.count_if(F.col("anomaly_score").isNotNull() & ~F.isnan("anomaly_score"))
    return scored.agg(
        F.count(F.lit(1)).alias("claims"),
        known.alias("scored"),
        F.sum(F.col("claim_amount").cast("decimal(18,4)")).alias("claim_amount"),
        (share <= leakage.DEFAULTS["contamination"]).alias("flags_at_most_its_share"),
        (F.count_if(F.col("is_leakage") != (F.col("anomaly_score") < 0)) == 0).alias("flags_are_negative_scores"),
    )


@query
def text_model(spark, sf):
    documents = b.table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("remittance_text"), F.col("lang").alias("deduction_type")
    )
    trained = deduction.train(documents)
    scored = deduction.score(trained.model, documents, model_version="1.0.0")
    return scored.select(
        "doc_id", "deduction_type", "predicted_deduction_type", "prediction_confidence"
    )


@query
def returns_model(spark, sf):
    features = ["l_quantity", "l_discount", "l_tax", "l_extendedprice", "ship_month"]
    lines = b.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_returnflag") == "R").alias("is_returned"),
        *features[:-1],
        F.month("l_shipdate").alias("ship_month"),
    )
    trained = returns.train(lines, features)
    scored = returns.score(trained.model, lines, model_version="1.0.0")
    return scored.select(
        "l_orderkey", "l_linenumber", "is_returned", "return_probability", "predicted_return"
    )


def _runs(spark, sf):
    """One training run per supplier and ship month, measured on its lines."""
    lines = b.table(spark, sf, "lineitem")
    month = F.date_format("l_shipdate", "yyyy-MM")
    stage = F.when(F.substring("month", 6, 2) == "12", "production").otherwise("staging")
    return (
        lines.groupBy("l_suppkey", month.alias("month"))
        .agg(
            F.avg("l_quantity").alias("quantity"),
            F.avg("l_discount").alias("discount"),
            F.max("l_shipdate").alias("last_day"),
        )
        .select(
            F.concat_ws("-", F.lit("run"), "l_suppkey", "month").alias("run_id"),
            F.concat_ws("-", F.lit("model"), "l_suppkey").alias("model_name"),
            stage.alias("stage"),
            F.create_map(F.lit("mae"), F.col("quantity")).alias("metrics"),
            (F.col("discount") * 1000).alias("data_quality"),
            F.concat("month", F.lit("-01")).cast("timestamp").alias("started_at"),
        )
    )


@query
def model_runs(spark, sf):
    path = _layout(spark, "runs").catalog("model_runs")
    tables.write_table(_runs(spark, sf), path)
    runs = tables.read_table(spark, path)
    return tracking.latest(runs, "model_name").select(
        "run_id", "model_name", "stage", F.col("metrics")["mae"].alias("mae")
    )


@query
def model_stages(spark, sf):
    return tracking.model_stages(_runs(spark, sf)).select("model_name", "stage", "run_id")


@query
def model_cards(spark, sf):
    """The newest card of every model, with its parameters unfolded."""
    cards = b.table(spark, sf, "part").select(
        F.col("p_name").alias("name"),
        F.col("p_partkey").alias("revision"),
        F.col("p_brand").alias("training_dataset"),
        F.create_map(F.lit("size"), F.col("p_size").cast("string")).alias("parameters"),
    )
    newest = tracking.latest(cards, "name", order="revision")
    return newest.select(
        "name", "revision", "training_dataset", F.col("parameters")["size"].alias("size")
    )


@query
def governance(spark, sf):
    return reports.governance_summary(_runs(spark, sf), metric="mae")


# -- what-if ---------------------------------------------------------------------

SCENARIOS = (
    whatif.Scenario("current", "BUILDING", [0, 20000, 50000], [0.02, 0.03, 0.05], [0.01, 0.02, 0.02]),
    whatif.Scenario("flat", "BUILDING", [0], [0.08], [0.0]),
    whatif.Scenario("steep", "MACHINERY", [10000, 60000, 90000], [0.05, 0.1], [0.02, 0.02, 0.04]),
    whatif.Scenario("nowhere", "ABSENT", [0, 10], [0.5, 0.5], [0.1, 0.1]),
    whatif.Scenario("fine", "HOUSEHOLD", [0, 20000.12345], [0.012551, 0.00005], [0, 0.015]),
)


def _simulated(spark, sf):
    sales = b.transactions(spark, sf, "customer_segment", "gross_amount")
    return sales, whatif.scenario_frame(spark, SCENARIOS)


@query
def whatif_simulation(spark, sf):
    return whatif.simulate(*_simulated(spark, sf))


@query
def whatif_compare(spark, sf):
    return whatif.compare_scenarios(*_simulated(spark, sf))


@query
def whatif_impact(spark, sf):
    return whatif.scenario_impact(whatif.compare_scenarios(*_simulated(spark, sf)), "current")


# -- reports ---------------------------------------------------------------------


@query
def accrual_health(spark, sf):
    return reports.accrual_health(b.accruals(spark, sf))


@query
def accrual_trend(spark, sf):
    return reports.accrual_trend(b.accruals(spark, sf))


@query
def variance_drivers(spark, sf):
    return reports.top_variance_drivers(b.accruals(spark, sf), 20)


@query
def leakage_summary(spark, sf):
    return reports.leakage_summary(_suspected(spark, sf))


@query
def feature_fleet(spark, sf):
    """Three tables as features: one fresh, one with gaps, one drifting or stale by its dates."""
    orders, lines = b.table(spark, sf, "orders"), b.table(spark, sf, "lineitem")
    as_of = "2001-08-15 00:00:00"
    health = (
        monitor.feature_health(orders, "orders", timestamp_col="o_orderdate", as_of=as_of)
        .unionByName(
            monitor.feature_health(lines, "lines", timestamp_col="l_shipdate", as_of=as_of)
        )
        .unionByName(monitor.feature_health(b.accruals(spark, sf), "accruals"))
    )
    shift = drift.population_stability(
        lines.where(F.col("l_linestatus") == "F"),
        lines.where(F.col("l_linestatus") == "O"),
        ["l_quantity", "l_discount"],
    )
    return reports.feature_fleet(health, shift.withColumn("feature", F.lit("lines")))


@query
def claim_match(spark, sf):
    claims = b.chargebacks(spark, sf, "claim_id", "transaction_ref_id", "claim_amount")
    sales = b.transactions(spark, sf, "transaction_id", "transaction_date", "gross_amount")
    late = F.when(F.col("transaction_date") < AS_OF, "").otherwise("L-")
    early = sales.withColumn("transaction_id", F.concat(late, "transaction_id"))
    return reconcile.match_claims(claims, early)


@query
def as_of_terms(spark, sf):
    """Each sale with the customer's latest contract terms at the time."""
    terms = b.contracts(spark, sf).select(
        "customer_id", "effective_date", "tier_count", "discount_pct"
    )
    return reconcile.as_of_join(
        _sales(spark, sf, "transaction_id"),
        terms,
        ["customer_id"],
        at="transaction_date",
        valid_from="effective_date",
        values=["tier_count", "discount_pct"],
    )


# -- overlaps, hierarchies and allocation ------------------------------------------


@query
def near_duplicate_claims(spark, sf):
    """Claims near another of the same customer in both date and amount."""
    claims = b.table(spark, sf, "lineitem").join(
        b.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("claim_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_shipdate").cast("date").alias("claim_date"),
        (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)").alias("claim_amount"),
    )
    return duplicates.with_duplicate_closeness(
        claims, ["customer_id"], "claim_date", "claim_amount", max_days=10, max_amount=50.0
    )


@query
def near_duplicate_texts(spark, sf):
    """Texts that repeat or resemble an earlier one, whatever their language or source."""
    documents = b.table(spark, sf, "documents").select("doc_id", "text")
    return texts.with_text_duplicates(documents, "doc_id", "text").select("doc_id", "feat_text_copies", "feat_text_duplicate")


@query
def contract_overlap_between(spark, sf):
    return overlap.contract_overlap_between(b.contracts(spark, sf), "1995-03-01", "1997-09-30")


@query
def hierarchy_closure(spark, sf):
    return hierarchy.dated_closure(b.memberships(spark, sf))


@query
def hierarchy_on_day(spark, sf):
    return hierarchy.hierarchy_as_of(hierarchy.dated_closure(b.memberships(spark, sf)), AS_OF)


@query
def hierarchy_sales(spark, sf):
    """Sales by group and parent, as customers belonged on the day of each sale."""
    sales = _sales(spark, sf, "transaction_id")
    return hierarchy.rolled_up(
        sales, hierarchy.dated_closure(b.memberships(spark, sf)), member="customer_id", at="transaction_date", value="gross_amount"
    )


def _claimed_and_sold(spark, sf):
    """Claims of three units for every two sold, so that some stay open."""
    lines = b.table(spark, sf, "lineitem").join(
        b.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    keys = [F.col("o_custkey").cast("string").alias("customer_id"), F.col("l_linestatus").alias("product_id")]
    sales = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        *keys,
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("l_quantity").cast("decimal(18,4)").alias("quantity"),
    )
    claims = lines.select(
        F.concat_ws("-", F.lit("CB"), "l_orderkey", "l_linenumber").alias("claim_id"),
        *keys,
        F.col("l_shipdate").cast("date").alias("claim_date"),
        (F.col("l_quantity") * 1.5).cast("decimal(18,4)").alias("quantity"),
    )
    return claims, sales


@query
def claims_to_sales(spark, sf):
    return allocation.allocate_claims(*_claimed_and_sold(spark, sf))


@query
def claims_allocated(spark, sf):
    claims, sales = _claimed_and_sold(spark, sf)
    return allocation.claim_allocation(claims, allocation.allocate_claims(claims, sales))


# -- through the write paths -------------------------------------------------------


@query
def rules_pushed(spark, sf):
    """Rule results pushed to the results table and read back from their JSON."""
    layout = _layout(spark, "rules")
    rules.push_results(_rule_results(spark, sf), layout)
    pushed = spark.read.parquet(layout.catalog("dq_results"))
    return pushed.select("rule_id", "passed", F.get_json_object("details", "$.rate").cast("double").alias("rate"))


@query
def quarantine_notices(spark, sf):
    """A notice per environment about the claims its threshold would quarantine."""
    layout = _layout(spark, "notices")
    scored = with_quality_score(_flagged_claims(spark, sf))
    places = {**gate.THRESHOLDS, "strict": GATE_THRESHOLD}
    counts = scored.agg(*[F.count_if(F.col("dq_score") < least).alias(env) for env, least in places.items()]).first()
    for env in places:
        gate.notify_quarantine(spark, f"claims-{env}", counts[env], layout)
    notices = spark.read.parquet(layout.catalog("dq_results"))
    return notices.select(
        "rule_id",
        "passed",
        F.get_json_object("details", "$.count").cast("long").alias("quarantined"),
        F.get_json_object("details", "$.reason").alias("reason"),
    )


@query
def read_formats(spark, sf):
    """Orders written as CSV, as JSON lines and as JSON arrays per month, then read as raw files.

    An array is read by one task, so a month is cut into arrays of a bounded number of rows.
    Numbers of an array are read as decimals: as text, Spark goes back to the file for each.
    """
    place = scratch_path(spark, "formats")
    orders = b.table(spark, sf, "orders").select(
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,4)").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
    )
    orders.write.option("header", "true").csv(f"{place}/csv")
    orders.write.json(f"{place}/lines")
    pieces = math.ceil(orders.count() / ARRAY_ROWS)
    piece = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(pieces, 1)))
    months = orders.withColumn("piece", piece).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "piece").agg(
        F.to_json(F.collect_list(F.struct(*orders.columns))).alias("value")
    )
    months.write.partitionBy("month", "piece").text(f"{place}/array")
    exact = {"primitivesAsString": "false", "prefersDecimal": "true"}
    given = {
        "csv": raw.read_raw(spark, f"{place}/csv"),
        "json lines": raw.read_raw(spark, f"{place}/lines", file_format="json"),
        "json array": raw.read_raw(spark, f"{place}/array", file_format="json", document="array", options=exact),
    }
    every = None
    for name, rows in given.items():
        counted = rows.groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col("o_totalprice").cast("decimal(18,4)")).alias("total"),
            F.min(F.col("o_orderdate").cast("date")).alias("first_day"),
        ).select(F.lit(name).alias("format"), "o_orderstatus", "row_count", "total", "first_day")
        every = counted if every is None else every.unionByName(counted)
    return every


@query
def feature_access(spark, sf):
    """A feature registered, found in the catalog and pulled by its name and version."""
    layout = _layout(spark, "access")
    domain, name = "customer_behavior", "purchase_velocity"
    version = feature_store.write_feature_table(customer.purchase_velocity(_sales(spark, sf)), layout, domain, name)
    for text in ("Sales of a customer over trailing days", "Sales of a customer over 30, 60 and 90 trailing days"):
        catalog.register_feature(
            spark, layout, catalog.FeatureDefinition(name, domain, text, "windows", ["transaction"], str(version))
        )
    access = catalog.Features(spark, layout)
    known = access.list_features("VELOCITY").select("domain", F.col("version").alias("feature_version"))
    return access.get_feature(domain, name, version=version).crossJoin(F.broadcast(known))


@query
def recorded_runs(spark, sf):
    """A run with measured metrics recorded, promoted and read back beside its card."""
    layout = _layout(spark, "tracking")
    measured = _price_guess(spark, sf).first().asDict()
    run = tracking.record_run(
        spark, layout, model_name="price_guess", use_case="prices", metrics=measured, params={"unit": "lines"}
    )
    tracking.promote(spark, layout, run, "production")
    card = tracking.ModelCard("price_guess", "List price", "prices", "lineitem", metrics=measured, parameters={"unit": "lines"})
    tracking.record_card(spark, layout, card)
    runs = tracking.latest(spark.read.parquet(layout.catalog("model_runs")), "run_id")
    cards = spark.read.parquet(layout.catalog("model_cards")).select(F.col("name").alias("model_name"), "training_dataset", "parameters")
    values = [F.col("metrics")[m].alias(m) for m in ("mae", "rmse", "r2")]
    return runs.join(cards, "model_name").select(
        "model_name", "stage", *values, "training_dataset", F.col("parameters")["unit"].alias("unit")
    )


@query
def training_weights(spark, sf):
    """What the claims of each distributor weigh in a training, by their quality scores."""
    scored = with_quality_score(_flagged_claims(spark, sf))
    return scored.withColumn("w", quality_weight(scored)).groupBy("distributor_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("w").alias("weight")
    )


@query
def run_correlation(spark, sf):
    """Every row of a run carries the one id of the run."""
    lines = stamp_audit(b.table(spark, sf, "lineitem"), correlation_id=new_correlation_id())
    return lines.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("_audit_correlation_id").alias("runs"),
        F.bool_and(F.col("_audit_correlation_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("is_uuid"),
    )
