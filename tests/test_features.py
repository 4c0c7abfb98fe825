"""Edge cases by hand, and the fast forms against plain ones."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import Window as W, functions as F

from verisift.operators import contract, customer, drift, monitor, rebate, reconcile, reports, seasonal, signals
from verisift.operators.drift import kolmogorov_smirnov
from verisift.plans import bindings as b

SF = "/root/testdata/sf0.001"


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def sales(spark):
    return b.transactions(
        spark, SF, "transaction_id", "customer_id", "transaction_date", "gross_amount", "product_category"
    ).cache()


def tx(spark, *rows):
    return spark.createDataFrame(
        [(c, day(d) if d else None, float(a)) for c, d, a in rows],
        "customer_id string, transaction_date date, gross_amount double",
    ).withColumn("gross_amount", F.col("gross_amount").cast("decimal(18,4)"))


def test_velocity_equals_a_range_window(spark, sales, rows):
    window = W.partitionBy("customer_id").orderBy(F.unix_date("transaction_date")).rangeBetween(-60, 0)
    plain = (
        sales.withColumn("v", F.sum("gross_amount").over(window))
        .groupBy("customer_id")
        .agg(F.max_by("v", "transaction_date").alias("v"))
    )
    assert rows(customer.purchase_velocity(sales, [60])) == rows(plain)
    per_row = customer.with_purchase_velocity(sales, [60]).select("transaction_id", "purchase_velocity_60d")
    assert rows(per_row) == rows(sales.select("transaction_id", F.sum("gross_amount").over(window)))


def test_velocity_window_is_inclusive(spark):
    df = tx(spark, ("a", "2024-01-01", 1), ("a", "2024-01-31", 2), ("a", None, 50), ("n", None, 4))
    found = {r[0]: r[1:] for r in customer.purchase_velocity(df, [29, 30]).collect()}
    assert found["a"] == (2, 3)
    assert found["n"] == (None, None)


def test_regularity_equals_gaps_between_rows(spark, sales):
    gap = F.datediff(
        "transaction_date",
        F.lag("transaction_date").over(W.partitionBy("customer_id").orderBy("transaction_date")),
    )
    plain = (
        sales.withColumn("g", gap)
        .where("g is not null")
        .groupBy("customer_id")
        .agg(F.avg("g").alias("m"), F.stddev_samp("g").alias("s"))
    )
    ours = customer.ordering_regularity(sales)
    both = ours.join(plain, "customer_id").collect()
    assert len(both) == plain.count() == ours.count()
    for r in both:
        assert r["avg_order_gap_days"] == pytest.approx(r["m"])
        if r["s"] is None:
            assert r["stddev_order_gap_days"] is None
        else:
            assert r["stddev_order_gap_days"] == pytest.approx(r["s"], abs=1e-9)


def test_regularity_edges(spark):
    df = tx(
        spark,
        ("single", "2024-01-01", 1),
        ("same", "2024-01-01", 1),
        ("same", "2024-01-01", 1),
        ("same", "2024-01-01", 1),
        ("two", "2024-01-01", 1),
        ("two", "2024-01-11", 1),
    )
    found = {r[0]: tuple(r[1:]) for r in customer.ordering_regularity(df).collect()}
    assert found == {"same": (0.0, 0.0, None), "two": (10.0, None, None)}


def test_entropy(spark, sales):
    df = spark.createDataFrame(
        [("one", "x")] * 7 + [("half", "x"), ("half", "y"), ("gap", None), ("gap", "x")],
        "customer_id string, product_category string",
    )
    found = {r[0]: r[1] for r in customer.mix_entropy(df).collect()}
    assert found == {"one": 0.0, "half": 1.0, "gap": 1.0}
    counts = {}
    for r in sales.select("customer_id", "product_category").collect():
        counts.setdefault(r[0], []).append(r[1])
    for r in customer.mix_entropy(sales).collect():
        values = counts[r[0]]
        shares = [values.count(v) / len(values) for v in set(values)]
        assert r[1] == pytest.approx(-sum(p * math.log2(p) for p in shares), abs=1e-9)


def contracts(spark, *rows):
    return spark.createDataFrame(
        [(i, c, p, day(s), day(e) if e else None) for i, c, p, s, e in rows],
        "contract_id string, customer_id string, product_id string, effective_date date, expiration_date date",
    ).withColumns({"tier_count": F.lit(2), "multi_product_flag": F.lit("Y"), "discount_pct": F.lit(0.1), "rebate_pct": F.lit(0.2)})


def test_contract_features(spark, rows):
    df = contracts(
        spark,
        ("1", "a", "p", "2024-01-01", None),
        ("2", "a", "p", "2024-01-01", "2024-06-30"),
        ("2", "a", "p", "2024-01-01", "2024-06-30"),
        ("3", "a", None, "2024-01-01", None),
        ("4", "a", None, "2024-01-01", None),
        ("5", "b", "p", "2024-07-01", "2024-12-31"),
        ("6", "b", "p", "2023-01-01", "2024-06-29"),
        ("7", None, "p", "2024-01-01", None),
        ("8", None, "p", "2024-01-01", None),
    )
    at = "2024-06-30"
    # Ids 1-2 twice; a NULL product or customer pairs with nothing.
    assert rows(contract.contract_overlap(df, as_of=at)) == [("a", 2)]
    assert rows(contract.days_to_expiration(df, as_of=at)) == [("a", 0), ("b", 184)]
    found = {r["customer_id"]: r for r in contract.contract_complexity(df, as_of=at).collect()}
    assert set(found) == {"a", None}
    assert found["a"]["active_contract_count"] == 5 and found["a"]["total_active_tiers"] == 10


def test_tier_proximity(spark):
    tiers = spark.createDataFrame([("1", "a"), ("2", "z")], "contract_id string, customer_id string").withColumn(
        "thresholds", F.array(F.lit(100), F.lit(200)).cast("array<decimal(18,4)>")
    )
    df = tx(spark, ("a", "2024-02-01", 150), ("a", "2023-12-31", 999), ("a", "2024-08-01", 999))
    found = {r["contract_id"]: r for r in contract.tier_proximity(tiers, df, as_of="2024-07-01").collect()}
    assert found["1"]["next_threshold"] == 200 and found["1"]["tier_proximity_pct"] == 0.75
    assert found["1"]["days_to_tier_reset"] == 184
    assert found["2"]["ytd_sales"] == 0 and found["2"]["amount_to_next_tier"] == 100


def accruals(spark, *rows):
    return spark.createDataFrame(rows, "customer_id string, period string, accrual_amount double")


def test_rebate_velocity_months_and_rows(spark, rows):
    df = accruals(
        spark,
        ("a", "2023-11", 1.0),
        ("a", "2024-01", 2.0),
        ("a", "2024-01", 3.0),
        ("a", "2024-03", 4.0),
    )
    assert rows(rebate.rebate_velocity(df, [1, 3, 5])) == [("a", 4.0, 9.0, 10.0)]
    assert rows(rebate.rebate_velocity(df, [1, 2, 3], frame="rows")) == [("a", 4.0, 9.0, 10.0)]
    with pytest.raises(ValueError, match="frame"):
        rebate.rebate_velocity(df, frame="days")


def test_rebate_ratio_without_sales_or_rebate(spark):
    df = tx(spark, ("a", "2024-01-01", 0), ("a", "2024-02-01", 10), ("b", "2024-01-01", 10))
    paid = accruals(spark, ("a", "2024-01", 5.0), ("a", "2024-02", 5.0), ("c", "2024-01", 1.0))
    found = {(r[0], r[1]): r["rebate_to_sales_ratio"] for r in rebate.rebate_to_sales_ratio(paid, df).collect()}
    assert found == {("a", "2024-01"): 0.0, ("a", "2024-02"): 0.5, ("b", "2024-01"): 0.0}


def test_submission_lag_with_repeated_and_unknown_references(spark):
    claims = spark.createDataFrame(
        [("d", "t1", day("2024-01-11"), 1), ("d", "t1", day("2024-01-21"), 3), ("d", "zz", day("2024-01-21"), None), ("d", None, day("2024-01-21"), 9)],
        "distributor_id string, transaction_ref_id string, claim_date date, submission_count int",
    )
    sold = spark.createDataFrame([("t1", day("2024-01-01")), ("t1", day("2024-01-05"))], "transaction_id string, transaction_date date")
    row = rebate.submission_lag(claims, sold).first()
    assert row["avg_submission_count"] == 2.0 and row["max_submission_count"] == 3
    assert row["avg_submission_lag_days"] == 15.0 and row["p50_submission_lag_days"] == 15.0
    assert row["p90_submission_lag_days"] == pytest.approx(19.0)
    assert row["max_submission_lag_days"] == 20


def test_seasonal_index_defaults_and_empty(spark):
    df = tx(spark, ("a", "2024-01-01", 10), ("a", "2024-02-01", 30)).withColumn("product_category", F.lit("parasiticide"))
    found = {r["month"]: r["parasiticide_seasonal_index"] for r in seasonal.seasonal_index(df).collect()}
    assert found == {1: 0.5, 2: 1.5}
    zero = df.withColumn("gross_amount", F.lit(0).cast("decimal(18,4)"))
    assert {r["parasiticide_seasonal_index"] for r in seasonal.seasonal_index(zero).collect()} == {0.0}
    assert seasonal.seasonal_index(df, "other").count() == 0


def test_yoy_needs_the_directly_preceding_year(spark):
    df = tx(spark, ("a", "2020-05-01", 10), ("a", "2021-05-01", 15), ("a", "2023-05-01", 5), ("b", "2020-01-01", 0), ("b", "2021-01-01", 5)).withColumn("product_id", F.lit("p"))
    found = {(r["customer_id"], r["year"]): r["yoy_growth_rate"] for r in seasonal.yoy_growth(df).collect()}
    assert found == {("a", 2020): None, ("a", 2021): 0.5, ("a", 2023): None, ("b", 2020): None, ("b", 2021): None}


def test_signals(spark):
    df = spark.createDataFrame([("x", "", None, "m"), ("y", "z", 1, None)], "a string, b string, c int, _meta string")
    assert [r["feat_source_completeness"] for r in signals.with_source_completeness(df).collect()] == [0.3333, 1.0]
    reference = spark.createDataFrame([("x", "z"), ("x", "z"), ("y", None)], "ra string, rb string")
    either = signals.with_match_confidence(df, ["a", "b"], reference, ["ra", "rb"])
    assert [r["feat_match_confidence"] for r in either.orderBy("a").collect()] == [0.5, 1.0]
    both = signals.with_match_confidence(df, ["a", "b"], reference, ["ra", "rb"], mode="all")
    assert [r["feat_match_confidence"] for r in both.orderBy("a").collect()] == [0.0, 0.0]
    with pytest.raises(ValueError, match="same length"):
        signals.with_match_confidence(df, ["a"], reference, ["ra", "rb"])


def test_duplicate_probability_equals_nearest_pair(spark):
    rng = random.Random(5)
    data = [(i, f"b{rng.randrange(4)}", day("2024-01-01") + dt.timedelta(days=rng.randrange(120))) for i in range(60)]
    df = spark.createDataFrame(data + [(99, "b0", None)], "id int, block string, d date")
    found = {r["id"]: r["feat_duplicate_probability"] for r in signals.with_duplicate_probability(df, ["block"], "d", max_days=9).collect()}
    assert len(found) == 61 and found[99] == 0.0
    for i, block, date in data:
        gaps = [abs((date - d).days) for j, o, d in data if o == block and j != i]
        assert found[i] == pytest.approx(max(0.0, 1 - min(gaps) / 10), abs=1e-4)


def test_as_of_join_equals_a_search(spark):
    rng = random.Random(3)
    facts = [(i, f"k{rng.randrange(3)}", day("2024-01-01") + dt.timedelta(days=rng.randrange(60))) for i in range(40)]
    history = [(f"k{rng.randrange(3)}", day("2024-01-01") + dt.timedelta(days=rng.randrange(60)), rng.randrange(99)) for _ in range(25)]
    joined = reconcile.as_of_join(
        spark.createDataFrame(facts, "id int, k string, at date"),
        spark.createDataFrame(history, "k string, since date, v int"),
        ["k"],
        at="at",
        valid_from="since",
        values=["v"],
    )
    found = {r["id"]: r["v"] for r in joined.collect()}
    for i, k, at in facts:
        past = [(since, v) for key, since, v in history if key == k and since <= at]
        assert found[i] == (max(past)[1] if past else None)


def test_claim_match_states(spark):
    claims = spark.createDataFrame([("1", "t1"), ("2", "zz"), ("3", None)], "claim_id string, transaction_ref_id string")
    sold = spark.createDataFrame([("t1", day("2024-01-02"), 5.0), ("t1", day("2024-01-01"), 6.0)], "transaction_id string, transaction_date date, gross_amount double")
    found = {r["claim_id"]: (r["match_status"], r["matched_date"], r["matched_amount"]) for r in reconcile.match_claims(claims, sold).collect()}
    assert found == {"1": ("matched", day("2024-01-01"), 11.0), "2": ("unmatched", None, None), "3": ("no_reference", None, None)}


def test_health_and_profile_edges(spark):
    empty = spark.createDataFrame([], "a string, n int")
    health = {r["column"]: r for r in monitor.feature_health(empty, "f").collect()}
    assert health["n"]["null_rate"] == 1.0 and health["n"]["mean"] is None
    assert health["n"]["freshness_days"] is None and health["a"]["record_count"] == 0
    dated = spark.createDataFrame([(day("2024-01-01"), 2), (None, 4)], "d date, n int")
    rows = {r["column"]: r for r in monitor.feature_health(dated, "f", timestamp_col="d", as_of="2024-01-02 12:00:00").collect()}
    assert rows["n"]["freshness_days"] == 1.5 and rows["d"]["null_rate"] == 0.5
    assert rows["n"]["stddev"] == pytest.approx(statistics.stdev([2, 4]))
    assert monitor.profile(dated).where("column = 'n'").first()["max"] == "4"
    assert {r["rate"] for r in monitor.null_rates(empty).collect()} == {1.0}


def test_training_join_checks_the_key(spark):
    with pytest.raises(ValueError, match="missing in feature table"):
        monitor.training_join([spark.range(1).toDF("a"), spark.range(1).toDF("b")], "a")


def test_stability_edges_are_exact_beyond_the_sketch(spark):
    base = spark.range(500_000).select((F.col("id") * 7919 % 500_000).cast("double").alias("x"), F.lit(1.0).alias("y"))
    at_edges = spark.createDataFrame([(i * 50_000.0 - 1.0, 1.0) for i in range(1, 10)], "x double, y double")
    found = {r["column"]: (r["bins"], r["psi"]) for r in drift.population_stability(base, at_edges, ["x", "y"]).collect()}
    psi = 9 * (1 / 9 - 0.1) * math.log(10 / 9) + (1e-4 - 0.1) * math.log(1e-3)
    assert found == {"x": (10, pytest.approx(psi)), "y": (1, 0.0)}


def test_drift(spark):
    same = spark.range(1000).withColumn("x", F.col("id") * 1.0)
    moved = same.withColumn("x", F.col("x") + 500)
    psi = {r["column"]: r["psi"] for r in drift.population_stability(same, same, ["x"]).collect()}
    assert psi["x"] == pytest.approx(0.0)
    assert drift.population_stability(same, moved, ["x"]).first()["psi"] > 1
    assert kolmogorov_smirnov(same, moved, "x").first()["ks"] == pytest.approx(0.5)
    assert kolmogorov_smirnov(same, same, "x").first()["ks"] == 0.0


def test_fleet_counts(spark):
    health = spark.createDataFrame(
        [("a", "x", 0.0, 0.5), ("b", "x", 0.5, 0.5), ("c", "x", 0.0, 3.0), ("d", "x", 0.0, None)],
        "feature string, column string, null_rate double, freshness_days double",
    )
    shift = spark.createDataFrame([("d", "x", 0.4)], "feature string, column string, psi double")
    assert tuple(reports.feature_fleet(health, shift).first()) == (4, 1, 1, 1)
