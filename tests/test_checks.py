import datetime as dt

import pytest
from pyspark.sql import functions as F

from verisift.functions.skew import mark_first
from verisift.operators import checks, rules
from verisift.operators.gate import quarantine_notice


@pytest.fixture
def small(spark):
    return spark.createDataFrame(
        [
            (1, "a", 5, dt.date(2024, 1, 1), dt.date(2024, 1, 5)),
            (2, None, -1, dt.date(2024, 2, 1), dt.date(2024, 1, 5)),
            (3, "b", None, None, dt.date(2024, 1, 5)),
            (4, "b", 9, dt.date(2024, 3, 1), dt.date(2024, 3, 1)),
        ],
        "id int, code string, amount int, start date, end date",
    )


def rates(df):
    return {(r["check"], r["column"]): (r["numerator"], r["denominator"], r["rate"]) for r in df.collect()}


def all_checks():
    return [
        *checks.required("code"),
        *checks.null_share("code"),
        checks.in_range("amount", 0, 9),
        checks.valid_codes("code", ["a"]),
        checks.date_order("start", "end"),
        *checks.positive("amount"),
        checks.within_sla("start", "end", 3),
    ]


def test_rates_in_one_pass(small):
    found = rates(checks.measure(small, all_checks()))
    assert found[("required", "code")] == (3, 4, 0.75)
    assert found[("null_rate", "code")] == (1, 4, 0.25)
    assert found[("in_range", "amount")][:2] == (2, 3)
    assert found[("valid_codes", "code")][:2] == (1, 3)
    assert found[("date_order", "start<end")][:2] == (1, 3)
    assert found[("positive", "amount")][:2] == (2, 3)
    # A missing date is a miss, a negative lag is within the limit.
    assert found[("within_sla", "end")] == (2, 4, 0.5)


def test_empty_input_rates(small):
    found = rates(checks.measure(small.where("false"), all_checks()))
    assert {k[0]: v[2] for k, v in found.items()} == {
        "required": 0.0,
        "null_rate": 1.0,
        "in_range": 1.0,
        "valid_codes": 1.0,
        "date_order": 1.0,
        "positive": 1.0,
        "within_sla": 1.0,
    }
    empty = small.where("false")
    assert checks.duplicate_rate(empty, ["id"]).first()["rate"] == 0.0
    assert checks.referential_integrity(empty, "id", small, "id").first()["rate"] == 1.0
    assert checks.cross_source_alignment(empty, small, "id", ["code"]).first()["rate"] == 0.0
    assert checks.missing_periods(empty, "start", ["2024-01"]).count() == 1
    assert checks.missing_sources(empty, "code", ["a", "b"]).count() == 2


def test_null_keys_are_a_key(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",)], "k string")
    assert checks.duplicate_rate(df, ["k"]).first()["numerator"] == 1
    assert checks.flag_duplicates(df, ["k"], ["k"]).where("_is_duplicate").count() == 1
    assert checks.deduplicate(df, ["k"], ["k"]).count() == 2


@pytest.mark.parametrize("pieces", [1, 3, 64])
def test_one_first_row_per_key_whatever_the_skew(spark, rows, pieces, monkeypatch):
    monkeypatch.setattr("verisift.functions.skew.COPIES_PER_TASK", 7)
    copies = [("hot", 5, "same")] * 50
    spread = [("hot", i, f"v{i}") for i in range(6, 40)]
    cold = [(f"k{i}", 1, "x") for i in range(20)] + [(None, 2, "n"), (None, 1, "m")]
    df = spark.createDataFrame(copies + spread + cold, "k string, o int, v string").repartition(pieces)
    marked = mark_first(df, ["k"], ["o"])
    assert rows(marked, "k", "o", "v") == rows(df, "k", "o", "v")
    firsts = marked.where("_first")
    assert firsts.count() == 22
    assert rows(firsts.where("k = 'hot'"), "o", "v") == [(5, "same")]
    assert rows(firsts.where("k is null"), "o", "v") == [(1, "m")]


def test_first_rows_of_a_hot_key_stay_dealt(spark):
    df = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("o")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        marked = mark_first(df, ["k"], ["o"])
        sizes = [r["count"] for r in marked.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert "Window" not in marked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 40_000 and max(sizes) < 2 * 40_000 / 8
    assert marked.where("_first AND k = 'hot'").first()["o"] == 1


def test_rows_alone_with_their_key_are_not_moved(spark, rows):
    alone = spark.range(0, 400, 1, 4).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("o"))
    twice = spark.createDataFrame([("399", 0), (None, 2), (None, 2)], "k string, o int")
    df = alone.withColumn("was", F.spark_partition_id()).unionByName(twice.withColumn("was", F.lit(-1)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        marked = mark_first(df, ["k"], ["o"]).withColumn("at", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert all(r["was"] == r["at"] for r in marked if r["k"] not in (None, "399"))
    assert sorted((r["k"] or "", r["o"]) for r in marked if r["_first"] and r["was"] < 0) == [("", 2), ("399", 0)]
    assert len(marked) == 403 and sum(r["_first"] for r in marked) == 401


def test_deduplicate_keeps_the_lowest(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, None)], "k string, o int, v string")
    assert rows(checks.deduplicate(df, ["k"], ["o"])) == [("a", 1, "y"), ("b", 1, None)]


@pytest.mark.parametrize("key_rows", [100_000, 2])
def test_alignment_moves_the_rows_of_small_keys_once(spark, monkeypatch, key_rows):
    monkeypatch.setattr("verisift.operators.checks.KEY_ROWS", key_rows)
    left = spark.createDataFrame([(1, "a", 0.0), (1, "a", 0.0), (2, "b", None), (3, None, 1.0)], "k int, x string, y double")
    right = spark.createDataFrame([(1, "a", -0.0), (1, "z", 4.0), (2, "b", None), (3, "c", 1.0), (9, "c", 1.0)], "k int, x string, y double")
    found = checks.cross_source_alignment(left, right, "k", ["x", "y"])
    if key_rows > 2:
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r["column"]: (r["numerator"], r["denominator"]) for r in found.collect()} == {"x": (3, 6), "y": (3, 6)}


def test_alignment_counts_pairs_without_building_them(spark):
    left = spark.createDataFrame([(1, "a", None)] * 3 + [(2, "b", 1), (None, "c", 1)], "k int, x string, y int")
    right = spark.createDataFrame([(1, "a", None)] * 2 + [(1, "z", 4), (2, None, 1), (None, "c", 1)], "k int, x string, y int")
    found = {r["column"]: (r["numerator"], r["denominator"]) for r in checks.cross_source_alignment(left, right, "k", ["x", "y"]).collect()}
    joined = left.alias("l").join(right.alias("r"), "k")
    expected = {
        c: (joined.where(F.col(f"l.{c}") == F.col(f"r.{c}")).count(), joined.count()) for c in ("x", "y")
    }
    assert found == expected == {"x": (6, 10), "y": (1, 10)}


def test_referential_integrity_ignores_null_keys_and_reference_duplicates(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk int")
    reference = spark.createDataFrame([(1,), (1,), (None,)], "pk int")
    row = checks.referential_integrity(facts, "fk", reference, "pk").first()
    assert (row["numerator"], row["denominator"]) == (2, 3)


def test_staleness_is_held_between_0_and_1(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1),), (dt.date(2023, 1, 1),), (dt.date(2025, 1, 1),), (None,)], "d date"
    )
    scored = checks.with_staleness(df, "d", as_of="2024-01-10", max_days=90)
    assert [r["_staleness_score"] for r in scored.collect()] == [pytest.approx(0.1), 1.0, 0.0, 1.0]


def test_outliers_with_no_spread_or_no_rows(spark):
    flat = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    flags = [r[0] for r in checks.flag_outliers(flat, "x").select("_is_outlier_x").collect()]
    assert flags == [False, False, None]
    single = spark.createDataFrame([(100.0,)], "x double")
    assert checks.flag_outliers(single, "x").first()["_is_outlier_x"] is False


def test_outliers_within_groups(spark):
    data = [("a", float(i % 3)) for i in range(30)] + [("a", 100.0), ("b", 100.0), ("b", 101.0)]
    df = spark.createDataFrame(data, "g string, x double")
    flagged = checks.flag_outliers(df, "x", within=["g"]).where("_is_outlier_x").collect()
    assert [(r["g"], r["x"]) for r in flagged] == [("a", 100.0)]


def test_suite_with_missing_column_and_repeats(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, None)], "transaction_id string, quantity int")
    found = {r["position"]: (r["observed"], r["passed"]) for r in rules.run_suite(df, rules.TRANSACTION_SUITE).collect()}
    assert found[0] == (0, True)
    assert found[1] == (1, False)
    assert found[2] == (2, False)
    assert found[3] == (1, False)  # the column does not exist
    assert found[6] == (1, False)
    features = rules.run_suite(df.where("false").withColumnRenamed("transaction_id", "customer_id"), rules.FEATURE_SUITE)
    assert [r["passed"] for r in features.orderBy("position").collect()] == [True, True, False]


def test_suite_from_json(spark, tmp_path):
    path = tmp_path / "suite.json"
    path.write_text(
        '{"expectations": [{"expectation_type": "expect_column_values_to_be_between",'
        ' "kwargs": {"column": "x", "min_value": 1, "max_value": 2}, "meta": {"dimension": "accuracy"}}]}'
    )
    df = spark.createDataFrame([(0,), (1,), (3,), (None,)], "x int")
    row = rules.run_suite(df, rules.load_suite(str(path))).first()
    assert (row["observed"], row["passed"], row["dimension"]) == (2, False, "accuracy")


def test_results_are_pushed(spark, layout):
    metrics = checks.measure(spark.range(4), checks.required("id"))
    catalog_rules = spark.createDataFrame([("R1", "required", 0.9), ("R2", "absent", 0.1)], "id string, name string, threshold double")
    rules.push_results(rules.apply_rules(catalog_rules, metrics), layout)
    rules.push_results(quarantine_notice(spark, "claims", 3), layout)
    stored = {r["rule_id"]: r["passed"] for r in spark.read.parquet(layout.catalog("dq_results")).collect()}
    assert stored == {"R1": True, "R2": False, "quarantine-claims": False}
