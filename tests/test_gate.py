import pytest
from pyspark.sql import functions as F

from verisift.functions.audit import new_correlation_id, stamp_audit
from verisift.functions.scoring import DIMENSION_WEIGHTS, with_quality_score
from verisift.operators.gate import THRESHOLDS, run_gate, split_by_score
from verisift.plans.jobs import silver_job
from verisift.schemas import QUALITY_DIMENSIONS
from verisift.sources import raw

FLAGS = "id string, note string, _is_duplicate boolean, _valid boolean, _staleness_score double, dq_score double"


def test_weights_cover_the_dimensions():
    assert set(DIMENSION_WEIGHTS) == set(QUALITY_DIMENSIONS)
    assert sum(DIMENSION_WEIGHTS.values()) == pytest.approx(1.0)
    assert THRESHOLDS == {"dev": 30.0, "staging": 40.0, "prod": 40.0}


def score(spark, row, **options):
    return with_quality_score(spark.createDataFrame([row], FLAGS), **options).first()["dq_score"]


def test_score(spark):
    assert score(spark, ("1", "x", False, True, 0.0, None)) == 100.0
    # As coded the empty score itself counts as a gap: 2 of 3 columns.
    assert score(spark, ("1", "x", False, True, 0.0, None), count_score_column=True) == 91.67
    assert score(spark, ("1", None, True, None, 0.5, None)) == pytest.approx(
        100 * (0.25 * 0.5 + 0.2 + 0.1 * 0.5 + 0.2)
    )
    assert score(spark, ("1", "x", None, False, -3.0, None)) == 90.0
    assert score(spark, ("1", "x", None, False, 9.0, None)) == 80.0


def test_score_reads_consistency_and_accuracy(spark):
    df = spark.createDataFrame([("1", 0.0, 0.5)], "id string, _dq_consistency double, _dq_accuracy double")
    assert with_quality_score(df).first()["dq_score"] == 70.0
    with pytest.raises(ValueError, match="sum to 1"):
        with_quality_score(df, weights={k: 0.5 for k in DIMENSION_WEIGHTS})
    with pytest.raises(ValueError, match="must name"):
        with_quality_score(df, weights={"completeness": 1.0})


@pytest.fixture
def mixed(spark):
    good = [(f"g{i}", "x", False, True, 0.0, None) for i in range(6)]
    bad = [(None, None, True, False, 1.0, None)] * 3
    unknown = [("u", "x", False, True, None, None)]
    return spark.createDataFrame(good + bad + unknown, FLAGS)


@pytest.mark.parametrize("checkpoint", [False, True])
def test_gate_writes_both_parts(spark, mixed, layout, checkpoint):
    result = run_gate(mixed, "claims", layout=layout, threshold=60.0, checkpoint=checkpoint)
    assert (result.total_count, result.passed_count, result.quarantined_count) == (10, 7, 3)
    passed = spark.read.parquet(layout.silver("claims"))
    held = spark.read.parquet(layout.quarantine("claims"))
    assert passed.count() == 7 and held.count() == 3
    assert passed.agg(F.min("dq_score")).first()[0] >= 60
    assert {r["_quarantine_reason"] for r in held.collect()} == {"below_dq_threshold"}
    again = run_gate(mixed, "claims", layout=layout, threshold=60.0)
    assert spark.read.parquet(layout.silver("claims")).count() == 7  # replaced
    assert spark.read.parquet(layout.quarantine("claims")).count() == 6  # appended
    assert again.mean_dq_score == result.mean_dq_score


def test_gate_without_writing(mixed):
    result = run_gate(mixed, "claims", threshold=60.0)
    assert result.passed.count() + result.quarantined.count() == result.total_count == 10


def test_nothing_is_quarantined_without_need(spark, mixed, layout):
    result = run_gate(mixed, "claims", layout=layout, threshold=10.0)
    assert result.quarantined_count == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(layout.quarantine("claims"))


def test_a_missing_score_is_quarantined(spark, layout):
    scored = spark.createDataFrame([("a", None), ("b", 90.0)], "id string, dq_score double")
    passed, held = split_by_score(scored)
    assert [r["id"] for r in passed.collect()] == ["b"]
    assert [r["id"] for r in held.collect()] == ["a"]


def test_dates_are_replaced_one_by_one(spark, layout):
    from verisift.operators.gate import write_silver

    def day(date, *ids):
        return spark.createDataFrame([(i, date) for i in ids], "id int, date string")

    write_silver(day("2024-01-01", 1, 2), "tx", layout, date_column="date")
    write_silver(day("2024-01-02", 3), "tx", layout, date_column="date")
    write_silver(day("2024-01-02", 4), "tx", layout, date_column="date")
    assert sorted(r["id"] for r in spark.read.parquet(layout.silver("tx")).collect()) == [1, 2, 4]


def test_silver_job_end_to_end(spark, layout, tmp_path):
    head = "ref_id,dist_id,ship_to_id,item_id,ndc,txn_date,qty,unit_price\n"
    one, two = tmp_path / "one.csv", tmp_path / "two.csv"
    one.write_text(head + "T0,D1,C1,P1,1,20260101,1,1.00\n")
    two.write_text(head + "T1,D1,C1,P1,1,20260115,100,25.50\nT2,D1,C1,P1,1,bad,x,\n")
    assert raw.ingest(spark, str(one), "edi_867", layout, date="2026-01-14") == 1
    assert raw.ingest(spark, str(two), "edi_867", layout, date="2026-01-15") == 2
    result = silver_job(spark, "edi_867", layout, threshold=85.0)
    assert (result.total_count, result.passed_count, result.quarantined_count) == (2, 1, 1)
    assert spark.read.parquet(layout.silver("edi_867")).first()["transaction_id"] == "T1"
    notice = spark.read.parquet(layout.catalog("dq_results")).first()
    assert notice["rule_id"] == "quarantine-edi_867" and notice["passed"] is False
    everything = silver_job(spark, "edi_867", layout, date=None)
    assert everything.total_count == 3
    for _ in range(2):  # both days stay, and repeated runs change nothing
        silver_job(spark, "edi_867", layout, threshold=85.0)
        kept = spark.read.parquet(layout.silver("edi_867"))
        assert sorted(r["transaction_id"] for r in kept.collect()) == ["T0", "T1"]
        held = spark.read.parquet(layout.quarantine("edi_867"))
        assert [r["transaction_id"] for r in held.collect()] == ["T2"]


def test_json_lines_keep_every_row(spark, layout, tmp_path):
    path = tmp_path / "in.json"
    path.write_text('{"a": 1}\n{"a": 2}\n{"a": 3}\n')
    assert raw.ingest(spark, str(path), "lines", layout, file_format="json", date="2026-01-14") == 3
    assert sorted(r["a"] for r in raw.read_partition(spark, "lines", layout).collect()) == ["1", "2", "3"]


def test_audit_columns(spark):
    base = spark.range(1)
    assert stamp_audit(base).columns == ["id", "_audit_scored_at"]
    full = stamp_audit(base, model_version="1", feature_versions="{}", correlation_id="c", pipeline_name="p")
    assert sorted(c for c in full.columns if c.startswith("_audit_")) == [
        "_audit_correlation_id",
        "_audit_feature_versions",
        "_audit_model_version",
        "_audit_pipeline_name",
        "_audit_scored_at",
    ]
    assert dict(full.dtypes)["_audit_scored_at"] == "string"
    assert new_correlation_id() != new_correlation_id()
