import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from verisift.operators import whatif
from verisift.operators.adapters import adapter_for
from verisift.streaming.gate_stream import raw_stream, start_gate


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [("s", 100.0), ("s", 40.0), ("s", None), ("t", 10.0)], "customer_segment string, gross_amount double"
    ).withColumn("gross_amount", F.col("gross_amount").cast("decimal(18,4)"))


def test_tiers_stack_and_lists_may_differ_in_length(spark, sales):
    scenarios = whatif.scenario_frame(
        spark,
        [
            whatif.Scenario("b", "s", [50, 30, 30], [0.1, 0.2], [0.05, 0.0, 0.01, 0.9]),
            whatif.Scenario("a", "none", [0], [0.5], [0.5]),
            whatif.Scenario("c", "t", [], [], []),
        ],
    )
    rows = whatif.simulate(sales, scenarios).orderBy("position").collect()
    assert [r["scenario"] for r in rows] == ["b", "a", "c"]
    assert rows[0]["gross_revenue"] == 140.0
    assert rows[0]["total_discount"] == pytest.approx(0.1 * 100 + 0.2 * 140)
    assert rows[0]["total_rebate"] == pytest.approx(0.05 * 100 + 0.01 * 140)
    assert rows[0]["net_price_change_pct"] == pytest.approx((140 - 38 - 6.4) / 119 - 1)
    assert rows[1]["gross_revenue"] == 0.0 and rows[1]["net_price_change_pct"] == 0.0
    assert rows[2]["net_revenue"] == 10.0


def test_impact_needs_its_baseline(spark, sales):
    scenarios = whatif.scenario_frame(spark, [whatif.Scenario("x", "s", [0], [0.1], [0]), whatif.Scenario("y", "s", [0], [0.2], [0])])
    comparison = whatif.compare_scenarios(sales, scenarios)
    rows = {r["scenario"]: r for r in whatif.scenario_impact(comparison, "x").collect()}
    assert rows["x"]["net_revenue_delta"] == 0.0
    assert rows["y"]["net_revenue_delta"] == pytest.approx(-14.0)
    assert rows["y"]["net_revenue_pct_change"] == pytest.approx(-14 / 126)
    with pytest.raises(Exception, match="must exist exactly once"):
        whatif.scenario_impact(comparison, "nope").collect()


def test_stream_gate_processes_new_files_once(spark, layout, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    columns = "ref_id dist_id ship_to_id item_id ndc txn_date qty unit_price".split()
    schema = StructType()
    for c in columns:
        schema.add(c, "string")

    def drop(name, *lines):
        (folder / name).write_text("\n".join([",".join(columns), *lines]) + "\n")

    def run():
        stream = raw_stream(spark, str(folder), schema)
        start_gate(
            stream, adapter_for("edi_867"), "edi_867", layout, checkpoint=str(tmp_path / "cp"), threshold=85.0
        ).awaitTermination()
        silver = spark.read.parquet(layout.silver("edi_867"))
        held = spark.read.parquet(layout.quarantine("edi_867"))
        return sorted(r["transaction_id"] for r in silver.collect()), held.count()

    drop("1.csv", "T1,D,C,P,N,20260101,5,1.0", "T2,D,C,P,N,nope,x,")
    assert run() == (["T1"], 1)
    drop("2.csv", "T3,D,C,P,N,20260102,5,1.0")
    assert run() == (["T1", "T3"], 1)


@pytest.mark.parametrize("values", [([0.0], [0.1234567891], [0.0]), ([0.00000000001], [0.1], [0.0]), ([0.0], [200.0], [0.0]), ([1e19], [0.1], [0.0])])
def test_values_that_do_not_fit_are_errors(spark, values):
    with pytest.raises(ValueError, match="places"):
        whatif.scenario_frame(spark, [whatif.Scenario("s", "a", *values)])


def test_noise_of_doubles_fits(spark):
    tiers = whatif.scenario_frame(spark, [whatif.Scenario("s", "a", [0.1 + 0.2], [0.1 + 0.2], [1 / 8])]).first()["tiers"]
    assert [float(x) for x in tiers[0]] == [0.3, 0.3, 0.125]
