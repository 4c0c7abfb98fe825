import datetime
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from verisift.operators.enrich import enrich
from verisift.plans import queries
from verisift.session import scratch_root
from verisift.sources import catalog, feature_store, raw, tables
from verisift.sources.catalog import FeatureDefinition, Features
from verisift.sources.layout import Layout


def test_paths():
    lake = Layout("s3a://bucket/base/")
    assert lake.bronze("claims", "2024-01-01") == "s3a://bucket/base/bronze/claims/date=2024-01-01"
    assert lake.silver("claims") == "s3a://bucket/base/silver/claims"
    assert lake.features("customer_behavior") == "s3a://bucket/base/features/customer_behavior"
    assert lake.features("a", "b").endswith("/features/a/b")


def test_csv_stays_text_and_callers_options_win(spark, layout, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a;b\n20260115;1\n20260116;2\n")
    assert raw.ingest(spark, str(path), "x", layout, date="2026-01-01", options={"sep": ";"}) == 2
    df = raw.read_partition(spark, "x", layout)
    assert dict(df.dtypes) == {"a": "string", "b": "string", "date": "date"}
    typed = raw.read_raw(spark, str(path), options={"sep": ";", "inferSchema": "true"})
    assert dict(typed.dtypes)["b"] == "int"


def test_partitions_are_appended_and_pruned(spark, layout):
    for date in ("2024-01-01", "2024-02-01", "2024-02-01"):
        raw.ingest_frame(spark.range(3), "x", layout, date=date)
    assert raw.partition_dates(spark, layout.bronze("x")) == ["2024-01-01", "2024-02-01"]
    latest = raw.read_partition(spark, "x", layout)
    assert latest.count() == 6
    assert "PartitionFilters: [isnotnull(date" in latest._jdf.queryExecution().toString()
    assert raw.read_partition(spark, "x", layout, date=None).count() == 9
    today = raw.ingest_frame(spark.range(1), "x", layout)
    assert today == 1 and len(raw.partition_dates(spark, layout.bronze("x"))) == 3


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_tables(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    options = {"header": "true"} if fmt == "csv" else {}
    tables.write_table(spark.range(3), path, fmt=fmt, options=options)
    tables.write_table(spark.range(2), path, fmt=fmt, options=options)
    assert tables.read_table(spark, path, fmt=fmt, options=options).count() == 5
    assert tables.publish_scores(spark.range(4), path, model_version="1", mode="overwrite", fmt=fmt, options=options) == 4
    assert "_audit_model_version" in tables.read_table(spark, path, fmt=fmt, options=options).columns


def test_versions(spark, layout):
    place = (layout, "customer_behavior", "velocity")
    with pytest.raises(ValueError, match="has no version"):
        feature_store.read_feature_table(spark, *place)
    assert feature_store.write_feature_table(spark.range(3), *place) == 1
    assert feature_store.write_feature_table(spark.range(3, 5), *place, mode="append") == 2
    split = spark.range(1).withColumn("part", F.lit("p"))
    assert feature_store.write_feature_table(split, *place, partition_by=["part"]) == 3
    counts = [feature_store.read_feature_table(spark, *place, version=v).count() for v in (1, 2, 3)]
    assert counts == [3, 5, 1]
    assert feature_store.read_feature_table(spark, *place).columns == ["id", "part"]
    manifest = feature_store.feature_versions(spark, *place).orderBy("version").collect()
    assert [r["row_count"] for r in manifest] == [3, 5, 1]
    with pytest.raises(ValueError, match="unknown mode"):
        feature_store.write_feature_table(spark.range(1), *place, mode="merge")


def test_writers_at_the_same_time_get_versions_of_their_own(spark, layout):
    place = (layout, "customer_behavior", "together")
    with ThreadPoolExecutor(6) as pool:
        jobs = [pool.submit(feature_store.write_feature_table, spark.range(i * 10, i * 10 + 10), *place, mode="append") for i in range(12)]
        versions = sorted(job.result() for job in jobs)
    assert versions == list(range(1, 13))
    rows = feature_store.read_feature_table(spark, *place)
    # no append is lost
    assert sorted(r["id"] for r in rows.collect()) == list(range(120))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    # a claim whose writer is gone does not hold up the next version for ever
    manifest = layout.features("customer_behavior", "together") + "/_manifest"
    open(f"{manifest}/version-13.json", "w").close()
    feature_store.CLAIM_SECONDS, waits = 0.3, feature_store.CLAIM_SECONDS
    try:
        assert feature_store.compact_feature_table(spark, *place) == 14
        assert feature_store.write_feature_table(spark.range(500, 501).withColumn("extra", F.lit(1)), *place, mode="append") == 15
    finally:
        feature_store.CLAIM_SECONDS = waits
    sizes = {r["version"]: (len(r["parts"]), r["row_count"]) for r in feature_store.feature_versions(spark, *place).collect()}
    assert sizes[12] == (12, 120) and sizes[14] == (1, 120) and sizes[15] == (2, 121) and 13 not in sizes
    latest = feature_store.read_feature_table(spark, *place)
    assert latest.count() == 121 and latest.where("extra = 1").count() == 1
    assert feature_store.read_feature_table(spark, *place, version=3).count() == 30


def test_compaction_does_not_lose_an_append(spark, layout, monkeypatch):
    place = (layout, "customer_behavior", "compacted")
    feature_store.write_feature_table(spark.range(3), *place)
    read, late = feature_store.read_feature_table, []

    def meanwhile(*args, **kwargs):
        rows = read(*args, **kwargs)
        if not late:
            late.append(feature_store.write_feature_table(spark.range(3, 5), *place, mode="append"))
        return rows

    monkeypatch.setattr(feature_store, "read_feature_table", meanwhile)
    assert feature_store.compact_feature_table(spark, *place) == 3 and late == [2]
    assert read(spark, *place).count() == 5


def test_catalog(spark, layout):
    def define(name, version="1", definition="d"):
        return FeatureDefinition(name, "customer_behavior", definition, "sql", ["silver"], version, {"null_rate": 0.1})

    first = catalog.register_feature(spark, layout, define("velocity_30d"))
    assert catalog.register_feature(spark, layout, define("velocity_30d", definition="new")) == first
    catalog.register_feature(spark, layout, define("velocity_30d", "2"))
    catalog.register_feature(spark, layout, define("entropy"))
    access = Features(spark, layout)
    assert access.list_features().count() == 3
    assert [r["version"] for r in access.list_features("VELOCITY").collect()] == ["1", "2"]
    assert access.metadata("velocity").count() == 0
    row = access.metadata("velocity_30d").where("version = '1'").first()
    assert row["definition"] == "new" and row["quality_expectations"] == {"null_rate": "0.1"}
    feature_store.write_feature_table(spark.range(2), layout, "customer_behavior", "entropy")
    assert access.get_feature("customer_behavior", "entropy", version=1).count() == 2


def test_lineage(spark, layout):
    chain = ["source", "bronze", "silver", "feature", "model", "score"]
    for source, target in zip(chain, chain[1:]):
        catalog.register_lineage(spark, layout, source, target)
    catalog.register_lineage(spark, layout, "gold", "feature")
    catalog.register_lineage(spark, layout, "feature", "silver")  # a cycle
    wanted = spark.createDataFrame([("score",), ("bronze",)], "asset string")
    found = {(r["asset"], r["upstream"]): r["depth"] for r in catalog.upstream(catalog.lineage_edges(spark, layout), wanted).collect()}
    assert found[("score", "source")] == 5 and found[("score", "gold")] == 3
    assert found[("bronze", "source")] == 1
    assert len(found) == 7
    near = catalog.upstream(catalog.lineage_edges(spark, layout), wanted, max_depth=2)
    assert {(r["asset"], r["upstream"]) for r in near.collect()} == {k for k, depth in found.items() if depth <= 2}


def test_scratch_folder_is_the_configured_one(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_enrich_keeps_every_row(spark, rows):
    tx = spark.createDataFrame([("t1", "p1", "c1"), ("t2", None, "c9"), ("t3", "p2", None)], "transaction_id string, product_id string, customer_id string")
    products = spark.createDataFrame([("p1", "b"), ("p1", "a"), (None, "x"), ("p2", None)], "product_id string, product_category string")
    customers = spark.createDataFrame([("c1", "s")], "customer_id string, customer_segment string")
    both = enrich(tx, products=products, customers=customers)
    assert rows(both, "transaction_id", "product_category", "customer_segment") == rows(
        spark.createDataFrame([("t1", "a", "s"), ("t2", None, None), ("t3", None, None)], "a string, b string, c string")
    )
    assert enrich(tx.limit(0), products=products).columns == [*tx.columns, "product_category"]
    assert enrich(both, products=products).columns.count("product_category") == 1


def test_arrays_of_a_month_are_bounded(spark, tmp_path, monkeypatch):
    days = [datetime.date(1995, 3, 1 + i % 20) for i in range(90)]
    rows = [("FO"[i % 2], 100.25 + i, day) for i, day in enumerate(days)] + [(None, None, None)]
    orders = spark.createDataFrame(rows, "o_orderstatus string, o_totalprice double, o_orderdate date")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(queries, "ARRAY_ROWS", 10)
    place = str(tmp_path / "made")
    monkeypatch.setattr(queries, "scratch_path", lambda spark, label: place)
    found = queries.QUERIES["read_formats"](spark, str(tmp_path)).collect()
    by_format = {f: sorted(map(str, (tuple(r)[1:] for r in found if r["format"] == f))) for f in {r["format"] for r in found}}
    assert len(by_format) == 3 and len({tuple(v) for v in by_format.values()}) == 1
    assert {(r["o_orderstatus"], r["row_count"], r["total"]) for r in found} == {
        ("F", 45, 45 * 100.25 + sum(range(0, 90, 2))), ("O", 45, 45 * 100.25 + sum(range(1, 90, 2))), (None, 1, None),
    }
    sizes = [len(json.loads(p.read_text())) for p in (tmp_path / "made" / "array").rglob("*.txt")]
    assert sum(sizes) == 91 and max(sizes) < 45
