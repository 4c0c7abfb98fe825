import datetime as dt
from decimal import Decimal

import pytest

from verisift.operators.adapters import ADAPTERS, adapter_for
from verisift.schemas import CHARGEBACK, ENTITIES, TRANSACTION, conform
from verisift.sources import raw


CSV_867 = """ref_id,dist_id,ship_to_id,item_id,ndc,txn_date,qty,unit_price
T1,D1,C1,P1,111-22,20260115,100,25.50
T2,D1,C2,P2,111-23,20261315,50,42.00
T3,D2,C1,P1,111-22,20260117,many,25.50
T4,D1,C3,P3,111-24,20260118,0,18.75
,D3,C2,P1,111-22,20260119,150,25.50
"""


def test_867_flags_bad_rows_and_keeps_them(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(CSV_867)
    df = adapter_for("edi_867").transform(raw.read_raw(spark, str(path)))
    assert df.columns == [*TRANSACTION.fieldNames(), "_valid"]
    by_item = {r["transaction_id"]: r for r in df.collect()}
    assert len(by_item) == 5
    first = by_item["T1"]
    assert first["transaction_date"] == dt.date(2026, 1, 15)
    assert first["gross_amount"] == Decimal("2550.0000")
    assert first["source_system"] == "edi_867" and first["transaction_type"] == "transfer"
    assert first["dq_score"] is None and first["ingested_at"] is not None
    assert first["_valid"] is True
    assert by_item["T2"]["transaction_date"] is None and by_item["T2"]["_valid"] is False
    assert by_item["T3"]["quantity"] is None and by_item["T3"]["_valid"] is None
    assert by_item["T3"]["gross_amount"] is None
    assert by_item["T4"]["_valid"] is False
    assert by_item[None]["_valid"] is False


def test_contract_json_array(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text(
        """[
        {"agreement_id": "A1", "account_id": "C1", "material_group": "P1",
         "agreement_type": "rebate", "start_date": "2026-01-01", "end_date": "2026-12-31",
         "num_tiers": 3, "base_discount": 0.05, "rebate_rate": 0.03, "bundle_flag": "Y"},
        {"agreement_id": "A2", "account_id": "C1", "material_group": null,
         "agreement_type": "rebate", "start_date": "2026-01-01", "end_date": "2025-12-31",
         "num_tiers": 3, "base_discount": null, "rebate_rate": 123456, "bundle_flag": null}
        ]"""
    )
    df = adapter_for("contracts").transform(raw.read_raw(spark, str(path), file_format="json", document="array"))
    one, two = df.orderBy("contract_id").collect()
    assert one["_valid"] is True and one["discount_pct"] == Decimal("0.0500")
    assert one["tier_count"] == 3 and one["multi_product_flag"] == "Y"
    assert two["_valid"] is False and two["multi_product_flag"] == "N"
    assert two["rebate_pct"] is None  # does not fit the type


def test_844_accepts_typed_input(spark):
    raw_rows = spark.createDataFrame(
        [("K1", "D1", "C1", "P1", "A1", 20260120, "T1", 500.0, "pending", 1)],
        "claim_ref string, dist_id string, end_cust_id string, item_id string, "
        "contract_ref string, claim_date int, orig_txn_ref string, cb_amount double, "
        "status_code string, submission_cnt int",
    )
    row = adapter_for("edi_844").transform(raw_rows).first()
    assert row["claim_date"] == dt.date(2026, 1, 20) and row["_valid"] is True
    assert row["claim_amount"] == Decimal("500.0000")


def test_dispatch():
    with pytest.raises(ValueError, match="no adapter"):
        adapter_for("unknown")
    assert set(ADAPTERS) == {"edi_867", "edi_844", "edi_849", "erp", "claims", "contracts"}


def test_canonical_layouts():
    sizes = {name: len(schema.fields) for name, schema in ENTITIES.items()}
    assert sizes == {"transaction": 13, "chargeback": 13, "contract": 12, "rebate_accrual": 10}


def test_conform_casts_orders_and_fills(spark):
    df = spark.createDataFrame([("2026-01-01", "x", "7")], "claim_date string, claim_id string, _flag string")
    out = conform(df, CHARGEBACK)
    assert out.columns == [*CHARGEBACK.fieldNames(), "_flag"]
    row = out.first()
    assert row["claim_date"] == dt.date(2026, 1, 1) and row["contract_id"] is None
    with pytest.raises(Exception, match="mandatory"):
        conform(df, CHARGEBACK, strict=True).collect()
