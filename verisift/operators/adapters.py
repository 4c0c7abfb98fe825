"""Declarative adapters from raw source layouts to the canonical entities.

An adapter is a mapping ``target column -> expression over raw columns`` and one
validity condition over the targets. Bad input turns into NULL and an unmet or
unknown ``_valid``; no row is dropped and nothing raises.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from verisift.schemas import CHARGEBACK, CONTRACT, TRANSACTION, conform


def text(raw: str) -> Column:
    return F.col(raw).cast("string")


def whole(raw: str) -> Column:
    return F.col(raw).cast("string").try_cast("int")


def money(raw: str) -> Column:
    return F.col(raw).cast("string").try_cast("decimal(18,4)")


def percent(raw: str) -> Column:
    return F.col(raw).cast("string").try_cast("decimal(8,4)")


def day(raw: str, pattern: str) -> Column:
    return F.try_to_date(F.col(raw).cast("string"), pattern)


# The date patterns of the two source families.
COMPACT_DAY = "yyyyMMdd"
ISO_DAY = "yyyy-MM-dd"


@dataclass(frozen=True)
class Adapter:
    source_system: str
    schema: StructType
    mapping: Mapping[str, Column]
    valid: Column

    def normalize(self, raw: DataFrame) -> DataFrame:
        """Project the raw columns onto the canonical entity, in its column order."""
        stamped = {
            "source_system": F.lit(self.source_system),
            "ingested_at": F.current_timestamp(),
            "dq_score": F.lit(None),
            **self.mapping,
        }
        given = [value.alias(name) for name, value in stamped.items() if name in self.schema.fieldNames()]
        return conform(raw.select(*given), self.schema)

    def validate(self, df: DataFrame) -> DataFrame:
        """Add the three-valued ``_valid``."""
        return df.withColumn("_valid", self.valid)

    def transform(self, raw: DataFrame) -> DataFrame:
        return self.validate(self.normalize(raw))


def _filled(column: str) -> Column:
    return F.col(column).isNotNull()


def edi_867() -> Adapter:
    """Product transfer and resale report."""
    amount = F.try_multiply(whole("qty").cast("decimal(10,0)"), money("unit_price"))
    return Adapter(
        "edi_867",
        TRANSACTION,
        {
            "transaction_id": text("ref_id"),
            "distributor_id": text("dist_id"),
            "customer_id": text("ship_to_id"),
            "product_id": text("item_id"),
            "ndc_code": text("ndc"),
            "transaction_date": day("txn_date", COMPACT_DAY),
            "quantity": whole("qty"),
            "unit_price": money("unit_price"),
            "gross_amount": amount.try_cast("decimal(18,4)"),
            "transaction_type": F.lit("transfer"),
        },
        _filled("transaction_id") & (F.col("quantity") > 0) & _filled("transaction_date"),
    )


def edi_844() -> Adapter:
    """Chargeback claim."""
    return Adapter(
        "edi_844",
        CHARGEBACK,
        {
            "claim_id": text("claim_ref"),
            "distributor_id": text("dist_id"),
            "customer_id": text("end_cust_id"),
            "product_id": text("item_id"),
            "contract_id": text("contract_ref"),
            "claim_date": day("claim_date", COMPACT_DAY),
            "transaction_ref_id": text("orig_txn_ref"),
            "claim_amount": money("cb_amount"),
            "claim_status": text("status_code"),
            "submission_count": whole("submission_cnt"),
        },
        _filled("claim_id") & (F.col("claim_amount") > 0) & _filled("claim_date"),
    )


def edi_849() -> Adapter:
    """Response to a chargeback claim."""
    return Adapter(
        "edi_849",
        CHARGEBACK,
        {
            "claim_id": text("response_ref"),
            "distributor_id": text("dist_id"),
            "customer_id": text("end_cust_id"),
            "product_id": text("item_id"),
            "contract_id": text("contract_ref"),
            "claim_date": day("response_date", COMPACT_DAY),
            "transaction_ref_id": text("orig_claim_ref"),
            "claim_amount": money("approved_amount"),
            "claim_status": text("response_code"),
            "submission_count": F.lit(None),
        },
        _filled("claim_id") & _filled("claim_date"),
    )


def erp() -> Adapter:
    """Billing documents; a document without a plant is a direct sale."""
    return Adapter(
        "erp",
        TRANSACTION,
        {
            "transaction_id": text("doc_number"),
            "distributor_id": F.coalesce(text("ship_from_plant"), F.lit("DIRECT")),
            "customer_id": text("sold_to_party"),
            "product_id": text("material_number"),
            "ndc_code": text("ndc_number"),
            "transaction_date": day("billing_date", ISO_DAY),
            "quantity": whole("billed_quantity"),
            "unit_price": money("net_price"),
            "gross_amount": money("net_value"),
            "transaction_type": text("doc_type"),
        },
        _filled("transaction_id") & _filled("customer_id") & _filled("gross_amount"),
    )


def claims() -> Adapter:
    """Claims of the internal claims system."""
    return Adapter(
        "claims_processor",
        CHARGEBACK,
        {
            "claim_id": text("claim_number"),
            "distributor_id": text("wholesaler_id"),
            "customer_id": text("member_id"),
            "product_id": text("product_code"),
            "contract_id": text("agreement_number"),
            "claim_date": day("submitted_date", ISO_DAY),
            "transaction_ref_id": text("invoice_ref"),
            "claim_amount": money("claimed_amount"),
            "claim_status": text("processing_status"),
            "submission_count": whole("submit_count"),
        },
        _filled("claim_id")
        & (F.col("claim_amount") > 0)
        & _filled("claim_date")
        & _filled("distributor_id"),
    )


def contracts() -> Adapter:
    """Agreements of the contract system."""
    ends_later = F.col("expiration_date").isNull() | (
        F.col("expiration_date") > F.col("effective_date")
    )
    sane_discount = F.col("discount_pct").isNull() | F.col("discount_pct").between(0, 1)
    return Adapter(
        "contracts",
        CONTRACT,
        {
            "contract_id": text("agreement_id"),
            "customer_id": text("account_id"),
            "product_id": text("material_group"),
            "contract_type": text("agreement_type"),
            "effective_date": day("start_date", ISO_DAY),
            "expiration_date": day("end_date", ISO_DAY),
            "tier_count": whole("num_tiers"),
            "discount_pct": percent("base_discount"),
            "rebate_pct": percent("rebate_rate"),
            "multi_product_flag": F.when(F.col("bundle_flag") == "Y", "Y").otherwise("N"),
        },
        _filled("contract_id") & _filled("effective_date") & ends_later & sane_discount,
    )


ADAPTERS = {
    "edi_867": edi_867,
    "edi_844": edi_844,
    "edi_849": edi_849,
    "erp": erp,
    "claims": claims,
    "contracts": contracts,
}


def adapter_for(entity: str) -> Adapter:
    """The adapter registered for a source entity."""
    try:
        return ADAPTERS[entity]()
    except KeyError:
        raise ValueError(f"no adapter for {entity!r}; known: {sorted(ADAPTERS)}") from None
