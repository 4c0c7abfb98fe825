"""Canonical entities, code sets and the step that conforms a frame to a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, DAY, WHOLE = StringType(), DateType(), IntegerType()
MONEY, PERCENT = DecimalType(18, 4), DecimalType(8, 4)
INSTANT, SCORE = TimestampType(), DoubleType()


def _entity(columns: dict[str, DataType], *, optional: set[str]) -> StructType:
    return StructType(
        [StructField(name, kind, name in optional) for name, kind in columns.items()]
    )


# The canonical entity layouts.
TRANSACTION = _entity(
    {
        "transaction_id": TEXT,
        "source_system": TEXT,
        "distributor_id": TEXT,
        "customer_id": TEXT,
        "product_id": TEXT,
        "ndc_code": TEXT,
        "transaction_date": DAY,
        "quantity": WHOLE,
        "unit_price": MONEY,
        "gross_amount": MONEY,
        "transaction_type": TEXT,
        "ingested_at": INSTANT,
        "dq_score": SCORE,
    },
    optional={"ndc_code", "dq_score"},
)
CHARGEBACK = _entity(
    {
        "claim_id": TEXT,
        "source_system": TEXT,
        "distributor_id": TEXT,
        "customer_id": TEXT,
        "product_id": TEXT,
        "contract_id": TEXT,
        "claim_date": DAY,
        "transaction_ref_id": TEXT,
        "claim_amount": MONEY,
        "claim_status": TEXT,
        "submission_count": WHOLE,
        "ingested_at": INSTANT,
        "dq_score": SCORE,
    },
    optional={"contract_id", "transaction_ref_id", "submission_count", "dq_score"},
)
CONTRACT = _entity(
    {
        "contract_id": TEXT,
        "customer_id": TEXT,
        "product_id": TEXT,
        "contract_type": TEXT,
        "effective_date": DAY,
        "expiration_date": DAY,
        "tier_count": WHOLE,
        "discount_pct": PERCENT,
        "rebate_pct": PERCENT,
        "multi_product_flag": TEXT,
        "ingested_at": INSTANT,
        "dq_score": SCORE,
    },
    optional={"product_id", "expiration_date", "tier_count", "discount_pct", "rebate_pct", "multi_product_flag", "dq_score"},
)
ACCRUAL = _entity(
    {
        "accrual_id": TEXT,
        "period": TEXT,
        "customer_id": TEXT,
        "product_id": TEXT,
        "accrual_amount": MONEY,
        "actual_amount": MONEY,
        "variance": MONEY,
        "accrual_type": TEXT,
        "ingested_at": INSTANT,
        "dq_score": SCORE,
    },
    optional={"actual_amount", "variance", "dq_score"},
)
ENTITIES = {
    "transaction": TRANSACTION,
    "chargeback": CHARGEBACK,
    "contract": CONTRACT,
    "rebate_accrual": ACCRUAL,
}

# Code sets.
DEDUCTION_TYPES = (
    "rebate",
    "chargeback",
    "distribution_fee",
    "return",
    "prompt_pay",
    "admin_fee",
    "other",
)
QUALITY_DIMENSIONS = (
    "completeness",
    "uniqueness",
    "consistency",
    "timeliness",
    "accuracy",
    "validity",
)
LAYERS = ("bronze", "silver", "gold", "features")
MODEL_STAGES = ("experimental", "staging", "production", "archived")
CLAIM_STATUSES = ("pending", "approved", "rejected", "resubmitted", "under_review")


def conform(df: DataFrame, schema: StructType, *, strict: bool = False) -> DataFrame:
    """Order and cast the columns of ``df`` to ``schema``.

    A value that does not fit its type becomes NULL, a column the frame lacks is
    added as NULL, and protocol columns (leading ``_``) are kept at the end.
    ``strict`` turns a NULL in a mandatory column into a run-time error instead.
    """
    present = set(df.columns)
    picked = []
    for field in schema.fields:
        if field.name in present:
            value = F.col(field.name).try_cast(field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        if strict and not field.nullable:
            value = F.coalesce(
                value,
                F.raise_error(F.lit(f"{field.name} is mandatory")).cast(field.dataType),
            )
        picked.append(value.alias(field.name))
    known = set(schema.fieldNames())
    extras = [F.col(c) for c in df.columns if c.startswith("_") and c not in known]
    return df.select(*picked, *extras)
