"""The canonical entities over the test tables.

Each binding takes the columns wanted and only joins the tables they need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(value: Column) -> Column:
    return value.cast("decimal(18,4)")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def _claimed() -> Column:
    return _money(F.col("l_extendedprice") * F.col("l_discount"))


def _month(column: str) -> Column:
    return F.substring(F.col(column).cast("date").cast("string"), 1, 7)


TRANSACTION_COLUMNS = {
    "transaction_id": lambda: F.concat_ws("-", "l_orderkey", "l_linenumber"),
    "distributor_id": lambda: F.col("l_suppkey").cast("string"),
    "customer_id": lambda: F.col("o_custkey").cast("string"),
    "product_id": lambda: F.col("l_partkey").cast("string"),
    "transaction_date": lambda: F.col("o_orderdate").cast("date"),
    "quantity": lambda: F.col("l_quantity").cast("int"),
    "unit_price": lambda: _money(F.col("p_retailprice")),
    "gross_amount": lambda: _money(F.col("l_extendedprice")),
    "transaction_type": lambda: F.col("l_returnflag"),
    "product_category": lambda: F.col("p_type"),
    "customer_segment": lambda: F.col("c_mktsegment"),
    "region": lambda: F.col("n_regionkey"),
}
TRANSACTION_DEFAULT = tuple(
    c for c in TRANSACTION_COLUMNS if c not in ("product_category", "customer_segment", "region")
)


def transactions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order lines as transactions."""
    wanted = columns or TRANSACTION_DEFAULT
    df = _lines(spark, sf_dir)
    if {"unit_price", "product_category"} & set(wanted):
        part = table(spark, sf_dir, "part")
        df = df.join(part, df["l_partkey"] == part["p_partkey"])
    if {"customer_segment", "region"} & set(wanted):
        customer = table(spark, sf_dir, "customer")
        df = df.join(customer, df["o_custkey"] == customer["c_custkey"])
    if "region" in wanted:
        nation = table(spark, sf_dir, "nation")
        df = df.join(nation, df["c_nationkey"] == nation["n_nationkey"])
    return df.select(*[TRANSACTION_COLUMNS[c]().alias(c) for c in wanted])


CHARGEBACK_COLUMNS = {
    "claim_id": lambda: F.concat_ws(
        "-", F.lit("CB"), "l_orderkey", "l_linenumber", "l_partkey"
    ),
    "distributor_id": lambda: F.col("l_suppkey").cast("string"),
    "customer_id": lambda: F.col("o_custkey").cast("string"),
    "product_id": lambda: F.col("l_partkey").cast("string"),
    "contract_id": lambda: F.col("o_orderkey").cast("string"),
    "claim_date": lambda: F.col("l_shipdate").cast("date"),
    "transaction_ref_id": lambda: F.concat(
        F.when(F.col("l_discount") >= 0.05, "").otherwise("X-"), F.concat_ws("-", "l_orderkey", "l_linenumber")
    ),
    "claim_amount": _claimed,
    "claim_status": lambda: F.when(F.col("l_returnflag") == "A", "approved")
    .when(F.col("l_returnflag") == "R", "rejected")
    .otherwise("pending"),
    "submission_count": lambda: F.col("l_linenumber").cast("int"),
}


def chargebacks(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order lines as claims; those with a small discount refer to no transaction that exists."""
    wanted = columns or tuple(CHARGEBACK_COLUMNS)
    if {"customer_id", "contract_id"} & set(wanted):
        df = _lines(spark, sf_dir)
    else:
        df = table(spark, sf_dir, "lineitem")
    return df.select(*[CHARGEBACK_COLUMNS[c]().alias(c) for c in wanted])


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contract per order."""
    start = F.col("o_orderdate").cast("date")
    percent = "decimal(8,4)"
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("contract_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("product_id"),
        F.col("o_orderstatus").alias("contract_type"),
        start.alias("effective_date"),
        F.when(F.col("o_orderstatus") != "O", F.date_add(start, 365)).alias("expiration_date"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("tier_count"),
        ((F.col("o_orderkey") % 20) / 100.0).cast(percent).alias("discount_pct"),
        ((F.col("o_orderkey") % 7) / 100.0).cast(percent).alias("rebate_pct"),
        F.when(F.col("o_orderkey") % 3 == 0, "Y").otherwise("N").alias("multi_product_flag"),
    )


def accruals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounts per month, customer and product as accruals, taxes as actuals."""
    paid = F.sum(_money(F.col("l_extendedprice") * F.col("l_tax")))
    # The alphabetically smallest flag is N: no line is A and some line is N.
    unpaid = (F.count_if(F.col("l_returnflag") == "A") == 0) & (
        F.count_if(F.col("l_returnflag") == "N") > 0
    )
    grouped = (
        _lines(spark, sf_dir)
        .groupBy(_month("o_orderdate").alias("period"), "o_custkey", "l_partkey")
        .agg(F.sum(_claimed()).alias("accrual_amount"), F.when(~unpaid, paid).alias("actual_amount"))
        .select(
            "period",
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            "accrual_amount",
            "actual_amount",
        )
    )
    return grouped.withColumns(
        {
            "variance": F.col("accrual_amount") - F.col("actual_amount"),
            "accrual_type": F.lit("rebate"),
        }
    )


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in groups (nations), groups in parents (regions); some links change by date.

    Every third customer moves to the next group in July 1995, every group to the next parent
    in 1997, and from 1998 the first two parents belong to each other.
    """
    moved, raised, merged = "1995-07-01", "1997-01-01", "1998-01-01"

    def link(df: DataFrame, child: Column, parent: Column, begin: str | None, end: Column) -> DataFrame:
        return df.select(
            child.alias("child"),
            parent.alias("parent"),
            F.lit(begin).cast("date").alias("valid_from"),
            end.cast("date").alias("valid_to"),
        )

    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    who, moves = F.col("c_custkey").cast("string"), F.col("c_custkey") % 3 == 0
    never = F.lit(None)

    def name(kind: str, number: Column) -> Column:
        return F.concat(F.lit(kind), number.cast("string"))

    own, parent = F.col("c_nationkey"), F.col("n_regionkey")
    group = name("G", F.col("n_nationkey"))
    first_two = region.where("r_regionkey < 2")
    return (
        link(customer, who, name("G", own), None, F.when(moves, F.date_sub(F.lit(moved).cast("date"), 1)))
        .union(link(customer.where(moves), who, name("G", (own + 1) % 25), moved, never))
        .union(link(nation, group, name("P", parent), None, F.date_sub(F.lit(raised).cast("date"), 1)))
        .union(link(nation, group, name("P", (parent + 1) % 5), raised, never))
        .union(link(first_two, name("P", F.col("r_regionkey")), name("P", 1 - F.col("r_regionkey")), merged, never))
    )


# -- raw layouts of the adapters -------------------------------------------------


def raw_867(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _lines(spark, sf_dir)
    part = table(spark, sf_dir, "part")
    return df.join(part, df["l_partkey"] == part["p_partkey"]).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("ref_id"),
        F.col("l_suppkey").cast("string").alias("dist_id"),
        F.col("o_custkey").cast("string").alias("ship_to_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.col("p_brand").alias("ndc"),
        F.date_format(F.col("o_orderdate"), "yyyyMMdd").alias("txn_date"),
        F.col("l_quantity").cast("int").cast("string").alias("qty"),
        F.col("p_retailprice").cast("string").alias("unit_price"),
    )


def raw_844(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims in the 844 layout; rejected claims carry a date that cannot be read."""
    claims = chargebacks(spark, sf_dir)
    compact = F.date_format("claim_date", "yyyyMMdd")
    return claims.select(
        F.col("claim_id").alias("claim_ref"),
        F.col("distributor_id").alias("dist_id"),
        F.col("customer_id").alias("end_cust_id"),
        F.col("product_id").alias("item_id"),
        F.col("contract_id").alias("contract_ref"),
        F.when(F.col("claim_status") == "rejected", F.lit("unknown"))
        .otherwise(compact)
        .alias("claim_date"),
        F.col("transaction_ref_id").alias("orig_txn_ref"),
        F.col("claim_amount").cast("string").alias("cb_amount"),
        F.col("claim_status").alias("status_code"),
        F.col("submission_count").cast("string").alias("submission_cnt"),
    )


def raw_849(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = chargebacks(spark, sf_dir)
    return claims.select(
        F.concat(F.lit("R"), F.col("claim_id")).alias("response_ref"),
        F.col("distributor_id").alias("dist_id"),
        F.col("customer_id").alias("end_cust_id"),
        F.col("product_id").alias("item_id"),
        F.col("contract_id").alias("contract_ref"),
        F.date_format("claim_date", "yyyyMMdd").alias("response_date"),
        F.col("claim_id").alias("orig_claim_ref"),
        F.col("claim_amount").cast("string").alias("approved_amount"),
        F.col("claim_status").alias("response_code"),
    )


def raw_erp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in the billing layout; pending lines have no plant, returned ones no readable value."""
    df = _lines(spark, sf_dir)
    part = table(spark, sf_dir, "part")
    df = df.join(part, df["l_partkey"] == part["p_partkey"])
    value = _money(F.col("l_extendedprice")).cast("string")
    return df.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("doc_number"),
        F.when(F.col("l_returnflag") != "N", F.col("l_suppkey").cast("string")).alias(
            "ship_from_plant"
        ),
        F.col("o_custkey").cast("string").alias("sold_to_party"),
        F.col("l_partkey").cast("string").alias("material_number"),
        F.col("p_brand").alias("ndc_number"),
        F.col("o_orderdate").cast("date").cast("string").alias("billing_date"),
        F.col("l_quantity").cast("int").cast("string").alias("billed_quantity"),
        F.col("p_retailprice").cast("string").alias("net_price"),
        F.when(F.col("l_returnflag") == "R", F.lit("n/a")).otherwise(value).alias("net_value"),
        F.col("l_linestatus").alias("doc_type"),
    )


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = chargebacks(spark, sf_dir)
    return claims.select(
        F.col("claim_id").alias("claim_number"),
        F.col("distributor_id").alias("wholesaler_id"),
        F.col("customer_id").alias("member_id"),
        F.col("product_id").alias("product_code"),
        F.col("contract_id").alias("agreement_number"),
        F.col("claim_date").cast("string").alias("submitted_date"),
        F.col("transaction_ref_id").alias("invoice_ref"),
        F.col("claim_amount").cast("string").alias("claimed_amount"),
        F.col("claim_status").alias("processing_status"),
        F.col("submission_count").cast("string").alias("submit_count"),
    )


def raw_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts in their raw layout; every contract of type F has a discount above 1."""
    terms = contracts(spark, sf_dir)
    discount = F.when(F.col("contract_type") == "F", F.col("discount_pct") + 1).otherwise(
        F.col("discount_pct")
    )
    return terms.select(
        F.col("contract_id").alias("agreement_id"),
        F.col("customer_id").alias("account_id"),
        F.col("product_id").alias("material_group"),
        F.col("contract_type").alias("agreement_type"),
        F.col("effective_date").cast("string").alias("start_date"),
        F.col("expiration_date").cast("string").alias("end_date"),
        F.col("tier_count").cast("string").alias("num_tiers"),
        discount.cast("string").alias("base_discount"),
        F.col("rebate_pct").cast("string").alias("rebate_rate"),
        F.col("multi_product_flag").alias("bundle_flag"),
    )
