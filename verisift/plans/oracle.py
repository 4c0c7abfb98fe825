"""SQL twins of the registered queries, over the plain test tables.

Same columns and types as the Spark results: bigint, double rounded to six places,
text and boolean.
"""

from __future__ import annotations

AS_OF = "DATE '1998-06-30'"


def num(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE) * 1e6) / 1e6 + 0.0"


def whole(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def text(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def share(hits: str, base: str, empty: float) -> str:
    return f"CASE WHEN {base} = 0 THEN {empty} ELSE CAST({hits} AS DOUBLE) / {base} END"


MONEY = "DECIMAL(18,4)"

TX = f"""tx AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         CAST(l_suppkey AS VARCHAR) AS distributor_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(o_orderdate AS DATE) AS transaction_date,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS {MONEY}) AS unit_price,
         CAST(l_extendedprice AS {MONEY}) AS gross_amount,
         l_returnflag AS transaction_type,
         p_type AS product_category,
         c_mktsegment AS customer_segment,
         n_regionkey AS region,
         l_linestatus, p_brand, l_shipdate
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)"""

CB = f"""cb AS (
  SELECT 'CB-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
           || '-' || CAST(l_partkey AS VARCHAR) AS claim_id,
         CAST(l_suppkey AS VARCHAR) AS distributor_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(o_orderkey AS VARCHAR) AS contract_id,
         CAST(l_shipdate AS DATE) AS claim_date,
         CASE WHEN l_discount >= 0.05 THEN '' ELSE 'X-' END || CAST(l_orderkey AS VARCHAR) || '-'
           || CAST(l_linenumber AS VARCHAR) AS transaction_ref_id,
         CAST(l_extendedprice * l_discount AS {MONEY}) AS claim_amount,
         CASE l_returnflag WHEN 'A' THEN 'approved' WHEN 'R' THEN 'rejected' ELSE 'pending' END
           AS claim_status,
         CAST(l_linenumber AS INTEGER) AS submission_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

CT = """ct AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS contract_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         o_orderpriority AS product_id,
         o_orderstatus AS contract_type,
         CAST(o_orderdate AS DATE) AS effective_date,
         CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 365 END AS expiration_date,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS tier_count,
         CAST((o_orderkey % 20) / 100.0 AS DECIMAL(8,4)) AS discount_pct,
         CAST((o_orderkey % 7) / 100.0 AS DECIMAL(8,4)) AS rebate_pct,
         CASE WHEN o_orderkey % 3 = 0 THEN 'Y' ELSE 'N' END AS multi_product_flag
  FROM orders)"""

ACTIVE = f"""{CT}, active AS (
  SELECT * FROM ct
  WHERE effective_date <= {AS_OF} AND (expiration_date IS NULL OR expiration_date >= {AS_OF}))"""

AC = f"""ac AS (
  SELECT *, accrual_amount - actual_amount AS variance, 'rebate' AS accrual_type FROM (
    SELECT substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 7) AS period,
           CAST(o_custkey AS VARCHAR) AS customer_id,
           CAST(l_partkey AS VARCHAR) AS product_id,
           sum(CAST(l_extendedprice * l_discount AS {MONEY})) AS accrual_amount,
           CASE WHEN min(l_returnflag) <> 'N'
                THEN sum(CAST(l_extendedprice * l_tax AS {MONEY})) END AS actual_amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    GROUP BY 1, 2, 3))"""

ORACLE_SQL: dict[str, str] = {}
Q = ORACLE_SQL

# -- sources ---------------------------------------------------------------------

Q["ingest_roundtrip"] = f"""
SELECT '2024-01-31' AS date, l_returnflag, {whole('count(*)')} AS row_count,
       {whole('sum(l_quantity)')} AS quantity
FROM lineitem GROUP BY l_returnflag"""

Q["latest_partition"] = f"""
SELECT '2024-02-01' AS date, o_orderstatus, {whole('count(*)')} AS row_count
FROM orders WHERE o_orderstatus = 'O' GROUP BY o_orderstatus"""

Q["published_scores"] = f"""
WITH {TX}
SELECT transaction_id, customer_id, {num('gross_amount')} AS gross_amount,
       '1.2.0' AS _audit_model_version, 'run-1' AS _audit_correlation_id,
       'gold_publisher' AS _audit_pipeline_name
FROM tx"""

# -- adapters --------------------------------------------------------------------

Q["adapter_867"] = f"""
WITH {TX}
SELECT transaction_id, 'edi_867' AS source_system, distributor_id, customer_id, product_id,
       p_brand AS ndc_code, {text('transaction_date')} AS transaction_date,
       {whole('quantity')} AS quantity, {num('unit_price')} AS unit_price,
       {num('quantity * unit_price')} AS gross_amount, 'transfer' AS transaction_type,
       quantity > 0 AS _valid
FROM tx"""

CLAIM_TAIL = f"""{num('claim_amount')} AS claim_amount, claim_status"""

Q["adapter_844"] = f"""
WITH {CB}
SELECT claim_id, 'edi_844' AS source_system, distributor_id, customer_id, product_id, contract_id,
       CASE WHEN claim_status <> 'rejected' THEN {text('claim_date')} END AS claim_date,
       transaction_ref_id, {CLAIM_TAIL}, {whole('submission_count')} AS submission_count,
       claim_amount > 0 AND claim_status <> 'rejected' AS _valid
FROM cb"""

Q["adapter_849"] = f"""
WITH {CB}
SELECT 'R' || claim_id AS claim_id, 'edi_849' AS source_system, distributor_id, customer_id,
       product_id, contract_id, {text('claim_date')} AS claim_date,
       claim_id AS transaction_ref_id, {CLAIM_TAIL}, CAST(NULL AS BIGINT) AS submission_count,
       true AS _valid
FROM cb"""

Q["adapter_claims"] = f"""
WITH {CB}
SELECT claim_id, 'claims_processor' AS source_system, distributor_id, customer_id, product_id,
       contract_id, {text('claim_date')} AS claim_date, transaction_ref_id, {CLAIM_TAIL},
       {whole('submission_count')} AS submission_count, claim_amount > 0 AS _valid
FROM cb"""

Q["adapter_erp"] = f"""
WITH {TX}
SELECT transaction_id, 'erp' AS source_system,
       CASE WHEN transaction_type = 'N' THEN 'DIRECT' ELSE distributor_id END AS distributor_id,
       customer_id, product_id, p_brand AS ndc_code,
       {text('transaction_date')} AS transaction_date, {whole('quantity')} AS quantity,
       {num('unit_price')} AS unit_price,
       CASE WHEN transaction_type <> 'R' THEN {num('gross_amount')} END AS gross_amount,
       l_linestatus AS transaction_type, transaction_type <> 'R' AS _valid
FROM tx"""

Q["adapter_contracts"] = f"""
WITH {CT}, raw AS (
  SELECT *, discount_pct + CASE WHEN contract_type = 'F' THEN 1 ELSE 0 END AS discount FROM ct)
SELECT contract_id, customer_id, product_id, contract_type,
       {text('effective_date')} AS effective_date, {text('expiration_date')} AS expiration_date,
       {whole('tier_count')} AS tier_count, {num('discount')} AS discount_pct,
       {num('rebate_pct')} AS rebate_pct, multi_product_flag,
       (expiration_date IS NULL OR expiration_date > effective_date)
         AND discount BETWEEN 0 AND 1 AS _valid
FROM raw"""

Q["audit_columns"] = f"""
WITH {TX}
SELECT transaction_id, '1.2.0' AS _audit_model_version,
       '{{"purchase_velocity": 3}}' AS _audit_feature_versions,
       'run-1' AS _audit_correlation_id, 'gold_publisher' AS _audit_pipeline_name
FROM tx"""

# -- checks ----------------------------------------------------------------------


def rate(check: str, column: str, hit: str, base: str, empty: float, source: str) -> str:
    """One check as a row; ``hit`` implies ``base``."""
    return f"""SELECT '{check}' AS "check", '{column}' AS "column", n AS numerator,
       d AS denominator, {num(share('n', 'd', empty))} AS rate
FROM (SELECT {whole(f'count(*) FILTER (WHERE ({hit}) AND ({base}))')} AS n,
             {whole(f'count(*) FILTER (WHERE {base})')} AS d FROM {source})"""


def union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


Q["required_columns"] = f"WITH {CT} " + union(
    *[
        rate("required", c, f"{c} IS NOT NULL", "true", 0.0, "ct")
        for c in ("contract_id", "expiration_date", "product_id")
    ]
)

Q["expected_periods"] = f"""
WITH {TX}, expected AS (
  SELECT (y - 1994) * 12 + m - 1 AS position,
         CAST(y AS VARCHAR) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') AS period
  FROM range(1994, 2003) AS years(y), range(1, 13) AS months(m))
SELECT {whole('position')} AS position, period FROM expected
WHERE period NOT IN (SELECT strftime(transaction_date, '%Y-%m') FROM tx)"""

Q["feed_completeness"] = f"""
WITH {TX}
SELECT {whole('position')} AS position, source
FROM (VALUES (0, '0'), (1, '7'), (2, 'warehouse-east'), (3, '9'), (4, '-1')) AS e(position, source)
WHERE source NOT IN (SELECT distributor_id FROM tx)"""

Q["duplicate_rate"] = f"""
WITH {TX}
SELECT 'duplicate_rate' AS "check", 'transaction_id' AS "column",
       {whole('count(*) - count(DISTINCT transaction_id)')} AS numerator,
       {whole('count(*)')} AS denominator,
       {num('(count(*) - count(DISTINCT transaction_id)) / CAST(count(*) AS DOUBLE)')} AS rate
FROM tx"""

SORTED = """row_number() OVER (PARTITION BY transaction_id ORDER BY distributor_id, product_id,
         quantity, gross_amount, transaction_type)"""
SORTABLE = f"""transaction_id, distributor_id, product_id, {whole('quantity')} AS quantity,
       {num('gross_amount')} AS gross_amount, transaction_type"""

Q["flag_duplicates"] = f"""
WITH {TX}
SELECT {SORTABLE}, rn > 1 AS _is_duplicate FROM (SELECT *, {SORTED} AS rn FROM tx)"""

Q["deduplicate"] = f"""
WITH {TX}
SELECT {SORTABLE} FROM (SELECT *, {SORTED} AS rn FROM tx) WHERE rn = 1"""

Q["referential_integrity"] = f"""WITH {TX} """ + rate(
    "referential_integrity",
    "customer_id",
    """customer_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer
                       WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))""",
    "customer_id IS NOT NULL",
    1.0,
    "tx",
)

Q["cross_source_alignment"] = f"""
WITH {TX}, {CB}, pairs AS (
  SELECT tx.distributor_id = cb.distributor_id AS same_d, tx.product_id = cb.product_id AS same_p,
         tx.customer_id = cb.customer_id AS same_c
  FROM tx JOIN cb ON transaction_id = transaction_ref_id)
""" + union(
    *[
        rate("cross_source", name, flag, "true", 0.0, "pairs")
        for name, flag in (
            ("distributor_id", "same_d"),
            ("product_id", "same_p"),
            ("customer_id", "same_c"),
        )
    ]
)

SHIPPED = """shipped AS (
  SELECT CAST(o_orderdate AS DATE) AS ordered, CAST(l_shipdate AS DATE) AS shipped
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

Q["sla_compliance"] = f"WITH {SHIPPED} " + rate(
    "within_sla", "shipped", "shipped - ordered <= 30", "true", 1.0, "shipped"
)

Q["staleness_score"] = f"""
WITH {TX}
SELECT transaction_id, {text('transaction_date')} AS transaction_date,
       {num(f"greatest(0.0, least(1.0, ({AS_OF} - transaction_date) / 90.0))")} AS _staleness_score
FROM tx"""

Q["value_range"] = f"WITH {TX} " + rate(
    "in_range", "quantity", "quantity BETWEEN 5 AND 40", "quantity IS NOT NULL", 1.0, "tx"
)

Q["outliers"] = f"""
WITH {TX}, x AS (SELECT *, CAST(gross_amount AS DOUBLE) AS v FROM tx)
SELECT transaction_id, {num('gross_amount')} AS gross_amount,
       abs((v - (SELECT avg(v) FROM x)) / (SELECT stddev_samp(v) FROM x)) > 1.5
         AS _is_outlier_gross_amount
FROM x"""

Q["outliers_by_category"] = f"""
WITH {TX}, x AS (SELECT *, CAST(gross_amount AS DOUBLE) AS v FROM tx),
m AS (SELECT product_category, avg(v) AS mean, stddev_samp(v) AS dev FROM x GROUP BY 1)
SELECT transaction_id, {num('gross_amount')} AS gross_amount, product_category,
       abs((v - mean) / dev) > 1.5 AS _is_outlier_gross_amount
FROM x JOIN m USING (product_category)"""

Q["valid_codes"] = f"WITH {CB} " + rate(
    "valid_codes",
    "claim_status",
    "claim_status IN ('approved', 'pending')",
    "claim_status IS NOT NULL",
    1.0,
    "cb",
)

Q["date_logic"] = f"WITH {SHIPPED} " + rate(
    "date_order",
    "ordered<shipped",
    "ordered < shipped",
    "ordered IS NOT NULL AND shipped IS NOT NULL",
    1.0,
    "shipped",
)

Q["positive_values"] = f"WITH {CT} " + union(
    *[
        rate("positive", c, f"{c} > 0", f"{c} IS NOT NULL", 1.0, "ct")
        for c in ("discount_pct", "rebate_pct", "tier_count")
    ]
)

# -- rules -----------------------------------------------------------------------


def expectation(position: int, kind: str, column: str | None, dimension: str, observed: str,
                source: str, passed: str = "observed = 0") -> str:
    named = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return f"""SELECT CAST({position} AS BIGINT) AS position, '{kind}' AS expectation,
       {named} AS "column", '{dimension}' AS dimension, observed, {passed} AS passed
FROM (SELECT {whole(observed)} AS observed FROM {source})"""


NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"


def nulls(column: str) -> str:
    return f"count(*) FILTER (WHERE {column} IS NULL)"


def repeats(column: str, source: str) -> str:
    return (
        f"coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM {source} "
        f"WHERE {column} IS NOT NULL GROUP BY {column}) WHERE n > 1), 0)"
    )


Q["expectation_suite"] = f"WITH {TX} " + union(
    expectation(0, "expect_column_to_exist", "transaction_id", "validity", "0", "(SELECT 1)"),
    expectation(1, NOT_NULL, "transaction_id", "completeness", nulls("transaction_id"), "tx"),
    expectation(2, UNIQUE, "transaction_id", "uniqueness", repeats("transaction_id", "tx"), "(SELECT 1)"),
    expectation(3, NOT_NULL, "customer_id", "completeness", nulls("customer_id"), "tx"),
    expectation(4, NOT_NULL, "product_id", "completeness", nulls("product_id"), "tx"),
    expectation(5, BETWEEN, "gross_amount", "accuracy", "count(*) FILTER (WHERE gross_amount < 0)", "tx"),
    expectation(6, BETWEEN, "quantity", "accuracy", "count(*) FILTER (WHERE quantity < 1)", "tx"),
    expectation(7, NOT_NULL, "transaction_date", "completeness", nulls("transaction_date"), "tx"),
)

Q["feature_expectation_suite"] = f"WITH {TX}, f AS (SELECT DISTINCT customer_id FROM tx) " + union(
    expectation(0, NOT_NULL, "customer_id", "completeness", nulls("customer_id"), "f"),
    expectation(1, UNIQUE, "customer_id", "uniqueness", repeats("customer_id", "f"), "(SELECT 1)"),
    expectation(
        2, "expect_table_row_count_to_be_between", None, "completeness", "count(*)", "f", "observed >= 1"
    ),
)

Q["rule_results"] = f"""
WITH {TX}, m AS (
  SELECT avg(CASE WHEN quantity BETWEEN 5 AND 40 THEN 1.0 ELSE 0.0 END) AS in_range,
         avg(CASE WHEN gross_amount > 0 THEN 1.0 ELSE 0.0 END) AS positive,
         avg(CASE WHEN transaction_type IN ('A', 'R') THEN 1.0 ELSE 0.0 END) AS codes
  FROM tx)
SELECT 'R-1' AS rule_id, in_range >= 0.5 AS passed, {num('in_range')} AS rate FROM m UNION ALL
SELECT 'R-2', positive >= 0.95, {num('positive')} FROM m UNION ALL
SELECT 'R-3', codes >= 0.9, {num('codes')} FROM m UNION ALL
SELECT 'R-4', false, NULL"""

# -- score and gate --------------------------------------------------------------


def scored(total: int, completeness_extra: int = 0) -> str:
    """Claims of the 844 adapter with flags and score; ``total`` columns count."""
    return f"""{CB}, flagged AS (
  SELECT claim_id, distributor_id, claim_amount, claim_status,
         row_number() OVER (PARTITION BY claim_id ORDER BY distributor_id, customer_id,
                            claim_amount, claim_status) > 1 AS _is_duplicate,
         claim_amount > 0 AND claim_status <> 'rejected' AS valid,
         CASE WHEN claim_status = 'rejected' THEN 1.0
              ELSE greatest(0.0, least(1.0, ({AS_OF} - claim_date) / CAST(900 AS DOUBLE))) END AS stale,
         11 - CASE WHEN claim_status = 'rejected' THEN 1 ELSE 0 END AS filled
  FROM cb), scored AS (
  SELECT *, round((CAST(filled AS DOUBLE) / {total} * CAST(0.25 AS DOUBLE)
                   + (1.0 - CASE WHEN _is_duplicate THEN 1.0 ELSE 0.0 END) * CAST(0.15 AS DOUBLE)
                   + CAST(0.2 AS DOUBLE)
                   + (CAST(1.0 AS DOUBLE) - stale) * CAST(0.1 AS DOUBLE)
                   + CAST(0.2 AS DOUBLE)
                   + CASE WHEN valid THEN CAST(0.1 AS DOUBLE) ELSE 0.0 END) * 100, 2) AS dq_score
  FROM flagged)"""


CLAIM_VIEW = f"""claim_id, distributor_id, {num('claim_amount')} AS claim_amount, _is_duplicate,
       {num('dq_score')} AS dq_score"""

Q["dq_score"] = f"WITH {scored(11)} SELECT {CLAIM_VIEW} FROM scored"
Q["dq_score_coded"] = f"WITH {scored(12)} SELECT {CLAIM_VIEW} FROM scored"
Q["gate_passed"] = f"WITH {scored(11)} SELECT {CLAIM_VIEW} FROM scored WHERE dq_score >= 92"
Q["gate_quarantined"] = f"""
WITH {scored(11)}
SELECT claim_id, claim_status, {num('dq_score')} AS dq_score,
       'below_dq_threshold' AS _quarantine_reason
FROM scored WHERE dq_score < 92"""
Q["gate_summary"] = f"""
WITH {scored(11)}
SELECT {whole('count(*)')} AS total_count,
       {whole('count(*) FILTER (WHERE dq_score >= 92)')} AS passed_count,
       {whole('count(*) FILTER (WHERE dq_score < 92)')} AS quarantined_count,
       {num('round(avg(dq_score), 2)')} AS mean_dq_score
FROM scored"""

# -- features --------------------------------------------------------------------


def trailing(days: int) -> str:
    return f"""sum(gross_amount) OVER (PARTITION BY customer_id ORDER BY transaction_date
           RANGE BETWEEN INTERVAL {days} DAYS PRECEDING AND CURRENT ROW)"""


VELOCITY = f"""{TX}, rolled AS (
  SELECT transaction_id, customer_id, transaction_date, gross_amount,
         {trailing(30)} AS v30, {trailing(60)} AS v60, {trailing(90)} AS v90
  FROM tx), velocity AS (
  SELECT customer_id, arg_max(v30, transaction_date) AS v30, arg_max(v60, transaction_date) AS v60,
         arg_max(v90, transaction_date) AS v90
  FROM rolled GROUP BY customer_id)"""
VELOCITY_COLUMNS = f"""{num('v30')} AS purchase_velocity_30d, {num('v60')} AS purchase_velocity_60d,
       {num('v90')} AS purchase_velocity_90d"""

Q["purchase_velocity"] = f"WITH {VELOCITY} SELECT customer_id, {VELOCITY_COLUMNS} FROM velocity"
Q["velocity_rows"] = f"""
WITH {VELOCITY}
SELECT customer_id, {text('transaction_date')} AS transaction_date,
       {num('gross_amount')} AS gross_amount, transaction_id, {VELOCITY_COLUMNS}
FROM rolled"""

REGULARITY = f"""gaps AS (
  SELECT customer_id, transaction_date - lag(transaction_date) OVER (
           PARTITION BY customer_id ORDER BY transaction_date) AS gap FROM tx), regularity AS (
  SELECT customer_id, avg(gap) AS mean, stddev_samp(gap) AS dev,
         CASE WHEN avg(gap) <> 0 THEN stddev_samp(gap) / avg(gap) END AS cv
  FROM gaps WHERE gap IS NOT NULL GROUP BY customer_id)"""
REGULARITY_COLUMNS = f"""{num('mean')} AS avg_order_gap_days, {num('dev')} AS stddev_order_gap_days,
       {num('cv')} AS ordering_regularity_cv"""
Q["ordering_regularity"] = f"""
WITH {TX}, {REGULARITY} SELECT customer_id, {REGULARITY_COLUMNS} FROM regularity"""

Q["mix_entropy"] = f"""
WITH {TX}, c AS (SELECT customer_id, product_category, count(*) AS n FROM tx GROUP BY 1, 2),
p AS (SELECT customer_id, n / CAST(sum(n) OVER (PARTITION BY customer_id) AS DOUBLE) AS p FROM c)
SELECT customer_id, {num('abs(sum(p * log2(p)))')} AS species_mix_entropy FROM p GROUP BY 1"""

# all raw lines pass the gate, so the stored feature is that of all transactions
Q["feature_pipeline"] = Q["mix_entropy"]

Q["loyalty_index"] = f"""
WITH {TX}, d AS (
  SELECT customer_id, distributor_id, sum(gross_amount) AS amount FROM tx GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY amount DESC, distributor_id DESC) AS rn,
      sum(amount) OVER (PARTITION BY customer_id) AS total FROM d)
SELECT customer_id, distributor_id AS top_distributor_id,
       {num('CAST(amount AS DOUBLE) / CAST(total AS DOUBLE)')} AS loyalty_index
FROM r WHERE rn = 1"""

Q["rate_of_change"] = f"""
WITH {TX}, m AS (
  SELECT customer_id, strftime(transaction_date, '%Y-%m') AS period, sum(gross_amount) AS sales
  FROM tx GROUP BY 1, 2), l AS (
  SELECT *, lag(sales, 1) OVER w AS l1, lag(sales, 3) OVER w AS l3 FROM m
  WINDOW w AS (PARTITION BY customer_id ORDER BY period))
SELECT customer_id, period, {num('sales')} AS sales, {num('l1')} AS sales_lag_1,
       {num('l3')} AS sales_lag_3,
       {num('CAST(sales - l1 AS DOUBLE) / CAST(l1 AS DOUBLE)')} AS sales_change_1,
       {num('CAST(sales - l3 AS DOUBLE) / CAST(l3 AS DOUBLE)')} AS sales_change_3
FROM l"""

COMPLEXITY = f"""complexity AS (
  SELECT customer_id, {whole('count(contract_id)')} AS active_contract_count,
         {whole('sum(tier_count)')} AS total_active_tiers,
         {num('avg(tier_count)')} AS avg_tiers_per_contract,
         {whole("count(*) FILTER (WHERE multi_product_flag = 'Y')")} AS multi_product_contract_count,
         {num('max(discount_pct)')} AS max_discount_pct,
         {num('CAST(sum(rebate_pct) AS DOUBLE) / count(rebate_pct)')} AS avg_rebate_pct
  FROM active GROUP BY customer_id)"""
Q["contract_complexity"] = f"WITH {ACTIVE}, {COMPLEXITY} SELECT * FROM complexity"

Q["days_to_expiration"] = f"""
WITH {CT}
SELECT customer_id, {whole(f'min(expiration_date - {AS_OF})')} AS days_to_nearest_expiration
FROM ct WHERE expiration_date >= {AS_OF} GROUP BY customer_id"""

Q["contract_overlap"] = f"""
WITH {ACTIVE}
SELECT a.customer_id, {whole('count(*)')} AS contract_overlap_count
FROM active a JOIN active b ON a.customer_id = b.customer_id AND a.product_id = b.product_id
 AND a.contract_id < b.contract_id
GROUP BY a.customer_id"""

Q["tier_proximity"] = f"""
WITH {TX}, {ACTIVE}, ytd AS (
  SELECT customer_id, sum(gross_amount) AS ytd FROM tx
  WHERE transaction_date BETWEEN DATE '1998-01-01' AND {AS_OF} GROUP BY 1), n AS (
  SELECT contract_id, active.customer_id, coalesce(ytd, 0) AS ytd, tier_count
  FROM active LEFT JOIN ytd ON active.customer_id = ytd.customer_id), t AS (
  SELECT *, (SELECT min(i * 50000) FROM range(1, 6) AS r(i)
             WHERE i <= tier_count AND i * 50000 > ytd) AS next FROM n)
SELECT contract_id, customer_id, {num('ytd')} AS ytd_sales, {num('next')} AS next_threshold,
       {num('next - ytd')} AS amount_to_next_tier,
       {num('coalesce(CAST(ytd AS DOUBLE) / next, 1.0)')} AS tier_proximity_pct,
       {whole(f"DATE '1999-01-01' - {AS_OF}")} AS days_to_tier_reset
FROM t"""

Q["rebate_ratio"] = f"""
WITH {TX}, {AC}, s AS (
  SELECT customer_id, strftime(transaction_date, '%Y-%m') AS period, sum(gross_amount) AS total_sales
  FROM tx GROUP BY 1, 2), r AS (
  SELECT customer_id, period, sum(accrual_amount) AS total_rebate FROM ac GROUP BY 1, 2)
SELECT s.customer_id, s.period, {num('total_sales')} AS total_sales,
       {num('total_rebate')} AS total_rebate,
       {num('coalesce(CAST(total_rebate AS DOUBLE) / CAST(total_sales AS DOUBLE), 0)')}
         AS rebate_to_sales_ratio
FROM s LEFT JOIN r ON s.customer_id = r.customer_id AND s.period = r.period"""

Q["submission_counts"] = f"""
WITH {CB}
SELECT distributor_id, {num('avg(submission_count)')} AS avg_submission_count,
       {whole('max(submission_count)')} AS max_submission_count
FROM cb WHERE transaction_ref_id IS NOT NULL GROUP BY distributor_id"""

Q["submission_lag"] = f"""
WITH {TX}, {CB}, s AS (
  SELECT transaction_id, min(transaction_date) AS sold FROM tx GROUP BY 1), l AS (
  SELECT distributor_id, submission_count, claim_date - sold AS lag
  FROM cb LEFT JOIN s ON transaction_ref_id = transaction_id)
SELECT distributor_id, {num('avg(submission_count)')} AS avg_submission_count,
       {whole('max(submission_count)')} AS max_submission_count,
       {num('avg(lag)')} AS avg_submission_lag_days,
       {num('quantile_cont(lag, 0.5)')} AS p50_submission_lag_days,
       {num('quantile_cont(lag, 0.9)')} AS p90_submission_lag_days,
       {whole('max(lag)')} AS max_submission_lag_days
FROM l GROUP BY distributor_id"""

Q["over_under"] = f"""
WITH {AC}
SELECT customer_id, {num('CAST(sum(variance) AS DOUBLE) / count(variance)')} AS avg_accrual_variance,
       {whole('count(*) FILTER (WHERE variance > 0)')} AS over_accrual_count,
       {whole('count(*) FILTER (WHERE variance < 0)')} AS under_accrual_count,
       {whole('count(*)')} AS total_accrual_periods
FROM ac WHERE actual_amount IS NOT NULL GROUP BY customer_id"""

MONTHLY = f"""{AC}, monthly AS (
  SELECT customer_id, period, sum(accrual_amount) AS amount,
         CAST(substr(period, 1, 4) AS INTEGER) * 12 + CAST(substr(period, 6, 2) AS INTEGER) AS m
  FROM ac GROUP BY 1, 2)"""


def rebate_windows(frame: str, order: str) -> str:
    def over(n: int) -> str:
        return (
            f"sum(amount) OVER (PARTITION BY customer_id ORDER BY {order} "
            f"{frame} BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        )

    return f"""
WITH {MONTHLY}, v AS (
  SELECT customer_id, m, {over(3)} AS v3, {over(6)} AS v6, {over(12)} AS v12 FROM monthly)
SELECT customer_id, {num('arg_max(v3, m)')} AS rebate_velocity_3m,
       {num('arg_max(v6, m)')} AS rebate_velocity_6m, {num('arg_max(v12, m)')} AS rebate_velocity_12m
FROM v GROUP BY customer_id"""


Q["rebate_velocity"] = rebate_windows("RANGE", "m")
Q["rebate_velocity_rows"] = rebate_windows("ROWS", "period")

Q["distributor_errors"] = f"""
WITH {CB}
SELECT distributor_id, {whole('count(*)')} AS claim_count,
       {whole("count(*) FILTER (WHERE claim_status = 'rejected')")} AS rejected_count,
       {whole('count(*) FILTER (WHERE submission_count > 1)')} AS resubmitted_count,
       {num("avg(CASE WHEN claim_status = 'rejected' THEN 1.0 ELSE 0.0 END)")} AS distributor_error_rate,
       {num('avg(CASE WHEN submission_count > 1 THEN 1.0 ELSE 0.0 END)')} AS resubmission_rate
FROM cb GROUP BY distributor_id"""


def seasonal(groups: str, name: str, where: str = "true") -> str:
    prefix = f"{groups}, " if groups else ""
    partition = f"PARTITION BY {groups}" if groups else ""
    shown = "CAST(region AS BIGINT) AS region, product_category, " if "region" in groups else prefix
    return f"""
WITH {TX}, m AS (
  SELECT {prefix}month(transaction_date) AS month,
         CAST(sum(gross_amount) AS DOUBLE) / count(*) AS mean
  FROM tx WHERE {where} GROUP BY {prefix}month(transaction_date))
SELECT {shown}{whole('month')} AS month, {num('mean')} AS avg_monthly_sales,
       {num(f'mean / avg(mean) OVER ({partition})')} AS {name}
FROM m"""


Q["seasonal_index"] = seasonal("", '"PROMO_seasonal_index"', "product_category = 'PROMO'")
Q["seasonal_indices"] = seasonal("product_category", "seasonal_index")
Q["regional_cycle"] = seasonal("region, product_category", "seasonal_index")

Q["yoy_growth"] = f"""
WITH {TX}, y AS (
  SELECT customer_id, product_id, year(transaction_date) AS year, sum(gross_amount) AS amount
  FROM tx GROUP BY 1, 2, 3)
SELECT c.customer_id, c.product_id, {whole('c.year')} AS year, {num('c.amount')} AS annual_sales,
       {num('p.amount')} AS prev_year_sales,
       CASE WHEN p.amount > 0
            THEN {num('CAST(c.amount - p.amount AS DOUBLE) / CAST(p.amount AS DOUBLE)')} END
         AS yoy_growth_rate
FROM y c LEFT JOIN y p ON c.customer_id = p.customer_id AND c.product_id = p.product_id
 AND c.year = p.year + 1"""

Q["vaccine_season"] = f"""
WITH {TX}
SELECT transaction_id, {text('transaction_date')} AS transaction_date,
       month(transaction_date) IN (3, 4, 5, 9, 10, 11) AS is_vaccine_season
FROM tx"""

Q["source_completeness"] = f"""
WITH {CT}
SELECT contract_id, customer_id, product_id, contract_type,
       {text('effective_date')} AS effective_date, {text('expiration_date')} AS expiration_date,
       {whole('tier_count')} AS tier_count, {num('discount_pct')} AS discount_pct,
       {num('rebate_pct')} AS rebate_pct, multi_product_flag,
       CASE WHEN expiration_date IS NULL THEN 0.9 ELSE 1.0 END::DOUBLE AS feat_source_completeness
FROM ct"""

Q["staleness_days"] = f"""
WITH {TX}
SELECT transaction_id, {text('transaction_date')} AS transaction_date,
       {whole(f'{AS_OF} - transaction_date')} AS feat_staleness_days
FROM tx"""

REFERENCE = """ref AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, 'BUILDING' AS segment FROM customer
  WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), 'MACHINERY' FROM customer
  WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))"""


def matched(confidence: str) -> str:
    return f"""
WITH {TX}, {REFERENCE}
SELECT transaction_id, customer_id, customer_segment,
       {num(f'round({confidence}, 4)')} AS feat_match_confidence
FROM tx"""


Q["match_any"] = matched(
    "(CASE WHEN customer_id IN (SELECT id FROM ref) THEN 0.5 ELSE 0.0 END"
    " + CASE WHEN customer_segment IN (SELECT segment FROM ref) THEN 0.5 ELSE 0.0 END)"
)
Q["match_all"] = matched(
    "CASE WHEN EXISTS (SELECT 1 FROM ref WHERE id = customer_id AND segment = customer_segment)"
    " THEN 1.0 ELSE 0.0 END"
)

Q["near_duplicates"] = f"""
WITH {CB}, g AS (
  SELECT *, claim_date - lag(claim_date) OVER w AS back, lead(claim_date) OVER w - claim_date AS ahead
  FROM cb WINDOW w AS (PARTITION BY customer_id, distributor_id ORDER BY claim_date))
SELECT claim_id, customer_id, distributor_id, {text('claim_date')} AS claim_date,
       {num('round(coalesce(greatest(0.0, 1.0 - least(back, ahead) / CAST(31 AS DOUBLE)), 0.0), 4)')}
         AS feat_duplicate_probability
FROM g"""

# -- store, catalog, lineage -----------------------------------------------------

Q["feature_versions"] = Q["purchase_velocity"]
Q["feature_manifest"] = f"""
WITH {ACTIVE}, n AS (SELECT count(DISTINCT customer_id) AS n FROM active)
SELECT CAST(1 AS BIGINT) AS version, CAST(1 AS BIGINT) AS part_count, {whole('n')} AS row_count FROM n
UNION ALL SELECT 2, 2, {whole('2 * n')} FROM n"""

REGISTERED = """reg AS (
  SELECT p_name AS name, CAST(p_size AS VARCHAR) AS version, p_brand AS domain, p_type AS definition,
         strftime(to_timestamp(p_partkey) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS registered_at,
         row_number() OVER (PARTITION BY p_name, p_size ORDER BY p_partkey DESC) AS rn
  FROM part)"""
Q["catalog_search"] = f"""
WITH {REGISTERED}
SELECT name, version, domain, definition, registered_at FROM reg
WHERE rn = 1 AND name ILIKE '%ring%'"""
Q["catalog_get"] = f"""
WITH {REGISTERED}
SELECT name, version, domain, definition, registered_at FROM reg
WHERE rn = 1 AND name = 'red widget'"""

Q["lineage_upstream"] = """
WITH chain AS (
  SELECT 'order-' || o_orderkey AS asset, 'customer-' || o_custkey AS c,
         'nation-' || n_nationkey AS n, 'region-' || n_regionkey AS r
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT asset, c AS upstream, CAST(1 AS BIGINT) AS depth FROM chain
UNION ALL SELECT asset, n, 2 FROM chain
UNION ALL SELECT asset, r, 3 FROM chain"""

# -- monitoring ------------------------------------------------------------------

Q["null_rates"] = f"WITH {AC} " + union(
    *[
        rate("null_rate", c, f"{c} IS NULL", "true", 1.0, "ac")
        for c in (
            "period",
            "customer_id",
            "product_id",
            "accrual_amount",
            "actual_amount",
            "variance",
            "accrual_type",
        )
    ]
)


def health(column: str, numeric: bool) -> str:
    stats = (
        f"{num(f'avg(CAST({column} AS DOUBLE))')} AS mean, {num(f'stddev_samp({column})')} AS stddev"
        if numeric
        else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev"
    )
    return f"""SELECT 'contract_features' AS feature, '{column}' AS "column",
       {whole('count(*)')} AS record_count,
       {num(f'1 - count({column}) / CAST(count(*) AS DOUBLE)')} AS null_rate, {stats},
       {num("date_diff('day', max(newest_contract), DATE '2002-01-01') + 0.5")} AS freshness_days
FROM f"""


Q["feature_health"] = f"""
WITH {ACTIVE}, {COMPLEXITY}, f AS (
  SELECT complexity.*, newest_contract FROM complexity JOIN (
    SELECT customer_id, max(effective_date) AS newest_contract FROM ct GROUP BY 1) USING (customer_id))
""" + union(
    health("customer_id", False),
    *[
        health(c, True)
        for c in (
            "active_contract_count",
            "total_active_tiers",
            "avg_tiers_per_contract",
            "multi_product_contract_count",
            "max_discount_pct",
            "avg_rebate_pct",
        )
    ],
    health("newest_contract", False),
)

Q["training_join"] = f"""
WITH {VELOCITY}, {ACTIVE}, {COMPLEXITY}, {REGULARITY}
SELECT velocity.customer_id, {VELOCITY_COLUMNS}, complexity.* EXCLUDE (customer_id),
       {REGULARITY_COLUMNS}
FROM velocity LEFT JOIN complexity ON velocity.customer_id = complexity.customer_id
LEFT JOIN regularity ON velocity.customer_id = regularity.customer_id"""


def profiled(column: str, kind: str, numeric: bool) -> str:
    stats = (
        f"{num(f'avg(CAST({column} AS DOUBLE))')} AS mean, {num(f'stddev_samp({column})')} AS stddev"
        if numeric
        else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev"
    )
    return f"""SELECT '{column}' AS "column", '{kind}' AS type, {whole(f'count({column})')} AS count,
       {stats}, {text(f'min({column})')} AS min, {text(f'max({column})')} AS max,
       {num(f'count({column}) / CAST(count(*) AS DOUBLE)')} AS non_null_rate
FROM tx"""


Q["profile"] = f"WITH {TX} " + union(
    profiled("transaction_id", "string", False),
    profiled("customer_id", "string", False),
    profiled("transaction_date", "date", False),
    profiled("quantity", "int", True),
    profiled("gross_amount", "decimal(18,4)", True),
)


def stability(column: str) -> str:
    """Stability of one column over the nine deciles of the baseline."""
    cuts = ", ".join(str(i / 10) for i in range(1, 10))
    return f"""SELECT '{column}' AS "column", {whole('count(*)')} AS bins,
       {num('sum((a - b) * ln(a / b))')} AS psi
FROM (
  SELECT greatest(0.0001, count(*) FILTER (WHERE s = 'F') / CAST(max(nf) AS DOUBLE)) AS b,
         greatest(0.0001, count(*) FILTER (WHERE s = 'O') / CAST(max(nn) AS DOUBLE)) AS a
  FROM (SELECT l_linestatus AS s, len(list_filter(
                 list_distinct((SELECT quantile_disc({column}, [{cuts}]) FROM lineitem
                                WHERE l_linestatus = 'F')), lambda e: e < {column})) AS bin,
               count(*) FILTER (WHERE l_linestatus = 'F') OVER () AS nf,
               count(*) FILTER (WHERE l_linestatus = 'O') OVER () AS nn
        FROM lineitem)
  GROUP BY bin)"""


Q["drift_psi"] = union(*[stability(c) for c in ("l_quantity", "l_discount", "l_linenumber")])

Q["drift_ks"] = f"""
WITH v AS (
  SELECT l_extendedprice AS value, count(*) FILTER (WHERE l_linestatus = 'F') AS b,
         count(*) FILTER (WHERE l_linestatus = 'O') AS c FROM lineitem GROUP BY 1), r AS (
  SELECT sum(b) OVER w / CAST(sum(b) OVER () AS DOUBLE) AS fb,
         sum(c) OVER w / CAST(sum(c) OVER () AS DOUBLE) AS fc
  FROM v WINDOW w AS (ORDER BY value))
SELECT 'l_extendedprice' AS "column", {num('max(abs(fb - fc))')} AS ks FROM r"""

# -- metrics ---------------------------------------------------------------------

Q["regression_metrics"] = f"""
WITH p AS (
  SELECT l_extendedprice AS y, l_quantity * p_retailprice AS p, abs(l_extendedprice - l_quantity * p_retailprice) AS e
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT {num('avg(e)')} AS mae, {num('avg(e / greatest(abs(y), 2.220446049250313e-16))')} AS mape,
       {num('sqrt(avg(e * e))')} AS rmse,
       {num('1 - sum(e * e) / (var_pop(y) * count(y))')} AS r2,
       {num('avg(e)')} AS mean_accrual_variance
FROM p"""

Q["leakage_metrics"] = f"""
WITH {CB}
SELECT {whole('count(*) FILTER (WHERE claim_amount > 4000)')} AS total_flagged,
       {num('count(*) FILTER (WHERE claim_amount > 4000) / CAST(count(*) AS DOUBLE)')} AS leakage_rate,
       {num('coalesce(sum(claim_amount) FILTER (WHERE claim_amount > 4000), 0)')} AS estimated_leakage_amount,
       {whole('count(*)')} AS total_evaluated
FROM cb"""

CLASSES = """p AS (
  SELECT l_returnflag AS y, CASE WHEN l_linestatus = 'F' THEN 'R' ELSE 'N' END AS g FROM lineitem),
labels AS (SELECT y AS label FROM p UNION SELECT g FROM p),
counts AS (
  SELECT label, (SELECT count(*) FROM p WHERE y = label AND g = label) AS tp,
         (SELECT count(*) FROM p WHERE g = label) AS named,
         (SELECT count(*) FROM p WHERE y = label) AS support
  FROM labels),
scores AS (
  SELECT label, coalesce(tp / CAST(nullif(named, 0) AS DOUBLE), 0) AS precision,
         coalesce(tp / CAST(nullif(support, 0) AS DOUBLE), 0) AS recall,
         coalesce(2 * tp / CAST(nullif(named + support, 0) AS DOUBLE), 0) AS f1, support, tp
  FROM counts)"""

Q["class_metrics"] = f"""
WITH {CLASSES}
SELECT {num('sum(tp) / CAST(sum(support) AS DOUBLE)')} AS accuracy, {num('avg(f1)')} AS f1_macro,
       {num('sum(f1 * support) / sum(support)')} AS f1_weighted
FROM scores"""

Q["class_report"] = f"""
WITH {CLASSES}
SELECT label, {num('precision')} AS precision, {num('recall')} AS recall, {num('f1')} AS f1,
       {whole('support')} AS support FROM scores
UNION ALL
SELECT 'accuracy', {num('sum(tp) / CAST(sum(support) AS DOUBLE)')},
       {num('sum(tp) / CAST(sum(support) AS DOUBLE)')},
       {num('sum(tp) / CAST(sum(support) AS DOUBLE)')}, {whole('sum(support)')} FROM scores
UNION ALL
SELECT 'macro avg', {num('avg(precision)')}, {num('avg(recall)')}, {num('avg(f1)')},
       {whole('sum(support)')} FROM scores
UNION ALL
SELECT 'weighted avg', {num('sum(precision * support) / sum(support)')},
       {num('sum(recall * support) / sum(support)')}, {num('sum(f1 * support) / sum(support)')},
       {whole('sum(support)')} FROM scores"""

Q["returns_metrics"] = f"""
WITH p AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
         CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS g, l_extendedprice AS s FROM lineitem),
ranked AS (
  SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM p),
u AS (
  SELECT (CAST(sum(r) FILTER (WHERE y = 1) AS DOUBLE)
          - CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE)
            * (count(*) FILTER (WHERE y = 1) + 1) / 2)
         / (CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * count(*) FILTER (WHERE y = 0)) AS auc
  FROM ranked),
c AS (SELECT CAST(sum(y * g) AS DOUBLE) AS tp, sum(g) AS named, sum(y) AS actual, count(*) AS n FROM p)
SELECT {num('tp / named')} AS precision, {num('tp / actual')} AS recall,
       {num('2 * tp / (named + actual)')} AS f1,
       {num('actual / CAST(n AS DOUBLE)')} AS return_rate_actual,
       {num('named / CAST(n AS DOUBLE)')} AS return_rate_predicted, {num('auc')} AS auc_roc
FROM c, u"""

# -- model tables ----------------------------------------------------------------

RUNS = """runs AS (
  SELECT 'run-' || l_suppkey || '-' || strftime(l_shipdate, '%Y-%m') AS run_id,
         'model-' || l_suppkey AS model_name,
         CASE WHEN month(l_shipdate) = 12 THEN 'production' ELSE 'staging' END AS stage,
         strftime(l_shipdate, '%Y-%m') AS month, avg(l_quantity) AS mae,
         avg(l_discount) * 1000 AS data_quality
  FROM lineitem
  GROUP BY l_suppkey, strftime(l_shipdate, '%Y-%m'), month(l_shipdate))"""
Q["model_runs"] = f"""
WITH {RUNS}
SELECT arg_max(run_id, month) AS run_id, model_name, arg_max(stage, month) AS stage,
       {num('arg_max(mae, month)')} AS mae
FROM runs GROUP BY model_name"""
Q["model_stages"] = f"""
WITH {RUNS}
SELECT model_name, stage, arg_max(run_id, month) AS run_id FROM runs GROUP BY model_name, stage"""
Q["model_cards"] = f"""
SELECT p_name AS name, {whole('max(p_partkey)')} AS revision,
       arg_max(p_brand, p_partkey) AS training_dataset,
       arg_max(CAST(p_size AS VARCHAR), p_partkey) AS size
FROM part GROUP BY p_name"""
Q["governance"] = f"""
WITH {RUNS}
SELECT stage, {whole('count(DISTINCT model_name)')} AS models,
       max(month) || '-01 00:00:00' AS last_trained_at,
       {num('corr(data_quality, mae)')} AS quality_metric_corr
FROM runs GROUP BY stage"""

# -- what-if ---------------------------------------------------------------------

WHATIF = f"""{TX}, scenario AS (
  SELECT * FROM (VALUES (0, 'current', 'BUILDING'), (1, 'flat', 'BUILDING'),
                        (2, 'steep', 'MACHINERY'), (3, 'nowhere', 'ABSENT'), (4, 'fine', 'HOUSEHOLD'))
           AS s(position, scenario, segment)),
tier AS (
  SELECT position, CAST(threshold AS DECIMAL(28,10)) AS threshold, CAST(d AS DECIMAL(18,10)) AS d,
         CAST(r AS DECIMAL(18,10)) AS r
  FROM (VALUES (0, 0, 0.02, 0.01), (0, 20000, 0.03, 0.02), (0, 50000, 0.05, 0.02),
               (1, 0, 0.08, 0), (2, 10000, 0.05, 0.02), (2, 60000, 0.1, 0.02),
               (2, 90000, 0, 0.04), (3, 0, 0.5, 0.1), (3, 10, 0.5, 0.1),
               (4, 0, 0.012551, 0), (4, 20000.12345, 0.00005, 0.015))
         AS t(position, threshold, d, r)),
cost AS (
  SELECT t.position, CAST(sum(CAST(gross_amount AS DECIMAL(20,4)) * d) AS DOUBLE) AS total_discount,
         CAST(sum(CAST(gross_amount AS DECIMAL(20,4)) * r) AS DOUBLE) AS total_rebate
  FROM tier t JOIN scenario USING (position)
  JOIN tx ON customer_segment = segment AND gross_amount >= threshold
  GROUP BY 1),
gross AS (
  SELECT position, coalesce(CAST(sum(gross_amount) AS DOUBLE), 0) AS gross_revenue
  FROM scenario LEFT JOIN tx ON customer_segment = segment GROUP BY 1),
sim AS (
  SELECT s.position, scenario, segment, gross_revenue, coalesce(total_discount, 0) AS total_discount,
         coalesce(total_rebate, 0) AS total_rebate,
         gross_revenue - (coalesce(total_discount, 0) + coalesce(total_rebate, 0)) AS net_revenue
  FROM scenario s JOIN gross USING (position) LEFT JOIN cost USING (position))"""
COMPARED = f"""scenario, {num('gross_revenue')} AS gross_revenue, {num('net_revenue')} AS net_revenue,
       {num('gross_revenue - net_revenue')} AS gross_to_net_spread,
       {num('CASE WHEN gross_revenue = 0 THEN 0 ELSE net_revenue / (gross_revenue * 0.85) - 1 END')}
         AS net_price_change_pct"""
Q["whatif_simulation"] = f"""
WITH {WHATIF}
SELECT {whole('position')} AS position, segment, {num('total_discount')} AS total_discount,
       {num('total_rebate')} AS total_rebate, {COMPARED}
FROM sim"""
Q["whatif_compare"] = f"WITH {WHATIF} SELECT {COMPARED} FROM sim"
Q["whatif_impact"] = f"""
WITH {WHATIF}, base AS (SELECT net_revenue AS n0, gross_revenue - net_revenue AS s0 FROM sim WHERE position = 0)
SELECT {COMPARED}, {num('net_revenue - n0')} AS net_revenue_delta,
       {num('gross_revenue - net_revenue - s0')} AS gross_to_net_spread_delta,
       {num('CASE WHEN n0 = 0 THEN 0 ELSE (net_revenue - n0) / n0 END')} AS net_revenue_pct_change
FROM sim, base"""

# -- reports ---------------------------------------------------------------------

Q["accrual_health"] = f"""
WITH {AC}
SELECT {num('1 - CAST(sum(abs(variance)) AS DOUBLE) / CAST(sum(abs(actual_amount)) AS DOUBLE)')}
         AS accrual_accuracy,
       {num('CAST(sum(variance) AS DOUBLE) / count(variance)')} AS mean_variance,
       {whole('count(*) FILTER (WHERE variance > 0)')} AS over_accrual_count,
       {whole('count(*) FILTER (WHERE variance < 0)')} AS under_accrual_count
FROM ac WHERE actual_amount IS NOT NULL"""

Q["accrual_trend"] = f"""
WITH {AC}
SELECT period, {num('sum(variance)')} AS total_variance, {num('sum(abs(variance))')} AS absolute_variance,
       {whole('count(*)')} AS accrual_count
FROM ac WHERE actual_amount IS NOT NULL GROUP BY period"""

Q["variance_drivers"] = f"""
WITH {AC}, t AS (
  SELECT customer_id, product_id, sum(variance) AS v FROM ac WHERE actual_amount IS NOT NULL GROUP BY 1, 2)
SELECT customer_id, product_id, {num('v')} AS total_variance FROM t
ORDER BY abs(v) DESC, customer_id, product_id LIMIT 20"""

Q["leakage_summary"] = f"""
WITH {CB}
SELECT claim_status, {whole('count(*) FILTER (WHERE claim_amount > 4000)')} AS total_flagged,
       {num('coalesce(sum(claim_amount) FILTER (WHERE claim_amount > 4000), 0)')} AS estimated_leakage,
       {num('count(*) FILTER (WHERE claim_amount > 4000) / CAST(count(*) AS DOUBLE)')} AS leakage_rate
FROM cb GROUP BY claim_status"""

PSI = union(*[stability(c) for c in ("l_quantity", "l_discount")])
Q["feature_fleet"] = f"""
WITH {AC}, psi AS ({PSI}), f AS (
  SELECT 'orders' AS feature, 0.0 AS nulls,
         date_diff('day', max(o_orderdate), TIMESTAMP '2001-08-15') AS age, 0.0 AS psi FROM orders
  UNION ALL
  SELECT 'lines', 0.0, date_diff('day', max(l_shipdate), TIMESTAMP '2001-08-15'),
         (SELECT max(psi) FROM psi) FROM lineitem
  UNION ALL
  SELECT 'accruals', 1 - count(variance) / CAST(count(*) AS DOUBLE), 0, 0.0 FROM ac)
SELECT {whole('count(*)')} AS total_features,
       {whole('count(*) FILTER (WHERE nulls <= 0.1 AND age <= 1 AND psi < 0.2)')} AS healthy,
       {whole('count(*) FILTER (WHERE age > 1)')} AS stale,
       {whole('count(*) FILTER (WHERE psi >= 0.2)')} AS drift_alerts
FROM f"""

Q["claim_match"] = f"""
WITH {TX}, {CB}, s AS (
  SELECT transaction_id, min(transaction_date) AS d, sum(gross_amount) AS a FROM tx
  WHERE transaction_date < {AS_OF} GROUP BY 1)
SELECT claim_id, transaction_ref_id, {num('claim_amount')} AS claim_amount,
       {text('d')} AS matched_date, {num('a')} AS matched_amount,
       CASE WHEN transaction_ref_id IS NULL THEN 'no_reference'
            WHEN transaction_id IS NOT NULL THEN 'matched' ELSE 'unmatched' END AS match_status
FROM cb LEFT JOIN s ON transaction_ref_id = transaction_id"""

Q["as_of_terms"] = f"""
WITH {TX}, {CT}, h AS (
  SELECT customer_id, effective_date, max(ROW(tier_count, discount_pct)) AS state
  FROM ct GROUP BY 1, 2),
days AS (SELECT DISTINCT customer_id, transaction_date FROM tx),
terms AS (
  SELECT days.customer_id, transaction_date, arg_max(state, effective_date) AS state
  FROM days LEFT JOIN h ON days.customer_id = h.customer_id AND effective_date <= transaction_date
  GROUP BY 1, 2)
SELECT tx.customer_id, {text('tx.transaction_date')} AS transaction_date,
       {num('gross_amount')} AS gross_amount, transaction_id,
       {whole('state[1]')} AS tier_count, {num('state[2]')} AS discount_pct
FROM tx JOIN terms ON tx.customer_id = terms.customer_id AND tx.transaction_date = terms.transaction_date"""

# the customers with a sale have features and accruals
Q["accrual_model_report"] = f"""
WITH {AC}
SELECT {whole('count(DISTINCT customer_id)')} AS customers, {whole('count(DISTINCT customer_id)')} AS scored,
       {num('sum(accrual_amount)')} AS accrual_amount, TRUE AS fits_better_than_mean,
       TRUE AS predicts_better_than_mean, {whole('200')} AS trees
FROM ac"""

# -- overlaps, hierarchies and allocation ------------------------------------------

Q["near_duplicate_claims"] = f"""
WITH c AS (
  SELECT row_number() OVER () AS i, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS claim_id,
         CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_shipdate AS DATE) AS claim_date,
         CAST(l_extendedprice * l_discount AS {MONEY}) AS claim_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
n AS (
  SELECT a.i, max((1 - abs(a.claim_date - b.claim_date) / CAST(11 AS DOUBLE))
                  * (1 - CAST(abs(a.claim_amount - b.claim_amount) * 10000 AS DOUBLE) / 500001)) AS best
  FROM c a JOIN c b ON a.customer_id = b.customer_id AND a.i <> b.i AND abs(a.claim_date - b.claim_date) <= 10
   AND abs(a.claim_amount - b.claim_amount) <= 50 GROUP BY a.i)
SELECT claim_id, customer_id, {text('claim_date')} AS claim_date, {num('claim_amount')} AS claim_amount,
       {num('round(coalesce(best, 0.0), 4)')} AS feat_duplicate_closeness
FROM c LEFT JOIN n ON c.i = n.i"""

Q["near_duplicate_texts"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) = na.n AND na.n = nb.n AS same FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 5 * count(*) >= 4 * (na.n + nb.n - count(*))),
c AS (SELECT x, sum(CASE WHEN same THEN 1 ELSE 0 END) AS copies, bool_or(y < x) AS found FROM p GROUP BY x)
SELECT d.doc_id, CAST(coalesce(copies, 0) AS BIGINT) AS feat_text_copies,
       coalesce(c.found, FALSE) AS feat_text_duplicate
FROM d LEFT JOIN c ON d.doc_id = c.x"""

Q["contract_overlap_between"] = f"""
WITH {CT}, d AS (
  SELECT contract_id, customer_id, product_id, greatest(effective_date, DATE '1995-03-01') AS x,
         least(coalesce(expiration_date, DATE '1997-09-30'), DATE '1997-09-30') AS y
  FROM ct WHERE expiration_date IS NULL OR expiration_date >= effective_date),
c AS (SELECT * FROM d WHERE x <= y),
p AS (
  SELECT a.customer_id, count(*) AS pairs, sum(least(a.y, b.y) - greatest(a.x, b.x) + 1) AS days
  FROM c a JOIN c b ON a.customer_id = b.customer_id AND a.product_id = b.product_id
   AND a.contract_id < b.contract_id AND a.x <= b.y AND b.x <= a.y GROUP BY 1),
m AS (
  SELECT customer_id, max(n) AS most FROM (
    SELECT a.customer_id, a.product_id, a.x, count(*) AS n
    FROM (SELECT DISTINCT customer_id, product_id, x FROM c) a JOIN c b
      ON a.customer_id = b.customer_id AND a.product_id = b.product_id AND b.x <= a.x AND a.x <= b.y GROUP BY 1, 2, 3)
  GROUP BY 1)
SELECT p.customer_id, {whole('pairs')} AS overlapping_pairs, {whole('days')} AS overlap_days, {whole('most')} AS most_active
FROM p JOIN m ON p.customer_id = m.customer_id"""

LINKS = """links AS (
  SELECT CAST(c_custkey AS VARCHAR) AS child, 'G' || CAST(c_nationkey AS VARCHAR) AS parent, DATE '0001-01-01' AS f,
         CASE WHEN c_custkey % 3 = 0 THEN DATE '1995-06-30' ELSE DATE '9999-12-31' END AS t FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'G' || CAST((c_nationkey + 1) % 25 AS VARCHAR), DATE '1995-07-01', DATE '9999-12-31'
  FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT 'G' || CAST(n_nationkey AS VARCHAR), 'P' || CAST(n_regionkey AS VARCHAR), DATE '0001-01-01', DATE '1996-12-31' FROM nation
  UNION ALL SELECT 'G' || CAST(n_nationkey AS VARCHAR), 'P' || CAST((n_regionkey + 1) % 5 AS VARCHAR), DATE '1997-01-01',
                   DATE '9999-12-31' FROM nation
  UNION ALL SELECT 'P' || CAST(r_regionkey AS VARCHAR), 'P' || CAST(1 - r_regionkey AS VARCHAR), DATE '1998-01-01', DATE '9999-12-31'
  FROM region WHERE r_regionkey < 2),
ways(member, ancestor, f, t, level) AS (
  SELECT child, parent, f, t, 1 FROM links
  UNION
  SELECT member, parent, greatest(ways.f, links.f), least(ways.t, links.t), level + 1
  FROM ways JOIN links ON ways.ancestor = links.child
  WHERE member <> parent AND ways.f <= links.t AND links.f <= ways.t AND level < 8),
closure AS (SELECT member, ancestor, f, t, min(level) AS level FROM ways GROUP BY 1, 2, 3, 4)"""
Q["hierarchy_closure"] = f"""
WITH RECURSIVE {LINKS}
SELECT member, ancestor, {text('f')} AS valid_from, {text('t')} AS valid_to, {whole('level')} AS level FROM closure"""

Q["hierarchy_on_day"] = f"""
WITH RECURSIVE {LINKS}
SELECT member, ancestor, {whole('min(level)')} AS level FROM closure WHERE {AS_OF} BETWEEN f AND t GROUP BY 1, 2"""

Q["hierarchy_sales"] = f"""
WITH RECURSIVE {TX}, {LINKS}, r AS (
  SELECT customer_id, transaction_date, ancestor, min(level) AS level FROM
    (SELECT DISTINCT customer_id, transaction_date FROM tx) s JOIN closure ON member = customer_id
   WHERE transaction_date BETWEEN f AND t GROUP BY 1, 2, 3)
SELECT ancestor, {whole('level')} AS level, {num('sum(gross_amount)')} AS total, {whole('count(*)')} AS row_count,
       {whole('count(DISTINCT tx.customer_id)')} AS members
FROM tx JOIN r ON tx.customer_id = r.customer_id AND tx.transaction_date = r.transaction_date GROUP BY 1, 2"""

# what a claim is given: what is asked so far less the largest shortfall so far
FIFO = f"""li AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS customer_id,
         l_linestatus AS product_id, CAST(o_orderdate AS DATE) AS sold_on, CAST(l_shipdate AS DATE) AS claimed_on,
         CAST(l_quantity AS {MONEY}) AS q
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
s AS (SELECT customer_id, product_id, id, sold_on AS day, sum(q) AS q FROM li GROUP BY ALL),
c AS (SELECT customer_id, product_id, 'CB-' || id AS id, claimed_on AS day, sum(q * 1.5) AS q FROM li GROUP BY ALL),
sp AS (SELECT *, sum(q) OVER w - q AS lo, sum(q) OVER w AS hi FROM s WINDOW w AS (PARTITION BY customer_id, product_id ORDER BY day, id)),
held AS (
  SELECT c.*, sum(c.q) OVER w AS asked,
         coalesce((SELECT sum(s.q) FROM s WHERE s.customer_id = c.customer_id AND s.product_id = c.product_id AND s.day <= c.day), 0) AS sold
  FROM c WINDOW w AS (PARTITION BY customer_id, product_id ORDER BY day, id)),
given AS (SELECT *, asked + least(0, min(sold - asked) OVER w) AS upto FROM held
          WINDOW w AS (PARTITION BY customer_id, product_id ORDER BY day, id)),
cp AS (SELECT *, coalesce(lag(upto) OVER (PARTITION BY customer_id, product_id ORDER BY day, id), 0) AS lo, upto AS hi FROM given),
pairs AS (
  SELECT cp.customer_id, cp.product_id, cp.id AS claim_id, sp.id AS transaction_id,
         sum(least(cp.hi, sp.hi) - greatest(cp.lo, sp.lo)) AS allocated
  FROM cp JOIN sp ON cp.customer_id = sp.customer_id AND cp.product_id = sp.product_id AND cp.lo < sp.hi AND sp.lo < cp.hi
  WHERE cp.lo < cp.hi GROUP BY ALL)"""
Q["claims_to_sales"] = f"""
WITH {FIFO}
SELECT customer_id, product_id, claim_id, transaction_id, {num('allocated')} AS allocated FROM pairs"""

Q["claims_allocated"] = f"""
WITH {FIFO}, a AS (SELECT customer_id, product_id, claim_id, sum(allocated) AS g, count(*) AS n FROM pairs GROUP BY ALL),
t AS (SELECT customer_id, product_id, id, sum(q) AS q FROM c GROUP BY ALL)
SELECT t.customer_id, t.product_id, id AS claim_id, {num('q')} AS quantity, {num('coalesce(g, 0)')} AS allocated,
       {whole('coalesce(n, 0)')} AS sales_used, {num('q - coalesce(g, 0)')} AS open_quantity
FROM t LEFT JOIN a ON t.id = claim_id AND t.customer_id = a.customer_id AND t.product_id = a.product_id"""

Q["leakage_model_report"] = f"""
SELECT {whole('count(*)')} AS claims, {whole('count(*)')} AS scored,
       {num(f'sum(CAST(l_extendedprice * l_discount AS {MONEY}))')} AS claim_amount,
       TRUE AS flags_at_most_its_share, TRUE AS flags_are_negative_scores
FROM lineitem"""

# -- through the write paths -------------------------------------------------------

Q["rules_pushed"] = Q["rule_results"]
Q["quarantine_notices"] = f"""
WITH {scored(11)}, env(env, least) AS (VALUES ('dev', 30.0), ('prod', 40.0), ('staging', 40.0), ('strict', 92.0))
SELECT 'quarantine-claims-' || env AS rule_id, FALSE AS passed, {whole('count(*) FILTER (WHERE dq_score < least)')} AS quarantined,
       'below_dq_threshold' AS reason
FROM scored, env GROUP BY env"""
Q["read_formats"] = f"""
WITH f(format) AS (VALUES ('csv'), ('json lines'), ('json array'))
SELECT format, o_orderstatus, {whole('count(*)')} AS row_count, {num(f'sum(CAST(o_totalprice AS {MONEY}))')} AS total,
       {text('min(CAST(o_orderdate AS DATE))')} AS first_day
FROM orders, f GROUP BY 1, 2"""
Q["feature_access"] = f"""
SELECT *, 'customer_behavior' AS domain, '1' AS feature_version FROM ({Q['purchase_velocity']})"""
Q["recorded_runs"] = f"""
SELECT 'price_guess' AS model_name, 'production' AS stage, mae, rmse, r2, 'lineitem' AS training_dataset, 'lines' AS unit
FROM ({Q['regression_metrics']})"""
Q["training_weights"] = f"""
WITH {scored(11)}
SELECT distributor_id, {whole('count(*)')} AS row_count, {num('sum(dq_score / 100.0)')} AS weight FROM scored GROUP BY 1"""
Q["run_correlation"] = f"""
SELECT {whole('count(*)')} AS row_count, {whole('1')} AS runs, TRUE AS is_uuid FROM lineitem"""
