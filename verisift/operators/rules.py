"""Expectation suites compiled to aggregates, and catalog rules joined to measured rates."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from verisift.sources.layout import Layout

RESULT_COLUMNS = ("position", "expectation", "column", "dimension", "observed", "passed")

# The two suites shipped with the engine.
TRANSACTION_SUITE = [
    {"type": "expect_column_to_exist", "kwargs": {"column": "transaction_id"}, "dimension": "validity"},
    {"type": "expect_column_values_to_not_be_null", "kwargs": {"column": "transaction_id"}, "dimension": "completeness"},
    {"type": "expect_column_values_to_be_unique", "kwargs": {"column": "transaction_id"}, "dimension": "uniqueness"},
    {"type": "expect_column_values_to_not_be_null", "kwargs": {"column": "customer_id"}, "dimension": "completeness"},
    {"type": "expect_column_values_to_not_be_null", "kwargs": {"column": "product_id"}, "dimension": "completeness"},
    {"type": "expect_column_values_to_be_between", "kwargs": {"column": "gross_amount", "min_value": 0}, "dimension": "accuracy"},
    {"type": "expect_column_values_to_be_between", "kwargs": {"column": "quantity", "min_value": 1}, "dimension": "accuracy"},
    {"type": "expect_column_values_to_not_be_null", "kwargs": {"column": "transaction_date"}, "dimension": "completeness"},
]
FEATURE_SUITE = [
    {"type": "expect_column_values_to_not_be_null", "kwargs": {"column": "customer_id"}, "dimension": "completeness"},
    {"type": "expect_column_values_to_be_unique", "kwargs": {"column": "customer_id"}, "dimension": "uniqueness"},
    {"type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1}, "dimension": "completeness"},
]
SUITES = {"transaction": TRANSACTION_SUITE, "features": FEATURE_SUITE}


def load_suite(path: str) -> list[dict]:
    """Read a JSON suite ``{"expectations": [{"expectation_type", "kwargs", "meta"}]}``."""
    with open(path, encoding="utf-8") as handle:
        document = json.load(handle)
    return [
        {
            "type": rule["expectation_type"],
            "kwargs": rule.get("kwargs", {}),
            "dimension": rule.get("meta", {}).get("dimension"),
        }
        for rule in document["expectations"]
    ]


def _outside(value: Column, kwargs: Mapping) -> Column:
    low, high = kwargs.get("min_value"), kwargs.get("max_value")
    broken = F.lit(False)
    if low is not None:
        broken = broken | (value < low)
    if high is not None:
        broken = broken | (value > high)
    return broken


def run_suite(df: DataFrame, suite: Sequence[Mapping]) -> DataFrame:
    """One result row per expectation; ``observed`` counts broken rows (or all rows).

    All row-wise expectations share one aggregate over the data. Uniqueness needs one
    grouped count per column. Expecting an absent column fails without a job.
    """
    columns = set(df.columns)
    row_wise: list[Column] = []
    unique: dict[str, DataFrame] = {}
    rows: list[Column] = []
    for i, rule in enumerate(suite):
        kind, kwargs = rule["type"], rule["kwargs"]
        name = kwargs.get("column")
        cell = f"_o{i}"
        observed: Column = F.col(cell)
        passed: Column = observed == 0
        if kind == "expect_column_to_exist" or (name is not None and name not in columns):
            observed = F.lit(0 if name in columns else 1).cast("long")
            passed = observed == 0
        elif kind == "expect_column_values_to_not_be_null":
            row_wise.append(F.count_if(F.col(name).isNull()).alias(cell))
        elif kind == "expect_column_values_to_be_between":
            row_wise.append(F.count_if(_outside(F.col(name), kwargs)).alias(cell))
        elif kind == "expect_table_row_count_to_be_between":
            row_wise.append(F.count(F.lit(1)).alias(cell))
            passed = ~_outside(F.col(cell), kwargs)
        elif kind == "expect_column_values_to_be_unique":
            unique[cell] = _repeated_rows(df, name)
        else:
            raise ValueError(f"unknown expectation {kind!r}")
        rows.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(kind).alias("expectation"),
                F.lit(name).cast("string").alias("column"),
                F.lit(rule.get("dimension")).cast("string").alias("dimension"),
                observed.alias("observed"),
                passed.alias("passed"),
            )
        )
    summary = df.agg(*row_wise) if row_wise else df.sparkSession.range(1)
    summary = summary.withColumns({cell: counted.scalar() for cell, counted in unique.items()})
    return summary.select(F.inline(F.array(*rows)))


def _repeated_rows(df: DataFrame, name: str) -> DataFrame:
    """Rows whose filled value occurs more than once, as a one-row frame."""
    counts = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    repeated = F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0))
    return counts.agg(F.coalesce(repeated, F.lit(0)).cast("long").alias("_repeated"))


def apply_rules(rules: DataFrame, metrics: DataFrame) -> DataFrame:
    """Compare catalog rules ``id, name, threshold`` with measured rates of the same name.

    ``name`` is ``check`` or ``check:column``. A rule without a metric has not passed.
    """
    names = F.array("check", F.concat_ws(":", "check", "column"))
    named = metrics.withColumn("name", F.explode(names))
    return rules.join(named, "name", "left").select(
        F.col("id").alias("rule_id"),
        F.coalesce(F.col("rate") >= F.col("threshold"), F.lit(False)).alias("passed"),
        F.struct("name", "check", "column", "rate", "threshold").alias("details"),
    )


def push_results(results: DataFrame, layout: Layout) -> None:
    """Append rule results to the results table, details as JSON."""
    (
        results.select(
            "rule_id",
            "passed",
            F.to_json("details").alias("details"),
            F.current_timestamp().alias("pushed_at"),
        )
        .write.mode("append")
        .parquet(layout.catalog("dq_results"))
    )
