"""Attributes of products and customers on transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _with_attribute(df: DataFrame, lookup: DataFrame, key: str, attribute: str) -> DataFrame:
    # one row per key, so that a repeated key never multiplies rows
    found = (
        lookup.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_lookup"))
        .agg(F.min(attribute).alias(attribute))
    )
    return df.drop(attribute).join(found, F.col(key) == F.col("_lookup"), "left").drop("_lookup")


def enrich(
    tx: DataFrame, *, products: DataFrame | None = None, customers: DataFrame | None = None
) -> DataFrame:
    """Add ``product_category`` and ``customer_segment``, or replace them.

    ``products`` holds ``product_id, product_category``, ``customers`` holds
    ``customer_id, customer_segment``; without a frame its column is left as it is. Every
    transaction stays: a key that is NULL or not found has a NULL attribute, and of several
    attributes of one key the smallest is taken. Which side is sent where is left to the
    size check and the skew handling of Spark.
    """
    if products is not None:
        tx = _with_attribute(tx, products, "product_id", "product_category")
    if customers is not None:
        tx = _with_attribute(tx, customers, "customer_id", "customer_segment")
    return tx
