"""Seasonal and market features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from verisift.functions.exprs import ratio

# The months of the spring and autumn vaccination seasons.
VACCINE_MONTHS = (3, 4, 5, 9, 10, 11)


def _index_by(tx: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """Average sale per month of the year over the plain mean of those averages.

    The window sees at most 13 rows per group.
    """
    monthly = tx.groupBy(*groups, F.month("transaction_date").alias("month")).agg(
        F.sum("gross_amount").alias("_sum"), F.count("gross_amount").alias("_n")
    )
    averaged = monthly.select(
        *groups, "month", ratio(F.col("_sum"), F.col("_n")).alias("avg_monthly_sales")
    )
    overall = F.avg("avg_monthly_sales").over(W.partitionBy(*groups))
    base = F.coalesce(F.nullif(overall, F.lit(0.0)), F.lit(1.0))
    return averaged.withColumn(name, F.col("avg_monthly_sales") / base)


def seasonal_index(tx: DataFrame, product_category: str = "parasiticide") -> DataFrame:
    """Seasonal index of one category, named after it."""
    wanted = tx.where(F.col("product_category") == product_category)
    return _index_by(wanted, [], f"{product_category}_seasonal_index")


def seasonal_indices(tx: DataFrame, groups: Sequence[str] = ("product_category",)) -> DataFrame:
    """Seasonal index within every group; with a region among the groups the regional cycle."""
    return _index_by(tx, list(groups), "seasonal_index")


def yoy_growth(tx: DataFrame) -> DataFrame:
    """Yearly sales by customer and product with the growth over the year before.

    The growth needs positive sales in the directly preceding year.
    """
    yearly = tx.groupBy(
        "customer_id", "product_id", F.year("transaction_date").alias("year")
    ).agg(F.sum("gross_amount").alias("annual_sales"))
    by_year = W.partitionBy("customer_id", "product_id").orderBy("year")
    adjacent = F.lag("year").over(by_year) == F.col("year") - 1
    previous = F.when(adjacent, F.lag("annual_sales").over(by_year))
    change = ratio(F.col("annual_sales") - F.col("prev_year_sales"), F.col("prev_year_sales"))
    return yearly.withColumn("prev_year_sales", previous).withColumn(
        "yoy_growth_rate", F.when(F.col("prev_year_sales") > 0, change)
    )


def with_vaccine_season(df: DataFrame, date_column: str) -> DataFrame:
    """Add ``is_vaccine_season``."""
    return df.withColumn("is_vaccine_season", F.month(date_column).isin(*VACCINE_MONTHS))
