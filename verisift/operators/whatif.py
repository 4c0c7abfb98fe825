"""Contract what-if: tiered discounts and rebates over historical sales.

Every row at or above a threshold pays that tier's percentage, so tiers stack. Sales
are reduced once to totals per segment and tier level; all scenarios are then priced
on those few totals, so the cost over the sales does not depend on their number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import zip_longest

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import DecimalType

from verisift.functions.exprs import ratio

# Fixed value: share of gross sales assumed to remain today.
BASELINE_NET_SHARE = 0.85

# Wide enough for thresholds and percentages as they are written; products stay exact.
THRESHOLD, PERCENT = "DECIMAL(28,10)", "DECIMAL(10,8)"
TIERS = "ARRAY<STRUCT<threshold: {0}, discount_pct: {1}, rebate_pct: {1}>>"
COMPARISON = (
    "scenario",
    "gross_revenue",
    "net_revenue",
    "gross_to_net_spread",
    "net_price_change_pct",
)


# The field names of a scenario.
@dataclass(frozen=True)
class Scenario:
    name: str
    customer_segment: str
    tier_thresholds: Sequence[float]
    discount_pcts: Sequence[float]
    rebate_pcts: Sequence[float]
    effective_months: int = 12


def _fitting(value: float, places: int, limit: float) -> float:
    """The value, if its decimal type keeps it but for the noise of doubles."""
    number = float(value or 0)
    if not abs(number) < limit or abs(round(number, places) - number) > 1e-12 * max(1.0, abs(number)):
        raise ValueError(f"{value} has more than {places} places or is {limit:g} or more")
    return number


def scenario_frame(spark: SparkSession, scenarios: Sequence[Scenario]) -> DataFrame:
    """Scenarios as rows; a threshold without a discount or rebate of its own pays 0 there.

    Thresholds have 10 places and percentages 8; a value that does not fit is an error.
    """
    rows = []
    for position, s in enumerate(scenarios):
        tiers = [
            (_fitting(t, 10, 1e18), _fitting(d, 8, 100), _fitting(r, 8, 100))
            for t, d, r in zip_longest(s.tier_thresholds, s.discount_pcts, s.rebate_pcts)
            if t is not None
        ]
        rows.append((position, s.name, s.customer_segment, tiers))
    schema = "position INT, scenario STRING, customer_segment STRING, tiers " + TIERS.format("DOUBLE", "DOUBLE")
    exact = F.col("tiers").cast(TIERS.format(THRESHOLD, PERCENT))
    return spark.createDataFrame(rows, schema).withColumn("tiers", exact)


def simulate(sales: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Gross, discount, rebate, net and spread of every scenario; absent segments give 0.

    ``sales`` holds ``customer_segment`` and ``gross_amount``; ``scenarios`` is a frame as
    made by ``scenario_frame``.
    """
    nothing = F.struct(
        F.lit(None).cast(THRESHOLD).alias("threshold"),
        F.lit(0).cast(PERCENT).alias("discount_pct"),
        F.lit(0).cast(PERCENT).alias("rebate_pct"),
    )
    # Tier 0 is every sale of the segment; it carries the gross revenue.
    tiers = scenarios.select(
        "position",
        "scenario",
        "customer_segment",
        F.inline(F.concat(F.array(nothing), F.col("tiers"))),
    )
    # One row per segment named in the scenarios, however many sales there are.
    cuts = tiers.groupBy("customer_segment").agg(
        F.sort_array(F.collect_set("threshold")).alias("_cuts")
    )
    reached = F.size(F.filter("_cuts", lambda cut: cut <= F.col("gross_amount")))
    totals = (
        sales.select("customer_segment", "gross_amount")
        .join(cuts, "customer_segment")
        .groupBy("customer_segment", reached.alias("_level"))
        .agg(F.sum("gross_amount").alias("_gross"))
    )
    at_least = (
        totals.select(
            "customer_segment", "_gross", F.explode(F.sequence(F.lit(0), "_level")).alias("_tier")
        )
        .groupBy("customer_segment", "_tier")
        .agg(F.sum("_gross").alias("_gross"))
    )
    if isinstance(sales.schema["gross_amount"].dataType, DecimalType):
        # 27 and 10 digits: a product of 38 keeps all its decimals
        scale = sales.schema["gross_amount"].dataType.scale
        at_least = at_least.withColumn("_gross", F.col("_gross").cast(DecimalType(27, scale)))
    tier = F.coalesce(F.array_position("_cuts", F.col("threshold")), F.lit(0)).cast("int")

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0)).cast("double")

    spread = F.col("total_discount") + F.col("total_rebate")
    today = F.col("gross_revenue") * BASELINE_NET_SHARE
    change = F.coalesce(ratio(F.col("net_revenue") - today, today), F.lit(0.0))
    return (
        tiers.join(cuts, "customer_segment")
        .withColumn("_tier", tier)
        .join(at_least, ["customer_segment", "_tier"], "left")
        .groupBy("position", "scenario", F.col("customer_segment").alias("segment"))
        .agg(
            total(F.when(F.col("_tier") == 0, F.col("_gross"))).alias("gross_revenue"),
            total(F.col("_gross") * F.col("discount_pct")).alias("total_discount"),
            total(F.col("_gross") * F.col("rebate_pct")).alias("total_rebate"),
        )
        .withColumn("net_revenue", F.col("gross_revenue") - spread)
        .withColumn("gross_to_net_spread", F.col("gross_revenue") - F.col("net_revenue"))
        .withColumn("net_price_change_pct", change)
    )


def compare_scenarios(sales: DataFrame, scenarios: DataFrame) -> DataFrame:
    """One row per scenario, in the order of the list."""
    return simulate(sales, scenarios).orderBy("position").select(*COMPARISON)


def scenario_impact(comparison: DataFrame, baseline: str) -> DataFrame:
    """Differences of every scenario to the baseline scenario, which must exist once.

    The window spans the comparison, one row per scenario.
    """
    everything = W.partitionBy()
    is_base = F.col("scenario") == baseline

    def of_base(column: str):
        return F.max(F.when(is_base, F.col(column))).over(everything)

    missing = F.raise_error(F.lit(f"baseline {baseline!r} must exist exactly once"))
    known = F.count_if(is_base).over(everything) == 1
    net = F.when(known, of_base("net_revenue")).otherwise(missing.cast("double"))
    delta = F.col("net_revenue") - F.col("_net")
    return (
        comparison.withColumns({"_net": net, "_spread": of_base("gross_to_net_spread")})
        .withColumns(
            {
                "net_revenue_delta": delta,
                "gross_to_net_spread_delta": F.col("gross_to_net_spread") - F.col("_spread"),
                "net_revenue_pct_change": F.coalesce(ratio(delta, F.col("_net")), F.lit(0.0)),
            }
        )
        .drop("_net", "_spread")
    )
