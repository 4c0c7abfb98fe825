"""Claims allocated to the sales they can be for, first in, first out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window as W, functions as F

from verisift.session import scratch_path

#: Type of quantities and running totals; sums are cast back, so no step widens to fewer places.
QUANTITY = "decimal(28,4)"
#: Sales and claims of one key that are swept in one task, at most or about.
CELL_ROWS = 100_000


def _daily_limits(sales: DataFrame, claims: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key and day: what was sold up to the day (``_sold``), what claims had been given before
    it (``_given``) and what sales of earlier days hold (``_sold_before``).

    What claims can have by a day is what they ask for, less the largest shortfall so far. A
    key has no more rows than the calendar has days.
    """
    both = (
        sales.select(*keys, "_day", F.col("_quantity").alias("_s"), F.lit(0).cast(QUANTITY).alias("_c"))
        .unionByName(claims.select(*keys, "_day", F.lit(0).cast(QUANTITY).alias("_s"), F.col("_quantity").alias("_c")))
        .groupBy(*keys, "_day")
        .agg(F.sum("_s").cast(QUANTITY).alias("_s"), F.sum("_c").cast(QUANTITY).alias("_c"))
    )
    so_far = W.partitionBy(*keys).orderBy("_day").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(*keys).orderBy("_day")
    summed = both.withColumns({"_sold": F.sum("_s").over(so_far).cast(QUANTITY), "_asked": F.sum("_c").over(so_far).cast(QUANTITY)})
    short = F.least(F.min((F.col("_sold") - F.col("_asked")).cast(QUANTITY)).over(so_far), F.lit(0).cast(QUANTITY))
    given = summed.withColumn("_after", F.col("_asked") + short)
    return given.select(
        *keys,
        "_day",
        F.col("_sold").cast(QUANTITY).alias("_sold"),
        (F.col("_sold") - F.col("_s")).cast(QUANTITY).alias("_sold_before"),
        F.coalesce(F.lag("_after").over(before).cast(QUANTITY), F.lit(0).cast(QUANTITY)).alias("_given"),
    )


def allocate_claims(
    claims: DataFrame,
    sales: DataFrame,
    keys: Sequence[str] = ("customer_id", "product_id"),
    *,
    claim_id: str = "claim_id",
    claim_day: str = "claim_date",
    claim_quantity: str = "quantity",
    sale_id: str = "transaction_id",
    sale_day: str = "transaction_date",
    sale_quantity: str = "quantity",
) -> DataFrame:
    """The keys, ``claim_id``, ``transaction_id`` and ``allocated``, one row per claim and sale that meet.

    Claims of a key take, in order of day and id, the oldest quantity sold up to their day that
    no claim has taken. What a claim cannot get then stays open (see ``claim_allocation``).
    Quantities are decimals; rows without key, id, day or with no positive quantity take no part;
    rows with equal key, id and day are one, with their total.

    Both sides become intervals of the running total sold, which meet by sorting their ends; no
    pairs are compared. Keys of at most ``CELL_ROWS`` rows are swept each in one task, others in
    cells of their total.
    """
    keys = list(keys)

    def known(df: DataFrame, name: str, day: str, quantity: str) -> DataFrame:
        return df.where(F.col(quantity) > 0).dropna(subset=[*keys, name, day]).select(
            *keys, F.col(name).alias("_id"), F.col(day).alias("_day"), F.col(quantity).cast(QUANTITY).alias("_quantity")
        )

    sold, asked = known(sales, sale_id, sale_day, sale_quantity), known(claims, claim_id, claim_day, claim_quantity)
    names = (claim_id, sale_id)
    if [f.dataType for f in sold.schema] != [f.dataType for f in asked.schema]:
        return _allocated_in_cells(asked, sold, keys, *names)
    # keys of very many rows are few; they are stored
    counts, path = Observation(), scratch_path(claims.sparkSession, "large-keys")
    (
        sold.select(*keys).unionByName(asked.select(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > CELL_ROWS).select(*keys).observe(counts, F.count(F.lit(1)).alias("keys"))
        .write.parquet(path)
    )
    if not counts.get["keys"]:
        return _allocated_by_key(asked, sold, keys, *names)
    large = claims.sparkSession.read.parquet(path)
    rest = [df.join(large, keys, "left_anti") for df in (asked, sold)]
    cut = [df.join(large, keys, "left_semi") for df in (asked, sold)]
    return _allocated_by_key(*rest, keys, *names).unionByName(_allocated_in_cells(*cut, keys, *names))


def _allocated_by_key(asked: DataFrame, sold: DataFrame, keys: Sequence[str], claim_id: str, sale_id: str) -> DataFrame:
    """The allocation of keys that one task can sweep each: their rows are moved once."""
    both = sold.withColumn("_claims", F.lit(False)).unionByName(asked.withColumn("_claims", F.lit(True))).repartition(*keys)
    rows = both.groupBy(*keys, "_claims", "_id", "_day").agg(F.sum("_quantity").cast(QUANTITY).alias("_quantity"))
    none = F.lit(0).cast(QUANTITY)
    order = W.partitionBy(*keys).orderBy("_day", "_claims", "_id")
    so_far, earlier = order.rowsBetween(W.unboundedPreceding, 0), order.rowsBetween(W.unboundedPreceding, -1)
    part = F.when(F.col("_claims"), F.lit(None)).otherwise(F.col("_quantity"))
    wish = F.when(F.col("_claims"), F.col("_quantity"))
    summed = rows.withColumns(
        {
            "_sold": F.coalesce(F.sum(part).over(so_far).cast(QUANTITY), none),
            "_asked": F.coalesce(F.sum(wish).over(so_far).cast(QUANTITY), none),
        }
    )
    # what claims can have is what they ask for, less the largest shortfall before them
    short = F.least(F.coalesce(F.min((F.col("_sold") - F.col("_asked")).cast(QUANTITY)).over(earlier), none), none)
    upto = F.when(F.col("_claims"), F.least((F.col("_asked") + short).cast(QUANTITY), "_sold")).otherwise(F.col("_sold"))
    low = F.when(F.col("_claims"), F.least((F.col("_asked") - F.col("_quantity") + short).cast(QUANTITY), "_sold")).otherwise(
        (F.col("_sold") - F.col("_quantity")).cast(QUANTITY)
    )
    spans = summed.select(*keys, "_claims", "_id", low.alias("_at"), upto.alias("_high")).where("_at < _high")
    sweep = W.partitionBy(*keys).orderBy("_at", "_claims")
    span = F.struct(F.col("_id").alias("id"), F.col("_high").alias("high"))
    filled = spans.select(
        *keys,
        "_at",
        F.last(F.when(~F.col("_claims"), span), ignorenulls=True).over(sweep.rowsBetween(W.unboundedPreceding, 0)).alias("_sale"),
        F.last(F.when(F.col("_claims"), span), ignorenulls=True).over(sweep.rowsBetween(W.unboundedPreceding, 0)).alias("_claim"),
        F.lead("_at").over(sweep).alias("_next"),
    )
    return _met(filled, keys, claim_id, sale_id)


def _met(filled: DataFrame, keys: Sequence[str], claim_id: str, sale_id: str) -> DataFrame:
    """The quantity of each claim and sale that meet, from the ends of their spans."""
    upto = F.least(F.col("_sale.high"), F.col("_claim.high"), "_next")
    return (
        filled.where("_sale IS NOT NULL AND _claim IS NOT NULL")
        .select(*keys, F.col("_claim.id").alias(claim_id), F.col("_sale.id").alias(sale_id), (upto - F.col("_at")).alias("_part"))
        .where("_part > 0")
        .groupBy(*keys, claim_id, sale_id)
        .agg(F.sum("_part").cast(QUANTITY).alias("allocated"))
    )


def _allocated_in_cells(asked: DataFrame, sold: DataFrame, keys: Sequence[str], claim_id: str, sale_id: str) -> DataFrame:
    """The allocation of keys of any size: totals per day come first, then totals inside a day, so no
    window holds more than a day of a key. The spans are cut at cells of the key's total."""

    def folded(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys, "_id", "_day").agg(F.sum("_quantity").cast(QUANTITY).alias("_quantity"))

    sold, asked = folded(sold), folded(asked)
    limits = _daily_limits(sold, asked, keys)
    in_day = W.partitionBy(*keys, "_day").orderBy("_id").rowsBetween(W.unboundedPreceding, 0)
    inside = F.sum("_quantity").over(in_day)
    sale_spans = (
        sold.withColumn("_inside", inside)
        .join(limits, [*keys, "_day"])
        .select(
            *keys,
            "_id",
            (F.col("_sold_before") + F.col("_inside") - F.col("_quantity")).cast(QUANTITY).alias("_low"),
            (F.col("_sold_before") + F.col("_inside")).cast(QUANTITY).alias("_high"),
        )
    )
    claim_spans = (
        asked.withColumn("_inside", inside)
        .join(limits, [*keys, "_day"])
        .select(
            *keys,
            "_id",
            F.least((F.col("_given") + F.col("_inside") - F.col("_quantity")).cast(QUANTITY), "_sold").alias("_low"),
            F.least((F.col("_given") + F.col("_inside")).cast(QUANTITY), "_sold").alias("_high"),
        )
        .where("_low < _high")
    )
    sizes = sale_spans.groupBy(*keys).agg(F.max("_high").alias("_all"), F.count(F.lit(1)).alias("_n"))
    # cells of equal quantity, about as many as the key's rows need
    width = F.greatest(F.ceil(F.col("_all") / F.ceil(F.col("_n") / CELL_ROWS)).cast("long"), F.lit(1).cast("long"))
    cells = sizes.select(*keys, width.alias("_width"))

    def cut(spans: DataFrame, side: str) -> DataFrame:
        placed = spans.join(cells, keys)
        first = F.floor(F.col("_low") / F.col("_width")).cast("long")
        final = (F.ceil(F.col("_high") / F.col("_width")) - 1).cast("long")
        pieces = placed.withColumn("_cell", F.explode(F.sequence(first, F.greatest(first, final))))
        edge, rim = ((c * F.col("_width")).cast(QUANTITY) for c in (F.col("_cell"), F.col("_cell") + 1))
        return pieces.select(
            *keys,
            "_cell",
            F.greatest(F.col("_low"), edge).alias("_at"),
            F.struct(F.col("_id").alias("id"), F.least(F.col("_high"), rim).alias("high")).alias(side),
        )

    ends = cut(sale_spans, "_sale").withColumn("_claim", F.lit(None)).unionByName(
        cut(claim_spans, "_claim").withColumn("_sale", F.lit(None)).select(*keys, "_cell", "_at", "_sale", "_claim")
    )
    ends = ends.groupBy(*keys, "_cell", "_at").agg(F.max("_sale").alias("_sale"), F.max("_claim").alias("_claim"))
    in_cell = W.partitionBy(*keys, "_cell").orderBy("_at")
    filled = ends.select(
        *keys,
        "_at",
        F.last("_sale", ignorenulls=True).over(in_cell).alias("_sale"),
        F.last("_claim", ignorenulls=True).over(in_cell).alias("_claim"),
        F.lead("_at").over(in_cell).alias("_next"),
    )
    return _met(filled, keys, claim_id, sale_id)


def claim_allocation(
    claims: DataFrame, allocated: DataFrame, keys: Sequence[str] = ("customer_id", "product_id"), *, claim_id: str = "claim_id"
) -> DataFrame:
    """Each claim's quantity, what it was given, from how many sales, and what stays open."""
    keys = [*keys, claim_id]
    asked = claims.where("quantity > 0").dropna(subset=keys).groupBy(*keys).agg(
        F.sum(F.col("quantity").cast(QUANTITY)).cast(QUANTITY).alias("quantity")
    )
    given = allocated.groupBy(*keys).agg(F.sum("allocated").alias("allocated"), F.count(F.lit(1)).alias("sales_used"))
    got = F.coalesce(F.col("allocated").cast(QUANTITY), F.lit(0).cast(QUANTITY))
    return asked.join(given, keys, "left").select(
        *keys, "quantity", got.alias("allocated"), F.coalesce("sales_used", F.lit(0)).alias("sales_used"),
        (F.col("quantity") - got).alias("open_quantity"),
    )
