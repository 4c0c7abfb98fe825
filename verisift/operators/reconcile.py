"""Claims against transactions, and attributes as they were on a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def match_claims(chargebacks: DataFrame, tx: DataFrame) -> DataFrame:
    """Every claim with the transaction it refers to.

    A reference id that names several transactions is matched to the earliest day and
    their total. ``match_status`` is matched, unmatched or no_reference.
    """
    sold = (
        tx.where(F.col("transaction_id").isNotNull())
        .groupBy(F.col("transaction_id").alias("transaction_ref_id"))
        .agg(
            F.min("transaction_date").alias("matched_date"),
            F.sum("gross_amount").alias("matched_amount"),
        )
        .withColumn("_hit", F.lit(True))
    )
    status = (
        F.when(F.col("transaction_ref_id").isNull(), "no_reference")
        .when(F.col("_hit"), "matched")
        .otherwise("unmatched")
    )
    return (
        chargebacks.join(sold, "transaction_ref_id", "left")
        .withColumn("match_status", status)
        .select(*chargebacks.columns, "matched_date", "matched_amount", "match_status")
    )


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    *,
    at: str,
    valid_from: str,
    values: Sequence[str],
) -> DataFrame:
    """Each fact with the history values in force on its day.

    Facts are reduced to their distinct (key, day) pairs, merged with the history into
    one timeline per key and filled forward, then joined back. Neither the pairs of
    facts and history nor the facts of one key are gathered.
    """
    from pyspark.sql import Window as W

    state = F.struct(*values)
    changes = history.groupBy(*keys, F.col(valid_from).alias("_at")).agg(
        F.max(state).alias("_state")
    )
    asked = facts.select(*keys, F.col(at).alias("_at")).distinct()
    timeline = changes.withColumn("_asked", F.lit(False)).unionByName(
        asked.withColumns({"_state": F.lit(None), "_asked": F.lit(True)})
    )
    up_to = W.partitionBy(*keys).orderBy("_at", "_asked").rowsBetween(W.unboundedPreceding, 0)
    filled = (
        timeline.withColumn("_now", F.last("_state", ignorenulls=True).over(up_to))
        .where("_asked")
        .select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            "_at",
            *[F.col("_now")[v].alias(v) for v in values],
        )
    )
    condition = F.col(at).eqNullSafe(F.col("_at"))
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return facts.join(filled, condition, "left").select(*facts.columns, *values)
