"""First rows and numbered rows that stay spread out when one key or row holds most of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from verisift.session import scratch_path

COPIES_PER_TASK = 1_000_000
#: Share of the rows in repeated keys from which all rows are compared.
REPEATED_SHARE = 0.25


def mark_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_first``: true on exactly one row per key, the lowest by ``order``.

    Ties are broken by a hash of the whole row; NULL keys form a key of their own. Rows whose
    key no other row has, by counts of key hashes that are stored, are first as they are and
    not moved; only the rest is compared.
    """
    named = df.withColumn("_key", F.xxhash64(*keys))
    counts, path = Observation(), scratch_path(df.sparkSession, "repeated")
    (
        named.groupBy("_key")
        .agg(F.count(F.lit(1)).alias("_n"))
        .observe(counts, F.sum("_n").alias("rows"), F.sum(F.when(F.col("_n") > 1, F.col("_n"))).alias("repeated"))
        .where("_n > 1")
        .select("_key")
        .write.parquet(path)
    )
    found = counts.get
    if (found["repeated"] or 0) > REPEATED_SHARE * (found["rows"] or 0):
        return _mark_compared(df, keys, order)
    repeated = df.sparkSession.read.parquet(path)
    alone = named.join(repeated, "_key", "left_anti").select(*df.columns, F.lit(True).alias("_first"))
    shared = named.join(repeated, "_key", "left_semi").select(*df.columns)
    return alone.unionByName(_mark_compared(shared, keys, order))


def _mark_compared(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``mark_first`` by comparing all rows.

    Identical rows are folded to one row with a count before and unfolded after. The lowest
    row of a key is a minimum, combined before its shuffle, and finds its row by key and
    hash: no row is sorted, and the rows of one key are dealt by their hashes, whatever its
    size. A retried task puts every row where it was.
    """
    columns = df.columns
    folded = (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumns({"_print": F.xxhash64(*columns), "_check": F.hash(*columns)})
    )
    place = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], "_print", "_check")
    heads = folded.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(place).alias("_least"))
    heads = heads.select(
        *[f"_k{i}" for i in range(len(keys))],
        F.col("_least._print").alias("_head"),
        F.col("_least._check").alias("_head_check"),
    )
    same = (F.col("_print") == F.col("_head")) & (F.col("_check") == F.col("_head_check"))
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_k{i}"))
    chunks = F.sequence(F.lit(0), (F.col("_copies") - 1).try_cast("long"), F.lit(COPIES_PER_TASK))
    copy_numbers = F.sequence(
        F.col("_from"),
        F.least(F.col("_copies"), F.col("_from") + F.lit(COPIES_PER_TASK)) - 1,
    )
    met = folded.join(heads, same, "left").withColumn("_first", F.col("_head").isNotNull())
    # only rows of very many copies are dealt out again
    few = met.where(F.col("_copies") <= COPIES_PER_TASK).withColumn("_from", F.lit(0).cast("long"))
    many = (
        met.where(F.col("_copies") > COPIES_PER_TASK)
        .withColumn("_from", F.explode(chunks))
        .repartition(*[F.col(c) for c in ("_print", "_from")])
    )
    return (
        few.unionByName(many)
        .withColumn("_copy", F.explode(copy_numbers))
        .select(*columns, (F.col("_first") & (F.col("_copy") == 0)).alias("_first"))
    )


def numbered_copies(df: DataFrame, name: str, parts: int) -> DataFrame:
    """The rows in ``parts`` partitions, equal ones numbered from 0 in the column ``name``.

    Equal rows are folded to their number and unfolded in chunks, so a row that stands for
    a large share of the table is dealt out like any other.
    """
    folded = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    chunks = F.sequence(F.lit(0), (F.col("_copies") - 1).try_cast("long"), F.lit(COPIES_PER_TASK))
    upto = F.least(F.col("_copies"), F.col("_from") + F.lit(COPIES_PER_TASK)) - 1
    return (
        folded.withColumn("_from", F.explode(chunks))
        .repartition(parts, *[F.col(c) for c in (*df.columns, "_from")])
        .select(*df.columns, F.explode(F.sequence(F.col("_from"), upto)).alias(name))
    )
