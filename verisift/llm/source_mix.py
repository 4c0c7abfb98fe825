"""Mixing sources to target weights by systematic sampling.

A document's expected copies are its source's target over its source's size, the same
for all documents of the source. Walking the documents of a source in order of size,
one random offset is added to the running sum of expected copies, and a copy is emitted
at every whole number that the sum crosses. The order by size makes the words taken
follow the target closely, not only the number of documents.

The running sum needs no sort of a whole source. Documents fall into classes of nearly
equal size and into 256 buckets of a hash; counts per (source, class, bucket) are combined
before the shuffle, summed over buckets, then over classes, and give each bucket the rank
it starts at. Only the rank inside a bucket is a window over documents.

Edge cases: a NULL or blank text has size 0 and never adds words; NULL is a source of its
own, last in order; rows with the same ``doc_id`` are documents of their own; an empty
table gives an empty mix; a source of only empty documents has target 0; further columns
are kept. The same input, in any partitioning, gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verisift.llm.lets import require, words_of
from verisift.session import scratch_path

WEIGHTS = (3, 1, 2)
#: Share of all words that the mix takes, as a fraction.
SHARE = (3, 2)
#: No source is used more often than this.
MOST = 2
SEED = "mix-1"


def _size_class(size: Column) -> Column:
    """The first four bits of the size and its magnitude: widths of at most one eighth."""
    shift = F.greatest(F.length(F.bin(size)) - 4, F.lit(0))
    return shift * 16 + F.expr("shiftright(size, greatest(length(bin(size)) - 4, 0))")


def offset_of(source: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the source's name, the one random draw of a source."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("-")))
    return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST
) -> DataFrame:
    """source, source_size -> target. One row per source, so one sorted task is enough.

    A source stops at ``most`` times its size; what it leaves goes to the others by
    weight. The sources that stop are those with the least size per weight: in that order
    a source stops if its share of what is left would be above its limit.
    """
    up, down = share
    order = Window.orderBy(F.col("source").asc_nulls_last())
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("place")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    weighed = (
        totals.withColumn("place", F.row_number().over(order))
        .withColumn("weight", F.get(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("place") - 1) % len(weights)))
        .withColumn("cap", F.lit(most) * F.col("source_size"))
        .withColumn("goal", F.lit(up) * F.sum("source_size").over(whole))
        .withColumn("all_weights", F.sum("weight").over(whole))
    )
    walked = (
        weighed.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.col("all_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        # goal and caps are multiplied by the denominator of the share to stay whole
        .withColumn("left", F.col("goal") - F.lit(down) * F.col("cap_before"))
        .withColumn(
            "stops",
            F.col("cap").cast("double") * down * F.col("weight_left") <= F.col("weight").cast("double") * F.col("left"),
        )
    )
    # the first source that does not stop has the most weight left
    level = walked.withColumn(
        "free", F.max(F.when(~F.col("stops"), F.struct(F.col("weight_left"), F.col("left")))).over(whole)
    )
    return level.select(
        "source",
        "source_size",
        F.when(F.col("stops"), F.col("cap").cast("double"))
        .otherwise((F.col("weight") * F.col("free.left")).cast("double") / (F.lit(down) * F.col("free.weight_left")).cast("double"))
        .alias("target"),
    )


def _tagged(docs: DataFrame, *carried: Column) -> DataFrame:
    """size, class and the hash order of each row, next to the carried columns."""
    require(docs, "doc_id", "text", "source")
    text = F.col("text")
    key = F.md5(F.concat_ws("/", F.col("doc_id").cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    sized = docs.select(*carried, F.col("source"), F.size(words_of(text)).cast("long").alias("size"), key.alias("at"))
    return sized.withColumn("class", _size_class(F.col("size"))).withColumn("bucket", F.substring("at", 1, 2))


def _with_copies(
    rows: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int, seed: str
) -> DataFrame:
    """source_size, target and copies for rows from ``_tagged``."""
    groups = rows.groupBy("source", "class", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    goals = targets(groups.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    of_source, of_class = Window.partitionBy("source"), Window.partitionBy("source", "class")
    class_start = groups.groupBy("source", "class").agg(F.sum("n").alias("n")).select(
        "source", "class", (F.sum("n").over(of_source.orderBy("class")) - F.col("n")).alias("class_start")
    )
    bucket_start = groups.select(
        "source", "class", "bucket", (F.sum("n").over(of_class.orderBy("bucket")) - F.col("n")).alias("bucket_start")
    )

    def same(*names: str) -> list[Column]:
        return [F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}")) for n in names]

    starts = (
        bucket_start.alias("l")
        .join(class_start.alias("r"), same("source", "class"))
        .select("l.source", "l.class", "l.bucket", (F.col("bucket_start") + F.col("class_start")).alias("start"))
        .alias("l")
        .join(goals.alias("r"), same("source"))
        .select("l.source", "l.class", "l.bucket", "start", "source_size", "target")
    )
    inside = Window.partitionBy("source", "class", "bucket").orderBy("at")
    ranked = rows.withColumn("rank", F.row_number().over(inside))
    met = ranked.alias("l").join(starts.alias("r"), same("source", "class", "bucket"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place, shift = F.col("start") + F.col("rank"), offset_of(F.col("l.source"), seed)
    copies = F.floor(place * rate + shift) - F.floor((place - 1) * rate + shift)
    return met.select("l.*", "source_size", "target", copies.cast("long").alias("copies"))


def plan(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target and ``copies`` of every document."""
    # the texts are read once; everything after this works on a few numbers per document
    path = scratch_path(docs.sparkSession, "mix-sizes")
    _tagged(docs, F.col("doc_id")).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    return _with_copies(rows, weights, share, most, seed).select(
        "doc_id", "source", "size", "source_size", "target", "copies"
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """The documents of the mix: each row as often as the plan says, columns unchanged."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    chosen = _with_copies(_tagged(docs, whole), weights, share, most, seed).filter("copies > 0")
    return chosen.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
