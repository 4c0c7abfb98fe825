"""Near-duplicate texts across all blocks: locality-sensitive hashing with exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from verisift.session import scratch_path

#: Words of a shingle, and the similarity of two sets of shingles that counts as a copy.
WIDTH, NUM, DEN = 5, 4, 5
#: A pair at the similarity of 0.8 shares none of the buckets with a chance of 4e-7.
BANDS, ROWS = 28, 4
#: Sets of a bucket that are all compared, for each one picked, and how the picks grow by round.
TOGETHER, GROWTH = 8, 16
_PIECE = 1 << 14
_CLASS = ["set_a", "set_b"]
_ORDER = ["first", "set_a", "set_b"]


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _runs(text: Column, width: int = WIDTH) -> Column:
    """The hashes of the runs of ``width`` words, with repeats; of all words if there are fewer.

    A-Z count as a-z; blank, and tab to carriage return, are between words.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.translate(F.coalesce(text, F.lit("")), upper + "\t\n\x0b\x0c\r", upper.lower() + " " * 5)
    words = F.transform(F.array_remove(F.split(plain, " "), ""), lambda w: F.xxhash64(w))

    def runs(hashes: Column) -> Column:
        last = F.size(hashes) - width
        many = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]))
        few = F.when(F.size(hashes) > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<long>"))
        return F.when(last >= 0, many).otherwise(few)

    # the words are hashed once for all their runs
    return F.get(F.transform(F.array(words), runs), F.lit(0))


def _mixed(x: np.ndarray, turn: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(turn))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bucket_keys(members: np.ndarray) -> np.ndarray:
    """The values of the bands: one hash of the least of each of ``ROWS`` permutations."""
    rng = np.random.default_rng(20_170_529)
    factor = rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
    shift = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
    weights = rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(members), _PIECE):
        x = members[at : at + _PIECE, None] * factor + shift
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        least = np.minimum(least, (x ^ (x >> np.uint64(32))).min(axis=0))
    return (least.reshape(BANDS, ROWS) * weights).sum(axis=1, dtype=np.uint64).view(np.int64)


def _described(records: DataFrame, whole: bool) -> DataFrame:
    """Replaces ``runs`` by the print of their set, its size, and the set itself if ``whole``,
    else its bucket keys. Records without words are dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column(batch.num_columns - 1)
            flat, edges = runs.values.to_numpy(zero_copy_only=False).view(np.uint64), runs.offsets.to_numpy()
            some = np.flatnonzero(np.diff(edges) > 0)
            sets = [np.unique(flat[edges[i] : edges[i + 1]]) for i in some]
            prints = [[_mixed(s, turn).sum(dtype=np.uint64) for s in sets] for turn in (30, 33)]
            lists = [s.view(np.int64) if whole else _bucket_keys(s) for s in sets]
            kept = batch.take(pa.array(some))
            offsets = np.cumsum([0, *map(len, lists)], dtype=np.int32)
            values = np.concatenate([np.zeros(0, np.int64), *lists])
            yield pa.RecordBatch.from_arrays(
                [
                    *kept.columns[:-1],
                    *[pa.array(np.array(p, np.uint64).view(np.int64)) for p in prints],
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ],
                names=[*batch.schema.names[:-1], *_CLASS, "n", "list"],
            )

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in records.schema.fields[:-1])
    return records.mapInArrow(run, f"{kept}, set_a long, set_b long, n int, list array<long>")


def _members(classes: DataFrame) -> DataFrame:
    """Buckets of two sets and more: bucket, m (its sets), and each set's order and size."""
    # a set goes by its number here; what else is known of it joins those that share a bucket
    each = classes.select("id", F.posexplode("list").alias("band", "key")).select("id", F.xxhash64("band", "key").alias("bucket"))
    sizes = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    shared = each.join(sizes, "bucket")
    return _saved(shared.join(classes.select("id", *_ORDER, "n"), "id").select("bucket", "m", *_ORDER, "n"), "text-members")


def _candidates(open_sets: DataFrame, hubs: DataFrame) -> DataFrame:
    """Open sets with the earlier sets of their buckets whose size allows the similarity."""
    x, h = open_sets.alias("x"), hubs.alias("h")
    earlier = F.struct(*[f"h.{c}" for c in _ORDER]) < F.struct(*[f"x.{c}" for c in _ORDER])
    sizes = DEN * F.least("x.n", "h.n") >= NUM * F.greatest("x.n", "h.n")
    return x.join(h, "bucket").where(earlier & sizes).select(
        *[F.col(f"x.{c}") for c in _CLASS], *[F.col(f"h.{c}").alias(f"hub_{c}") for c in _CLASS], F.col("h.first").alias("hub_first")
    )


def _sets(members: DataFrame, known: DataFrame) -> DataFrame:
    """The whole sets that share a bucket with another; only their first texts are read again."""
    shared = members.select(*_CLASS, "first").distinct()
    texts = known.join(shared.select(F.col("first").alias("id")).distinct(), "id", "left_semi")
    asked = _described(texts.select("id", _runs(F.col("text")).alias("runs")), True)
    held = asked.join(shared.select(*_CLASS), _CLASS, "left_semi").dropDuplicates(_CLASS)
    return _saved(held.select(*_CLASS, "n", F.col("list").alias("set")), "text-sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Per open set the earliest of its hubs that is similar, by the whole sets."""
    hub = sets.toDF("hub_set_a", "hub_set_b", "hub_n", "hub_set")
    both = pairs.join(sets, _CLASS).join(hub, ["hub_set_a", "hub_set_b"])
    shared = F.size(F.array_intersect("set", "hub_set"))
    similar = (DEN + NUM) * shared >= NUM * (F.col("n") + F.col("hub_n"))
    found = F.min(F.struct("hub_first", (shared / (F.col("n") + F.col("hub_n") - shared)).alias("similarity")))
    return both.where(similar).groupBy(*_CLASS).agg(found.alias("like"))


def _settled(classes: DataFrame, known: DataFrame) -> DataFrame:
    """Sets with an earlier similar one.

    One such set settles a set, so no pairs are listed within a large bucket: small buckets
    are compared whole, of the others the earliest set of each of some parts, and the next
    round, for sets still open, compares sixteen times as many.
    """
    members, each, done = _members(classes), 1, None
    sets = _sets(members, known)
    while True:
        left = members if done is None else members.join(done.select(*_CLASS), _CLASS, "left_anti")
        few, many = F.col("m") <= TOGETHER * each, F.col("m") > TOGETHER * each
        part = F.pmod(F.xxhash64(*_CLASS), F.lit(each))
        hubs = members.where(many).groupBy("bucket", part.alias("part")).agg(F.min(F.struct(*_ORDER, "n")).alias("h"))
        hubs = hubs.select("bucket", "h.*")
        found = _candidates(left.where(few), members.where(few)).unionByName(_candidates(left.where(many), hubs))
        pairs = _saved(found.distinct(), "text-pairs")
        settled = _saved(_verified(pairs, sets), "text-settled")
        done = settled if done is None else done.unionByName(settled)
        members = members.where(many)
        if members.isEmpty():
            return done
        each *= GROWTH


def with_text_duplicates(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Add whether an earlier record, by id, has an equal or similar text.

    Texts are sets of runs of five words, similar from a Jaccard similarity of 0.8. Added are
    ``feat_text_copies`` (other records with an equal set), ``feat_text_duplicate``, and for
    similar texts ``feat_similar_to``, the id of an earlier record, with
    ``feat_text_similarity``; for copies the first record and 1. Equal sets fold to one;
    buckets of MinHash values name the sets to compare, and every reported similarity is exact.
    What is kept of a text is its print, its size and its buckets, and its set if it shares a bucket.

    A text without words and a record without an id match nothing.
    """
    text = F.col(text_column)
    known = df.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.xxhash64(text).alias("text_a"), F.hash(text).alias("text_b"), text.alias("text")
    )
    records = known.select("id", "text_a", "text_b", _runs(F.col("text")).alias("runs"))
    named = _saved(_described(records, False), "text-named")
    least = F.min(F.struct("id", "n", "list")).alias("least")
    folded = named.groupBy(*_CLASS).agg(least, F.count(F.lit(1)).alias("copies"))
    classes = _saved(folded.select(F.monotonically_increasing_id().alias("id"), *_CLASS, F.col("least.id").alias("first"), "least.n", "least.list", "copies"), "text-classes")
    like = classes.select(*_ORDER, "copies").join(_settled(classes, known), _CLASS, "left")
    # equal texts under one id have one row here
    found = named.select("id", "text_a", "text_b", *_CLASS).distinct().join(like, _CLASS).select(
        *[F.col(c).alias(f"_{c}") for c in ("id", "text_a", "text_b")],
        F.col("first").alias("_first"),
        F.col("copies").alias("_copies"),
        F.col("like.hub_first").alias("_like"),
        F.col("like.similarity").alias("_similarity"),
    )
    # the prints are columns before the join, so a text that the caller drops is not moved for it
    printed = df.withColumns({"_own_a": F.xxhash64(text), "_own_b": F.hash(text)})
    same = (F.col(id_column) == F.col("_id")) & (F.col("_own_a") == F.col("_text_a")) & (F.col("_own_b") == F.col("_text_b"))
    met = printed.join(found, same, "left")
    copied = F.col(id_column) > F.col("_first")
    return met.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.coalesce(F.col("_copies") - 1, F.lit(0)).alias("feat_text_copies"),
        F.coalesce(copied | F.col("_like").isNotNull(), F.lit(False)).alias("feat_text_duplicate"),
        F.when(copied, F.col("_first")).otherwise(F.col("_like")).alias("feat_similar_to"),
        F.when(copied, F.lit(1.0)).otherwise(F.col("_similarity")).alias("feat_text_similarity"),
    )
