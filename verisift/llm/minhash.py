"""Near-duplicate documents by circulant MinHash.

Two permutations make every coordinate: the first places the shingles of a document among
2**22 slots; the second gives the slots ranks, and coordinate k reads it shifted by k. So
the signature is the least rank along the k-th neighbours of a document's slots. Bands of
four coordinates give candidate buckets; the number of bands follows from the threshold
and the stated chance to miss a pair.

Links are confirmed on whole sets. Equal sets fold to one class first, named by size and
128-bit print; a component takes its smallest ``doc_id`` only at the end. Inside a
bucket no pairs are listed: a few hubs are compared with the other members, then leave the
bucket; a bucket is finished when all that is left of it belongs to one component already.
Buckets where false candidates meet take more rounds, with sixteen times the hubs each time,
so every pair that could join two components is compared. Sizes and parity bits come before
the whole sets: two sets differ in at least as many shingles as their 512 parity bits do, so
pairs that differ in more than the threshold allows are never listed, and no link is lost.

Edge cases: without words a document has no shingles and is linked with nothing; with fewer
words than a shingle the whole sequence is one; a NULL ``doc_id`` gets no component and is
kept; rows with the same ``doc_id`` share a component and are all kept or not; an empty
table gives an empty table; further columns are ignored by ``components_of`` and kept by
``deduplicate``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verisift.llm.graph import connect
from verisift.llm.lets import free_name, require
from verisift.llm.word_hash import mixed, runs_of, word_hashes
from verisift.session import stored

SLOT_BITS = 22
ROWS_PER_BAND = 4
MISS = 1e-8
PARITY_WORDS = 8
#: Pairs of one hub that are confirmed together; a hub with more is dealt over several tasks.
PAIRS_TOGETHER = 64
#: Documents to confirm are looked up by broadcast up to this number, by a shuffle beyond it.
MOST_BROADCAST = 1_000_000
#: What names a class of equal sets.
SAME = ["n_shingles", "print_a", "print_b"]
_RANKS: dict[int, np.ndarray] = {}


def bands_for(threshold: float, miss: float = MISS) -> int:
    """Bands after which a pair at the threshold is missed with a chance below ``miss``."""
    return math.ceil(math.log(miss) / math.log1p(-(threshold**ROWS_PER_BAND)))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = word_hashes(text, lower=True)
    if not len(words):
        return words
    return np.unique(runs_of(words, min(width, len(words))) + np.uint64(min(width, len(words))))


def _ranks(width: int) -> np.ndarray:
    """Windows over the second permutation, continued around its end."""
    if width not in _RANKS:
        order = np.random.default_rng(7_919).permutation(1 << SLOT_BITS).astype(np.int32)
        _RANKS[width] = np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[: width - 1]]), width)
    return _RANKS[width]


def band_keys(shingles: np.ndarray, bands: int) -> np.ndarray:
    """The bucket of a non-empty set in each band, as signed 64-bit numbers."""
    width = bands * ROWS_PER_BAND
    view = _ranks(width)
    slots = (mixed(shingles * np.uint64(0xA24BAED4963EE407)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    least = np.full(width, np.iinfo(np.int32).max, np.int32)
    for at in range(0, len(slots), 1024):
        np.minimum(least, view[slots[at : at + 1024]].min(axis=0), out=least)
    rows = least.astype(np.uint64).reshape(bands, ROWS_PER_BAND)
    keys = np.arange(bands, dtype=np.uint64)
    for column in range(ROWS_PER_BAND):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, column])
    return keys.view(np.int64)


def parity(shingles: np.ndarray) -> np.ndarray:
    """Whether each bit's shingles are odd in number, as signed 64-bit numbers."""
    size = 64 * PARITY_WORDS
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (size - 1), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prints(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed 64-bit numbers."""
    pair = (mixed(shingles), mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)))
    return tuple(int(x.sum(dtype=np.uint64).view(np.int64)) for x in pair)


def sketches(docs: DataFrame, width: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit print of the set, its parity bits and its buckets (NULL if empty)."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                sizes, first, second, bits, keys = [], [], [], [], []
                for text in piece.column(1):
                    own = shingle_set(text.as_py(), width)
                    sizes.append(len(own))
                    a, b = prints(own)
                    first.append(a)
                    second.append(b)
                    bits.append(parity(own))
                    keys.append(band_keys(own, bands) if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(first, pa.int64()),
                        pa.array(second, pa.int64()),
                        pa.array(bits, pa.list_(pa.int64())),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "print_a", "print_b", "bits", "keys"],
                )

    schema = "doc_id long, n_shingles long, print_a long, print_b long, bits array<long>, keys array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node and packed set of the classes ``wanted`` (node, doc), from the texts of their ``doc``."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sets = [shingle_set(t.as_py(), width) for t in batch.slice(at, 512).column(1)]
                named = [prints(own) for own in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([len(own) for own in sets], pa.int64()),
                        pa.array([a for a, _ in named], pa.int64()),
                        pa.array([b for _, b in named], pa.int64()),
                        pa.array([own.tobytes() for own in sets], pa.binary()),
                    ],
                    names=[*SAME, "packed"],
                )

    ids = wanted.select("doc").distinct()
    some = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
    met = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").join(some, "doc", "left_semi")
    found = met.mapInArrow(run, "n_shingles long, print_a long, print_b long, packed binary")
    # a doc_id can stand on texts of other classes too
    named = found.select(F.struct(*SAME).alias("node"), "packed").join(wanted, "node", "left_semi")
    return named.dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (hub, node) with den * shared >= num * united."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                keep = []
                for a, b in zip(piece.column(2), piece.column(3), strict=True):
                    x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (a, b))
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(den * shared >= num * (len(x) + len(y) - shared))
                mask = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).filter(mask), piece.column(1).filter(mask)], names=["a", "b"]
                )

    kind = pairs.schema["node"].dataType.simpleString()
    pieces = pairs.groupBy("hub").agg((F.count(F.lit(1)) / PAIRS_TOGETHER).cast("int").alias("more"))
    hubs = sets.withColumnsRenamed({"node": "hub", "packed": "hub_packed"}).join(pieces, "hub")
    dealt = hubs.select("hub", "hub_packed", F.explode(F.sequence(F.lit(0), F.col("more"))).alias("salt"))
    salted = pairs.join(pieces, "hub").select("hub", "node", F.pmod(F.xxhash64("node"), F.col("more") + 1).cast("int").alias("salt"))
    both = salted.join(sets, "node").join(dealt, ["hub", "salt"])
    return both.select("hub", "node", "hub_packed", "packed").mapInArrow(run, f"a {kind}, b {kind}")


def _saved(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    return stored(df, label)


def _near(a: str, b: str, num: int, den: int) -> Column:
    """Size and parity filters: what no pair with den * shared >= num * united fails."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum(
        (F.bit_count(F.get(f"{a}.bits", F.lit(i)).bitwiseXOR(F.get(f"{b}.bits", F.lit(i)))) for i in range(PARITY_WORDS)), F.lit(0)
    )
    return (den * F.least(na, nb) >= num * F.greatest(na, nb)) & ((den + num) * apart <= (den - num) * (na + nb))


def _shared_ids(rows: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of rows with one ``doc_id``: they share a component."""
    own = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", F.struct(*SAME).alias("b"))
    heads = own.groupBy("doc_id").agg(F.min("b").alias("a"), F.max("b").alias("last")).filter("a <> last")
    return own.join(heads.drop("last"), "doc_id").filter("a <> b").select("a", "b").distinct()


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with their labels, of buckets that still hold two components or more."""
    known = members.join(labels, "node")
    going = known.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a < b").select("key")
    return known.join(going, "key", "left_semi")


def components_of(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    require(docs, "doc_id", "text")
    spark = docs.sparkSession
    rows = _saved(spark, sketches(docs, width, bands_for(num / den, miss)), "minhash-rows")
    classes = _saved(
        spark,
        rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*SAME)
        .agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("copies"), F.first(F.struct("bits", "keys")).alias("own"))
        .select(F.struct(*SAME).alias("node"), "doc", "copies", "own.bits", "own.keys"),
        "minhash-classes",
    )
    postings = classes.select(F.explode("keys").alias("key"), "node")
    crowded = postings.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key")
    shared = postings.join(crowded, "key", "left_semi")
    members = shared.join(classes.select("node", "copies", F.col("node.n_shingles").alias("n"), "bits"), "node")
    members = _saved(spark, members.withColumn("label", F.col("node")), "minhash-members")
    labels = _saved(spark, members.select("node", "label").distinct(), "minhash-labels")
    tied = _saved(spark, _shared_ids(rows), "minhash-tied")
    if not tied.isEmpty():
        ends = tied.select("a", "a").union(tied.select("b", "b")).toDF("node", "label")
        labels = _saved(spark, connect(labels.union(ends).distinct(), tied), "minhash-labels")
        members = _saved(spark, _open(members.drop("label"), labels), "minhash-members")
    hubs_each = 1
    while not members.isEmpty():
        # hubs come from the labels with the fewest members, most copies first
        part = F.pmod(F.xxhash64("label"), F.lit(hubs_each)).alias("part")
        groups = members.groupBy("key", "label").agg(
            F.count(F.lit(1)).alias("size"), F.min(F.struct((-F.col("copies")).alias("fewer"), F.col("node").alias("hub"))).alias("top")
        )
        picked = (
            groups.groupBy("key", part)
            .agg(F.min(F.struct("size", "top.fewer", "top.hub")).alias("h"))
            .select("key", F.col("h.hub").alias("node"))
        )
        hubs = _saved(spark, members.join(picked, ["key", "node"], "left_semi"), "minhash-hubs")
        pairs = (
            members.alias("x")
            .join(hubs.alias("h"), (F.col("x.key") == F.col("h.key")) & (F.col("x.label") != F.col("h.label")) & _near("x", "h", num, den))
            .select(F.col("h.node").alias("hub"), F.col("x.node").alias("node"))
            .distinct()
        )
        pairs = _saved(spark, pairs, "minhash-pairs")
        members = members.join(hubs.select("key", "node"), ["key", "node"], "left_anti")
        if not pairs.isEmpty():
            ends = pairs.select("node").union(pairs.select("hub")).distinct()
            ends = _saved(spark, ends.join(classes.select("node", "doc"), "node"), "minhash-ends")
            sets = _saved(spark, _sets(docs, ends, width), "minhash-sets")
            links = _saved(spark, _confirmed(pairs, sets, num, den), "minhash-links")
            labels = _saved(spark, connect(labels, links), "minhash-labels")
        members = _saved(spark, _open(members.drop("label"), labels), "minhash-members")
        hubs_each *= 16
    labelled = labels.join(classes.select("node", "doc"), "node")
    firsts = labelled.groupBy("label").agg(F.min("doc").alias("first"))
    met = labelled.join(firsts, "label").select("node", "first")
    named = classes.select("node", "doc").join(met, "node", "left").select("node", F.coalesce("first", "doc").alias("named"))
    joined = rows.select("doc_id", "n_shingles", F.struct(*SAME).alias("node")).join(named, "node", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("named", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.cast("long").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def deduplicate(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, miss: float = MISS) -> DataFrame:
    """The documents without those that another of their component stands for."""
    found = components_of(docs, width, num, den, miss)
    gone = free_name(docs, "_gone")
    dropped = found.filter("NOT kept").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(dropped, docs["doc_id"].cast("long") == F.col(gone), "left_anti")
