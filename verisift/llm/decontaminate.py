"""Benchmark passages inside documents by a prefix-filtered set join, with DataFrame functions only.

An item is cut into windows of ``width`` words; an item of fewer words is one window. A
window is the set of its shingles, runs of three words (of all its words, if there are
fewer). A document holds a window if it holds all its shingles at their places, so by the
prefix filter it holds the window's rarest shingle: only that one is joined. Rarity is
counted over all documents, for the shingles of the items.

Documents are read twice. Both times a bitmap of fixed size drops the places whose shingle
no item has, the second time those whose shingle is no window's rarest, before any row is
made. The places left meet the rarest shingles, one row each with the offsets at which
windows hold it; the positional and the length filter drop windows that would begin before
the text or end behind it. What remains is verified word by word on a document window of
the size of the item's.

Each window's text is one row whatever the number of items that share it, and documents with
equal sets of windows share one list of items, so a passage that many items and many
documents have in common makes no pairs until the items are named.

Words are runs of letters a-z, digits and characters beyond ASCII, after A-Z became a-z.

Defined results: NULL texts and texts without words hold nothing and are held by nothing; an
item counts once, however often its row or its passage is repeated; an item whose id is NULL
hits words but is neither counted nor named; rows with the same ``doc_id`` and text have the
same result, rows with one ``doc_id`` and other texts are documents of their own; an empty
benchmark hits nothing, an empty table of documents gives an empty table; further columns
are kept by ``clean``, which gives no column a new name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verisift.llm.lets import free_name, require
from verisift.session import scratch_path

#: Words of a shingle.
SHINGLE = 3
#: Bits of the map of shingles, and bits in each of its rows.
BITS, ROW = 1 << 20, 1 << 10
#: What names a document.
DOC = ["doc", "text_a", "text_b"]
#: Every ASCII character that is no letter or digit.
_GAPS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def words_of(text: Column) -> Column:
    """Words in order, in lower case; none for NULL."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + _GAPS, _UPPER.lower() + " " * len(_GAPS))
    return F.array_remove(F.split(plain, " "), "")


def _shingle(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(size)], F.lit(size))


def _places(words: Column, size: int) -> Column:
    """Where a run of ``size`` words can begin; none if there are fewer."""
    last = F.size(words) - size
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _doc_key() -> dict[str, Column]:
    """What tells documents apart: the id and 96 bits of the text."""
    return {"doc": F.col("doc_id"), "text_a": F.xxhash64("text"), "text_b": F.hash("text")}


def windows_of(items: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (window, words), and the items that have them (window, item_id)."""
    require(items, "item_id", "text")
    worded = items.select("item_id", words_of(F.col("text")).alias("words")).filter("size(words) > 0")
    cut = worded.select(
        "item_id",
        F.explode(
            F.when(F.size("words") <= width, F.array("words")).otherwise(
                F.transform(_places(F.col("words"), width), lambda i: F.slice("words", i + 1, F.lit(width)))
            )
        ).alias("words"),
    )
    # the words themselves are the name: hashes only shorten the keys of joins
    named = cut.withColumn("window", F.md5(F.array_join("words", " "))).distinct()
    return named.select("window", "words").distinct(), named.select("window", "item_id").distinct()


def _shingles_of(windows: DataFrame) -> DataFrame:
    """window, n (its words), and each of its shingles with its offset."""
    n = F.size("words")
    short = [
        F.array(F.struct(F.lit(0).alias("at"), _shingle(F.col("words"), F.lit(0), k).alias("shingle")))
        for k in range(1, SHINGLE)
    ]
    whole = F.transform(
        _places(F.col("words"), SHINGLE),
        lambda i: F.struct(i.alias("at"), _shingle(F.col("words"), i, SHINGLE).alias("shingle")),
    )
    found = whole
    for k in range(1, SHINGLE):
        found = F.when(n == k, short[k - 1]).otherwise(found)
    return windows.select("window", n.alias("n"), F.inline(found))


def _bitmap(shingles: DataFrame) -> DataFrame:
    """One row: for each of ``BITS`` buckets whether a shingle falls into it; fixed size."""
    bucket = F.col("shingle").bitwiseAND(F.lit(BITS - 1)).cast("int")
    spark = shingles.sparkSession
    none = spark.range(0, BITS, 1, 4).select(F.col("id").cast("int").alias("b"), F.lit(False).alias("on"))
    cells = shingles.select(bucket.alias("b"), F.lit(True).alias("on")).union(none).groupBy("b").agg(F.max("on").alias("on"))

    def packed(df: DataFrame, key: Column, at: str, part: str) -> DataFrame:
        parts = F.sort_array(F.collect_list(F.struct(F.col(at), F.col(part).alias("part"))))
        return df.groupBy(key.alias("row")).agg(F.transform(parts, lambda p: p["part"]).alias("bits"))

    rows = packed(cells, F.floor(F.col("b") / ROW).cast("int"), "b", "on")
    return _saved(packed(rows, F.lit(0), "row", "bits").select(F.flatten("bits").alias("bits")), "leak-bits")


def _known(words: Column, bits: Column, size: int) -> Column:
    """The places in the text whose shingle falls on a set bit."""
    return F.filter(
        _places(words, size),
        lambda i: F.get(bits, _shingle(words, i, size).bitwiseAND(F.lit(BITS - 1)).cast("int")),
    )


def _sizes(windows: DataFrame) -> list[int]:
    """The sizes that shingles of these windows have: three numbers at most."""
    found = windows.select(F.least(F.size("words"), F.lit(SHINGLE)).alias("k")).distinct().collect()
    return sorted(r.k for r in found)


def rarest(docs: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """One row per shingle that is the rarest of a window: shingle, and the offsets and sizes
    (at, n) of the windows that it stands for."""
    shingles = _shingles_of(windows)
    bits = _bitmap(shingles)
    held = docs.select(words_of(F.col("text")).alias("words"), bits.scalar().alias("bits"))

    def known(k: int) -> Column:
        return F.transform(_known(F.col("words"), F.col("bits"), k), lambda i: _shingle(F.col("words"), i, k))

    seen = F.concat(*[known(k) for k in sizes])
    counts = held.select(F.explode(seen).alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("seen"))
    ranked = shingles.join(counts, "shingle", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "shingle", "at", "n")).alias("first")
    )
    return ranked.groupBy("first.shingle").agg(F.collect_set(F.struct("first.at", "first.n")).alias("uses"))


def scan(docs: DataFrame, prefixes: DataFrame, sizes: list[int], width: int) -> DataFrame:
    """One row per document (key, doc_id, n_words), with its places of a rarest shingle: the
    place, the shingle and the words around it that a window could hold."""
    bits = _bitmap(prefixes)
    held = docs.select(
        "doc_id",
        *[value.alias(c) for c, value in _doc_key().items()],
        words_of(F.col("text")).alias("words"),
        bits.scalar().alias("bits"),
    )

    def around(k: int) -> Column:
        def place(i: Column) -> Column:
            begin = F.greatest(i - (width - k), F.lit(0))
            return F.struct(
                i.alias("place"),
                _shingle(F.col("words"), i, k).alias("shingle"),
                begin.alias("begin"),
                F.slice("words", begin + 1, i + width - begin).alias("near"),
            )

        return F.transform(_known(F.col("words"), F.col("bits"), k), place)

    return held.select(
        "doc_id", *DOC, F.size("words").cast("long").alias("n_words"), F.concat(*[around(k) for k in sizes]).alias("places")
    )


def occurrences(docs: DataFrame, windows: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Every document with its number of words, and each place where a document (by key)
    holds a window: begin, n, window."""
    sizes = _sizes(windows)
    if not sizes:
        scanned = docs.select(
            "doc_id", *[v.alias(c) for c, v in _doc_key().items()], F.size(words_of(F.col("text"))).cast("long").alias("n_words")
        )
        none = scanned.select(*DOC, F.lit(0).alias("begin"), F.lit(0).alias("n"), F.lit("").alias("window"))
        return scanned, none.filter("false")
    prefixes = _saved(rarest(docs, windows, sizes), "leak-prefixes")
    scanned = _saved(scan(docs, prefixes, sizes, width), "leak-scan")
    places = scanned.filter("size(places) > 0").select(*DOC, "n_words", F.inline("places"))
    used = places.join(prefixes, "shingle").select(
        *DOC, "n_words", "begin", "near", (F.col("place")).alias("place"), F.inline("uses")
    )
    begin = F.col("place") - F.col("at")
    fits = used.select(*DOC, begin.alias("from"), "n", "n_words", "begin", "near").filter("from >= 0 AND from + n <= n_words")
    texts = fits.select(
        *DOC, F.col("from").alias("begin"), "n", F.expr("slice(near, from - begin + 1, n)").alias("found")
    )
    keyed = texts.withColumn("window", F.md5(F.array_join("found", " ")))
    verified = keyed.join(windows, "window").filter(F.col("found") == F.col("words"))
    return scanned.drop("places"), verified.select(*DOC, "begin", "n", "window").distinct()


def _covered(spans: Column) -> Column:
    """Number of words under sorted (begin, end) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))

    def step(state: Column, span: Column) -> Column:
        more = F.greatest(span["end"] - F.greatest(span["begin"], state["upto"]), F.lit(0))
        return F.struct((state["n"] + more).alias("n"), F.greatest(state["upto"], span["end"]).alias("upto"))

    return F.aggregate(spans, start, step, lambda state: state["n"])


def findings(docs: DataFrame, items: DataFrame, *, width: int = 10) -> DataFrame:
    """One row per document: doc_id, its key, n_words, n_hit (words under a window), n_items
    and items_sha256 (of the ids of items with a window in it), and ``spans``, the hit windows."""
    require(docs, "doc_id", "text")
    windows, owners = (_saved(df, "leak-windows") for df in windows_of(items, width))
    scanned, found = occurrences(docs, windows, width)
    spans = F.sort_array(F.collect_set(F.struct("begin", (F.col("begin") + F.col("n")).alias("end"))))
    per_doc = found.groupBy(*DOC).agg(spans.alias("spans"), F.sort_array(F.collect_set("window")).alias("held"))
    per_doc = _saved(per_doc.withColumn("same", F.md5(F.array_join("held", ","))), "leak-found")
    lists = per_doc.groupBy("same").agg(F.min("held").alias("held")).select("same", F.explode("held").alias("window"))
    named = (
        lists.join(owners.filter("item_id IS NOT NULL"), "window")
        .groupBy("same")
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    )
    hit = per_doc.join(named, "same", "left").select(
        *[F.col(c).alias(f"_{c}") for c in DOC],
        "spans",
        _covered(F.col("spans")).alias("n_hit"),
        F.size(F.coalesce("ids", F.array().cast("array<string>"))).cast("long").alias("n_items"),
        F.array_join(F.coalesce("ids", F.array().cast("array<string>")), ",").alias("ids"),
    )
    met = scanned.join(
        hit, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("text_a") == F.col("_text_a")) & (F.col("text_b") == F.col("_text_b")), "left"
    )
    return met.select(
        "doc_id",
        *DOC,
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"),
        "spans",
    )


def clean(docs: DataFrame, items: DataFrame, *, width: int = 10) -> DataFrame:
    """The documents that hold no window of an item, with all their columns."""
    keys = {c: free_name(docs, f"_leak_{c}") for c in DOC}
    hit = findings(docs.select("doc_id", "text"), items, width=width).filter("n_hit > 0").select(*[F.col(c).alias(keys[c]) for c in DOC])
    named = docs.withColumns({f"{keys[c]}_": value for c, value in _doc_key().items()})
    same = F.lit(True)
    for c in DOC:
        same = same & F.col(keys[c]).eqNullSafe(F.col(f"{keys[c]}_"))
    return named.join(hit.distinct(), same, "left_anti").select(*[f"`{c}`" for c in docs.columns])
