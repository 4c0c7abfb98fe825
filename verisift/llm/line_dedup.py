"""Near-equal lines by an exact set-similarity join, with DataFrame functions only.

A line is the set of its words, in an order that needs no counting: longest first, as long
words tend to be rare, then by hash. Tokens are pairs of words that follow each other in that
order. A word more or less undoes two tokens at most, or one and adds two, so of two sets with
a Jaccard similarity of 0.8 one of the first ``2 * n / 5 + 1`` tokens of each is shared
(prefix filter); sizes differ by a fifth at most (length filter); and 64 parity bits, 256 for long
lines, bound how many words differ. What remains is verified on the whole sets.

A line goes if an earlier line, by ``doc_id``, print of the text and line number, is equal or
similar enough. The 96-bit print tells rows apart that share a ``doc_id`` or have none.
Equal sets fold to their first line. One earlier match settles a line, so no pairs are listed
within a large group: sets under a token that few sets share are all compared; under other
tokens, some of the most copied and earliest sets are compared with the open lines, and the
next round, over lines still open, compares sixteen times as many.

Tokens are dealt and compared slice by slice, and what a step leaves on disk goes with the step.

Edge cases: NULL texts and lines without words match nothing and stay; a NULL ``doc_id``
sorts first; rows with the same ``doc_id`` and text count as one document and keep the same
lines, rows with the same ``doc_id`` and other texts are documents of their own, in the order
of their prints; an empty table gives an empty table; further columns are kept by
``remove_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verisift.llm.lets import free_name, let, require, words_of
from verisift.session import discard, scratch_path, stored, write_scratch

#: Characters that are no words.
BLANK = " \t\n\x0b\x0c\r"
#: Sets under a token that are all compared for each one picked, and how the picks grow by round.
TOGETHER, GROWTH = 8, 16
#: Slices of the tokens, one after the other: each has its share of the shuffled tokens on disk.
SLICES = 4
#: Lines to verify are looked up by broadcasts of this number, at most so many one after the other; by a shuffle
#: of their texts beyond it.
MOST_BROADCAST, MOST_PASSES = 1_000_000, 16
#: Lines of so many words have ``WIDE`` times 64 parity bits too: 64 say little of sets with more words than bits.
LONG, WIDE = 40, 4
#: What names a document, and a line.
DOC = ["doc", "text_a", "text_b"]
LINE = [*DOC, "pos"]


def _saved(df: DataFrame, label: str) -> DataFrame:
    return stored(df, label)


def _doc_key() -> dict[str, Column]:
    """The values of ``DOC``: the id, lowest for NULL, and 96 bits of the text."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return {"doc": doc, "text_a": F.xxhash64("text"), "text_b": F.hash("text")}


def _has_words(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(BLANK))) > 0


def _lines(keyed: DataFrame) -> DataFrame:
    """The key and the text of every line that has words, of texts with their keys."""
    lines = keyed.select(*DOC, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"))
    # the test reads the line, so words are not cut a second time for it
    return lines.filter(_has_words(F.col("line")))


def _keyed(docs: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """Texts with their keys; keys come before the lines, so a text is hashed once.

    With ``among`` only documents of its ``doc`` numbers, whose other texts are neither hashed nor cut.
    """
    require(docs, "doc_id", "text")
    key = _doc_key()
    named = docs.select(key["doc"].alias("doc"), "text")
    if among is not None:
        named = named.join(F.broadcast(among.select("doc").distinct()), "doc", "left_semi")
    return named.select("doc", *[key[c].alias(c) for c in DOC[1:]], "text")


def _sets(lines: DataFrame) -> DataFrame:
    """The line's key and its distinct word numbers in order: 56 bits of the word's hash, less
    its length in bytes above them, so longer words come first."""

    def number(w: Column) -> Column:
        size = F.least(F.octet_length(w), F.lit(127)).cast("long")
        return F.shiftrightunsigned(F.xxhash64(w), 8) - F.shiftleft(size, 56)

    return lines.select(*LINE, F.sort_array(F.array_distinct(F.transform(words_of(F.col("line")), number))).alias("set"))


def _parity(words: Column, part: int | None = None) -> Column:
    """64 bits, each the parity of the words that fall on it: two sets differ in at least as
    many words as these differ in bits. With ``part`` only of its share of the words."""

    def bit(w: Column) -> Column:
        one = F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63)).cast("int"))
        return one if part is None else F.when(F.shiftright(w, 6).bitwiseAND(F.lit(WIDE - 1)) == part, one).otherwise(F.lit(0).cast("long"))

    return F.aggregate(words, F.lit(0).cast("long"), lambda bits, w: bits.bitwiseXOR(bit(w)))


def first_lines(docs: DataFrame) -> DataFrame:
    """One row per distinct set: its first line, copies, size, parity bits (``wide``: of long lines) and tokens.

    Tokens are 32-bit hashes: pairs that share one add candidates, never matches.
    """
    count = F.expr("least(int(2 * size(set) div 5) + 1, size(set) - 1)")
    wide = F.when(F.size("set") >= LONG, F.array(*[_parity(F.col("set"), i) for i in range(WIDE)]))
    # the parts of a long line's words together have all of them
    together = F.aggregate("wide", F.lit(0).cast("long"), lambda bits, part: bits.bitwiseXOR(part))
    keyed = _sets(_lines(_keyed(docs))).withColumn("wide", wide).select(
        F.xxhash64("set").alias("set_a"),
        F.hash("set").alias("set_b"),
        F.size("set").alias("n"),
        F.struct(
            *LINE,
            F.when(F.col("wide").isNull(), _parity(F.col("set"))).otherwise(together).alias("bits"),
            "wide",
            F.zip_with(F.slice("set", F.lit(1), count), F.slice("set", F.lit(2), count), lambda v, w: F.hash(v, w)).alias("tokens"),
        ).alias("line"),
    )
    return keyed.groupBy("set_a", "set_b", "n").agg(F.min("line").alias("line"), F.count(F.lit(1)).alias("copies")).select(
        F.monotonically_increasing_id().alias("id"), *[f"line.{c}" for c in LINE], "n", "copies", "line.bits", "line.wide", "line.tokens"
    )


def _members(firsts: DataFrame, part: int | None = None) -> DataFrame:
    """Tokens of more than one set, with the sets that hold them and their number; with ``part`` those of a slice."""
    if part is not None:
        firsts = firsts.withColumn("tokens", F.filter("tokens", lambda t: F.pmod(t, F.lit(SLICES)) == part))
    sets = firsts.select("id", "n", "bits", F.explode("tokens").alias("token"))
    shared = firsts.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    return sets.join(shared.hint("shuffle_hash"), "token")


def _whole_sets(docs: DataFrame, wanted: DataFrame) -> list[DataFrame]:
    """The key and the whole set of the wanted lines, and of others by the same id, in parts to be read one
    after the other."""
    n = wanted.count()
    if n <= MOST_BROADCAST * MOST_PASSES:
        passes = -(-n // MOST_BROADCAST) if n else 1
        some = [wanted.filter(F.pmod(F.xxhash64("doc", "pos"), F.lit(passes)) == i) for i in range(passes)] if passes > 1 else [wanted]
        lines = [
            _lines(_keyed(docs, part)).join(F.broadcast(part.select("doc", "pos").distinct()), ["doc", "pos"], "left_semi") for part in some
        ]
    else:  # dealt with the prints, so rows without an id do not meet in one task
        held = _keyed(docs).join(wanted.groupBy(*DOC).agg(F.collect_set("pos").alias("wanted")), DOC)
        lines = [held.select(*DOC, "wanted", F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter("array_contains(wanted, pos)")]
    return [_sets(part).dropDuplicates(LINE) for part in lines]


def _possible(a: str, b: str) -> Column:
    """Length and parity filters for two sets.

    Sets with a similarity of 0.8 differ in at most a ninth of their sizes together.
    """
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = F.bit_count(F.col(f"{a}.bits").bitwiseXOR(F.col(f"{b}.bits")))
    return (5 * F.least(na, nb) >= 4 * F.greatest(na, nb)) & (9 * apart <= na + nb)


def _still_possible(a: str, b: str) -> Column:
    """The parity filter on the further bits of long lines."""
    apart = sum((F.bit_count(F.get(f"{a}.wide", F.lit(i)).bitwiseXOR(F.get(f"{b}.wide", F.lit(i)))) for i in range(WIDE)), F.lit(0))
    return F.coalesce(9 * apart <= F.col(f"{a}.n") + F.col(f"{b}.n"), F.lit(True))


def _few_pairs(few: DataFrame) -> DataFrame:
    """The ids of sets that share a token and pass the first filters."""
    x, y = few.alias("x"), few.alias("y")
    pairs = x.join(y, "token").filter((F.col("x.id") < F.col("y.id")) & _possible("x", "y"))
    return pairs.select(F.col("x.id").alias("id"), F.col("y.id").alias("other")).distinct()


def _named(pairs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Lines with the earlier ones, of pairs of ids, that pass the last filter."""
    ids = pairs.select("id").union(pairs.select("other")).distinct()
    known = firsts.select("id", "n", "wide", *LINE)
    known = known.join(F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids, "id", "left_semi")
    x, y = known.alias("x"), known.withColumnRenamed("id", "other").alias("y")
    both = pairs.join(x, "id").join(y, "other").filter(_still_possible("x", "y"))
    one, two = (F.struct(*[F.col(f"{side}.{c}") for c in LINE]) for side in "xy")
    ends = both.select(F.greatest(one, two).alias("later"), F.least(one, two).alias("earlier"))
    return ends.select("later.*", *[F.col(f"earlier.{c}").alias(f"hub_{c}") for c in LINE])


def _hubs(members: DataFrame, each: int) -> DataFrame:
    """Of the sets under each token, the first of each of ``each`` parts."""
    columns = [*LINE, "n", "bits", "wide"]
    # most copied sets first, earlier ones before later; the complement has no overflow
    order = F.struct("copies", *[F.bitwise_not(F.col(c)).alias(f"minus_{c}") for c in LINE], *columns)
    # one part needs no exchange beyond that of the tokens
    part = [F.pmod(F.xxhash64(*LINE), F.lit(each)).alias("part")] if each > 1 else []
    return members.groupBy("token", *part).agg(F.max(order).alias("h")).select("token", *[f"h.{c}" for c in columns])


def _candidates(still: DataFrame, hubs: DataFrame) -> DataFrame:
    """Lines still open with the earlier sets, of those to compare, that pass every filter."""
    return (
        still.alias("x")
        .join(hubs.alias("h"), "token")
        # plain numbers before structs, as most pairs fail there
        .filter(_possible("x", "h") & _still_possible("x", "h") & (F.struct(*[f"h.{c}" for c in LINE]) < F.struct(*[f"x.{c}" for c in LINE])))
        .select(*[f"x.{c}" for c in LINE], *[F.col(f"h.{c}").alias(f"hub_{c}") for c in LINE])
    )


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The keys of the later lines of the pairs that are similar, by their whole sets."""
    spark, hub = docs.sparkSession, [f"hub_{c}" for c in LINE]
    ends = pairs.select(*LINE).union(pairs.select(*hub)).distinct()
    paths = []
    for part in _whole_sets(docs, ends):
        paths.append(scratch_path(spark, "line-sets"))
        write_scratch(part, paths[-1])
    sets = spark.read.parquet(*paths)
    hubs = sets.toDF(*hub, "hub_set")
    both = pairs.join(sets, LINE).join(hubs, hub)
    shared = F.size(F.array_intersect("set", "hub_set"))
    settled = _saved(both.filter(9 * shared >= 4 * (F.size("set") + F.size("hub_set"))).select(*LINE).distinct(), "line-settled")
    for path in paths:
        discard(spark, path)
    return settled


def near_removed(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """The keys of the first lines of sets that are similar to an earlier set."""
    spark, close, frequent = docs.sparkSession, [], []
    held = firsts.select("id", *LINE, "copies", "wide")
    for part in range(SLICES):
        path = scratch_path(spark, "line-tokens")
        shared = write_scratch(_members(firsts, part), path)
        close.append(scratch_path(spark, "line-close"))
        write_scratch(_few_pairs(shared.filter(F.col("m") <= TOGETHER)), close[-1])
        frequent.append(scratch_path(spark, "line-members"))
        write_scratch(shared.filter(F.col("m") > TOGETHER).join(held, "id").drop("id"), frequent[-1])
        discard(spark, path)
    found = _named(spark.read.parquet(*close).distinct(), firsts)
    members, gone, each = spark.read.parquet(*frequent), None, 1
    found = found.union(_candidates(members, _hubs(members, 1)))
    while True:
        # each round reads the texts again for its whole sets, so few rounds
        pairs = _saved(found.distinct(), "line-pairs")
        if not pairs.isEmpty():
            settled = _verified(docs, pairs)
            gone = settled if gone is None else gone.union(settled)
        # tokens whose sets were all compared are done
        members = _saved(members.filter(F.col("m") > TOGETHER * each), "line-members")
        if members.isEmpty():
            break
        each *= GROWTH
        still = members if gone is None else members.join(gone, LINE, "left_anti")
        few, many = F.col("m") <= TOGETHER * each, F.col("m") > TOGETHER * each
        found = _candidates(still.filter(few), members.filter(few)).union(
            _candidates(still.filter(many), _hubs(members.filter(many), each))
        )
    return gone if gone is not None else firsts.select(*LINE).limit(0)


def kept_lines(docs: DataFrame) -> DataFrame:
    """A document's key and ``kept``, the numbers of the lines with words that it keeps."""
    firsts = _saved(first_lines(docs), "line-firsts")
    gone = near_removed(docs, firsts)
    kept = firsts.select(*LINE).join(gone, LINE, "left_anti").groupBy(*DOC).agg(F.sort_array(F.collect_set("pos")).alias("kept"))
    return _saved(kept, "line-kept")


def decisions(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (with words), n_removed and the numbers of the removed lines."""
    worded = let(
        F.split(F.coalesce("text", F.lit("")), "\n"),
        lambda lines: F.filter(
            F.sequence(F.lit(0), F.size(lines) - 1), lambda i: _has_words(F.get(lines, i))
        ),
    )
    numbered = docs.select("doc_id", *[value.alias(c) for c, value in _doc_key().items()], worded.alias("lines"))
    met = numbered.join(kept_lines(docs), DOC, "left")
    removed = F.array_except("lines", F.coalesce("kept", F.array().cast("array<int>")))
    return met.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size(removed).cast("long").alias("n_removed"),
        removed.alias("removed"),
    )


def remove_lines(docs: DataFrame) -> DataFrame:
    """The documents without the removed lines; lines without words stay, as do all rows."""
    kept, key = free_name(docs, "_kept"), {c: free_name(docs, f"_{c}") for c in DOC}
    held = kept_lines(docs).select(*[F.col(c).alias(key[c]) for c in DOC], F.col("kept").alias(kept))
    met = docs.withColumns({key[c]: value for c, value in _doc_key().items()}).join(held, list(key.values()), "left")
    lines = F.filter(
        F.split("text", "\n"),
        lambda line, i: ~_has_words(line)
        | F.coalesce(F.array_contains(kept, i), F.lit(False)),
    )
    text = F.array_join(lines, "\n")
    columns = [
        text.alias("text") if c == "text" else F.length(text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return met.select(*columns)
