"""Quality rules as a bitmask ledger.

Every document is measured once; each rule leaves one failure bit. A policy is a named
set of rules, hence a mask: applying it is ``bits & mask = 0``, and what a rule costs
alone or together with others comes from counts per bit pattern, without the texts.

Edge cases: a NULL or blank text has no words and fails ``few_words``; a NULL ``doc_id``
is kept as it is; repeated rows are judged one by one; an empty table gives an empty
ledger; further columns of the input are dropped by ``ledger`` and kept by ``accept``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verisift.llm.lets import free_name, let, require, words_of

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper",
)


def _hash_windows(words: Column) -> Column:
    """A hash of each run of eight words, by doubling: 1, 2, 4, 8."""

    def doubled(hashes: Column, step: int) -> Column:
        kept = F.greatest(F.size(hashes) - step, F.lit(0))
        return F.zip_with(
            F.slice(hashes, F.lit(1), kept), F.slice(hashes, F.lit(step + 1), kept), lambda a, b: F.xxhash64(a, b)
        )

    single = F.transform(words, lambda w: F.xxhash64(w))
    return let(single, lambda a: let(doubled(a, 1), lambda b: let(doubled(b, 2), lambda c: doubled(c, 4))))


def _covered(windows: Column) -> Column:
    """Words covered by windows that occur twice or more; sorts only texts that have any."""

    def positions(ranked: Column) -> Column:
        twin = F.filter(
            ranked,
            lambda x, i: F.coalesce(F.get(ranked, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ranked, i + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(twin, lambda x: x["at"]))

    def union(starts: Column) -> Column:
        lengths = F.transform(
            starts, lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW)))
        )
        return F.aggregate(lengths, F.lit(0), lambda total, x: total + x)

    tagged = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        let(F.sort_array(tagged), lambda ranked: let(positions(ranked), union))
    )


def measurements(text: Column) -> Column:
    """All measurements of one text as a struct of longs."""
    filled = F.coalesce(text, F.lit(""))
    letters = F.regexp_count(filled, F.lit(r"\p{L}"))
    lines = F.filter(F.split(filled, "\n"), lambda line: F.length(F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))) > 0)

    def measured(words: Column) -> Column:
        return let(
            lines,
            lambda found: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                F.regexp_count(filled, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
                F.when(F.size(words) > WINDOW, let(_hash_windows(words), _covered))
                .otherwise(F.lit(0))
                .cast("long")
                .alias("n_repeat_words"),
                F.size(found).cast("long").alias("n_lines"),
                letters.cast("long").alias("n_letters"),
                F.regexp_count(filled, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
            ),
        )

    return let(words_of(text), measured)


def rules(names: dict[str, str] | None = None) -> dict[str, Column]:
    """Failure conditions in bit order; append only. ``names`` renames the measurements."""

    def c(measure: str) -> Column:
        return F.col((names or {}).get(measure, measure))

    return {
        "few_words": c("n_words") < 20,
        "repeated_words": 100 * c("n_repeat_words") > 30 * c("n_words"),
        "symbols": 10 * c("n_symbols") > c("n_words"),
        "repeated_lines": 2 * c("n_dup_lines") > c("n_lines"),
        "shouting": 2 * c("n_upper") > c("n_letters"),
        "word_length": (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 25 * c("n_words")),
    }


#: Versions of the policy, each a set of rules. Published versions do not change.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_words"),
    "full-1": ("few_words", "repeated_words", "symbols", "repeated_lines", "shouting", "word_length"),
}


def mask_of(names: Iterable[str]) -> int:
    order = list(rules())
    unknown = set(names) - set(order)
    if unknown:
        raise ValueError(f"unknown rules: {sorted(unknown)}")
    return sum(1 << order.index(name) for name in set(names))


def _bits(conditions: dict[str, Column]) -> Column:
    bits = F.lit(0).cast("long")
    for position, failed in enumerate(conditions.values()):
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << position)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, all measurements and ``failure_bits`` of every document; no shuffle."""
    require(docs, "doc_id", "text")
    measured = docs.select("doc_id", measurements(F.col("text")).alias("m")).select("doc_id", "m.*")
    return measured.withColumn("failure_bits", _bits(rules()))


def passes(bits: Column, policy: str) -> Column:
    return bits.bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def accept(docs: DataFrame, policy: str = "full-1") -> DataFrame:
    """The documents that pass the policy, with all their columns."""
    require(docs, "text")
    own = [F.col(f"`{c}`") for c in docs.columns]
    held = free_name(docs, "_measured")
    names = {m: f"{held}.{m}" for m in MEASURES}
    measured = docs.select(*own, measurements(F.col("text")).alias(held))
    return measured.filter(passes(_bits(rules(names)), policy)).select(*own)


def ablation(book: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: failures, failures by no other rule, documents kept without it.

    The ledger is folded to one row per bit pattern first (at most two to the number of
    rules), so the rest works on a handful of rows.
    """
    mask, order = mask_of(POLICIES[policy]), list(rules())
    patterns = book.groupBy(F.col("failure_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    spread = patterns.withColumn(
        "rule",
        F.explode(F.array(*[F.struct(F.lit(r).alias("name"), F.lit(1 << order.index(r)).alias("bit")) for r in POLICIES[policy]])),
    )
    failed = F.col("bits").bitwiseAND(F.col("rule.bit")) != 0
    others = F.col("bits").bitwiseAND(F.lit(mask).bitwiseXOR(F.col("rule.bit")))
    return spread.groupBy(F.col("rule.name").alias("rule")).agg(
        F.sum(F.when(failed, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(failed & (others == 0), F.col("n")).otherwise(0)).alias("n_only_this"),
        F.sum(F.when(others == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
    )
