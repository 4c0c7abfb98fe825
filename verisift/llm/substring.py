"""Repeated passages by recompression.

Each document is rewritten in rounds: runs of one symbol get a name of their own, then
pairs of a left and a right symbol (a coin of their names decides which they are) get one.
Names are 64-bit prints of what they stand for, so equal words get equal names everywhere
without a dictionary. A name depends on few words around it, its reach; so two equal
windows hold the same names wherever the reach lies inside the window.

Each window is represented by the least name that lies in it with its reach. Spark counts
these names over the whole corpus; only windows whose name occurs twice, or that hold no
name (long runs of one word), can be repeated. Those windows are compared by prints of all
their words, again counted by Spark, and the words they cover are removed.

Texts are told apart by prints; copies of a text are looked at once, with their number.

Edge cases: NULL and empty texts have no words and keep none; texts shorter than a window
are left alone; rows repeated in the table are copies and lose every window; an empty table
gives an empty table; a NULL ``doc_id`` is carried; further columns are dropped.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verisift.llm.lets import require, words_of
from verisift.llm.word_hash import blocks, hash_texts, mixed, prints
from verisift.session import scratch_path

WINDOW = 35
ROUNDS = 2
_FAR = 1 << 40
_GAPS = re.compile(r"[\x20\x09-\x0D]+")


def _grouped(names: np.ndarray, low: np.ndarray, high: np.ndarray, first: np.ndarray, fresh: np.ndarray):
    """Symbols that start at ``first``; each now also depends on its two neighbours."""
    last = np.append(first[1:], len(names)) - 1
    before, after = np.append(-_FAR, low[:-1]), np.append(high[1:], _FAR)
    return fresh, before[first], after[last]


def recompress(words: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names after some rounds, and the words [low, high) that each depends on."""
    names, low = words, np.arange(len(words), dtype=np.int64)
    high = low + 1
    for turn in range(rounds):
        salt = np.uint64(2 * turn + 1)
        first = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
        count = np.diff(np.append(first, len(names))).astype(np.uint64)
        run = np.where(count > 1, mixed(names[first] + count * np.uint64(0xD1342543DE82EF95) + salt), names[first])
        names, low, high = _grouped(names, low, high, first, run)
        left = (mixed(names + salt) & np.uint64(1)) == 0
        joined = left[:-1] & ~left[1:]
        first = np.flatnonzero(np.append(True, ~joined))
        pair = names[first].copy()
        wide = np.append(joined, False)[first]
        pair[wide] = mixed(pair[wide] * np.uint64(0x9E3779B97F4A7C15) + names[first[wide] + 1] + salt)
        names, low, high = _grouped(names, low, high, first, pair)
    return names, low, high


def _least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The index of the least value in each range; ranges are not empty."""
    order = np.argsort(values, kind="stable")
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    out, span, table = np.empty(len(begin), np.int64), 1, rank
    length = end - begin
    while True:
        fits = (length >= span) & (length < 2 * span)
        out[fits] = np.minimum(table[begin[fits]], table[end[fits] - span])
        if not (length >= 2 * span).any():
            return order[out]
        table = np.minimum(table[: len(table) - span], table[span:])
        span *= 2


class Block:
    """Many texts in one row of words, a stop of its own after each text.

    A window that holds a stop is not one, and a name whose reach holds a stop lies in no
    window, so texts do not touch each other.
    """

    def __init__(self, texts: list[str | None], window: int, rounds: int = ROUNDS):
        hashes, at = hash_texts(texts)
        self.window, n = window, len(texts)
        lengths = np.diff(at)
        self.first = at[:-1] + np.arange(n)
        self.words = np.insert(hashes, at[1:], mixed(np.arange(1, n + 1, dtype=np.uint64) << np.uint64(33)))
        #: starts of all windows, and the text of each
        room = np.maximum(lengths - window + 1, 0)
        self.text_of = np.repeat(np.arange(n), room)
        self.starts = np.arange(int(room.sum())) - np.repeat(np.cumsum(room) - room, room) + np.repeat(self.first, room)
        self._rounds = rounds

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each window the print of the name that stands for it, whether there is one,
        and which symbol of the block it is."""
        names, low, high = recompress(self.words, self._rounds)
        begin = np.searchsorted(low, self.starts, "left")
        end = np.searchsorted(high, self.starts + self.window, "right")
        some = end > begin
        found, place = np.zeros(len(self.starts), np.uint64), np.full(len(self.starts), -1)
        if some.any():
            place[some] = _least(names, begin[some], end[some])
            chosen, back = np.unique(place[some], return_inverse=True)
            # the reach belongs to the name: it is the same in equal windows
            found[some] = mixed(names[chosen] + prints(self.words, low[chosen], high[chosen]))[back]
        return found, some, place

    def window_prints(self, at: np.ndarray) -> np.ndarray:
        return prints(self.words, self.starts[at], self.starts[at] + self.window)


def with_print(docs: DataFrame) -> DataFrame:
    """doc_id, text and the two columns that tell texts apart."""
    require(docs, "doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("print_a"), F.hash(text).alias("print_b"))


KEY = ["print_a", "print_b"]


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=names)


def _names(texts: DataFrame, window: int) -> DataFrame:
    """print_a, print_b and name: each chosen name of a text once, NULL for windows without."""

    def run(batches):
        for piece, held in blocks(batches, 2):
            own = Block(held, window)
            found, some, place = own.anchors()
            # a name counts once for each symbol that windows chose
            fresh = np.append(True, (place[1:] != place[:-1]) | (own.text_of[1:] != own.text_of[:-1]))[: len(found)]
            at = np.flatnonzero(fresh)
            index = pa.array(own.text_of[at])
            yield _batch(
                [piece.column(0).take(index), piece.column(1).take(index), pa.array(found[at].view(np.int64), mask=~some[at])],
                ["print_a", "print_b", "name"],
            )

    return texts.select(*KEY, "text").mapInArrow(run, "print_a long, print_b int, name long")


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """Prints of the windows whose name is among the text's ``names`` or that have none."""

    def run(batches):
        for piece, held in blocks(batches, 4):
            own = Block(held, window)
            found, some, _ = own.anchors()
            shared = np.zeros(len(found), bool)
            edges = np.searchsorted(own.text_of, np.arange(len(held) + 1))
            for i, names in enumerate(piece.column(3).to_pylist()):
                part = slice(edges[i], edges[i + 1])
                shared[part] = np.isin(found[part], np.array(names, np.int64).view(np.uint64)) | ~some[part]
            at = np.flatnonzero(shared)
            index = pa.array(own.text_of[at])
            start = own.starts[at] - own.first[own.text_of[at]]
            yield _batch(
                [
                    pa.array(own.window_prints(at).view(np.int64)),
                    *(piece.column(i).take(index) for i in range(3)),
                    pa.array(start, pa.int32()),
                ],
                ["print", "print_a", "print_b", "copies", "start"],
            )

    schema = "print long, print_a long, print_b int, copies long, start int"
    return texts.select(*KEY, "copies", "names", "text").mapInArrow(run, schema)


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """Remove the words that the windows at ``starts`` cover."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                removed, kept = [], []
                for starts, text in zip(piece.column(2), piece.column(3), strict=True):
                    words = [w for w in _GAPS.split(text.as_py()) if w]
                    edge = np.zeros(len(words) + 1, np.int64)
                    begin = np.unique(starts.values.to_numpy())
                    np.add.at(edge, begin, 1)
                    np.add.at(edge, begin + window, -1)
                    covered = np.cumsum(edge)[:-1] > 0
                    removed.append(int(covered.sum()))
                    kept.append(" ".join(w for w, gone in zip(words, covered, strict=True) if not gone))
                yield _batch(
                    [piece.column(0), piece.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    ["print_a", "print_b", "n_removed", "kept"],
                )

    schema = "print_a long, print_b int, n_removed long, kept string"
    return texts.select(*KEY, "starts", "text").mapInArrow(run, schema)


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """print_a, print_b, n_removed and the kept words of every text that loses words."""
    texts = with_print(docs)
    named = _names(texts, window)
    shared = _saved(
        named.filter("name IS NOT NULL").groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name"),
        "repeat-names",
    )
    met = named.filter("name IS NOT NULL").join(shared, "name").unionByName(named.filter("name IS NULL").distinct())
    suspects = _saved(met.groupBy(*KEY).agg(F.collect_set("name").alias("names")), "repeat-suspects")
    classes = texts.groupBy(*KEY).agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    chosen = suspects.join(classes, KEY)
    held = _saved(
        texts.join(chosen, KEY).filter(F.col("doc_id").eqNullSafe(F.col("first_id"))).select(*KEY, "copies", "names", "text"),
        "repeat-texts",
    )
    windows = _saved(_windows(held, window), "repeat-windows")
    twice = _saved(
        windows.groupBy("print").agg(F.sum("copies").alias("n")).filter("n > 1").select("print"), "repeat-prints"
    )
    starts = windows.join(twice, "print").groupBy(*KEY).agg(F.collect_set("start").alias("starts"))
    return _saved(_cut(held.select(*KEY, "text").join(starts, KEY), window).dropDuplicates(KEY), "repeat-cuts")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept_text`` of every document."""
    joined = with_print(docs).join(repeats(docs, window), KEY, "left")
    words = words_of(F.col("text"))
    return joined.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept", F.array_join(words, " ")).alias("kept_text"),
    )


def removal_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """As ``remove_repeats``, with the SHA-256 of the kept text; texts are not shuffled again."""
    cuts = repeats(docs, window).select(*KEY, "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    words = words_of(F.col("text"))
    whole = with_print(docs).select(
        "doc_id",
        *KEY,
        F.size(words).cast("long").alias("n_words"),
        F.sha2(F.array_join(words, " ").cast("binary"), 256).alias("whole_sha256"),
    )
    return whole.join(cuts, KEY, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )
