"""Language-model scores: a gated recurrent network over word classes, counts inside them.

The probability of a word is that of its class, given all words of the document before it,
times that of the word in its class. Classes are the end of a text, the most frequent words
one by one, and groups of all other words by their last letters. The network (a GRU in
numpy) predicts classes; its state is carried from window to window through a document, so
a score is the likelihood of the complete text. Training is by truncated backpropagation:
windows of 16 words, the state before a window taken as given.

Word counts come from all training documents by one aggregation. Training is data-parallel:
every task trains a copy on the documents of its partition and the copies are averaged by
their words, first over an eighth of the documents, then over the rest, starting from that.

For the scores, frequent words are looked up in a fixed-size table sent to all tasks; all
other words are counted per document and meet their counts in a join. No text is shuffled.

Edge cases: NULL and empty texts consist of the end alone; a NULL ``doc_id`` counts as the
empty text for the fold; repeated rows are scored one by one; without training documents all
counts are 0 and the network keeps its initial, uniform weights; an empty table
gives an empty table; further columns are dropped.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verisift.llm.lang_id import fold
from verisift.llm.lets import require
from verisift.llm.word_hash import _GAP, _LOWER, blocks, mixed, word_hashes_of
from verisift.session import scratch_path

HIDDEN = 16
#: 0 is the end of a text, then single words, then groups by last letters.
SINGLES = 31
GROUPS = 32
CLASSES = 1 + SINGLES + GROUPS
WINDOW = 16
STREAMS = 256
RATE = 0.01
#: Frequent words sent to all tasks; a fixed size, whatever the corpus.
FREQUENT = 1 << 18
#: Words of a partition that are handled at a time.
MOST_WORDS = 1 << 22
END = 0x5EED
ALPHA = 0.1


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and letter groups of the words of many texts, and where each text begins."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    edges = np.cumsum([0, *(len(e) + 1 for e in encoded)])
    data = _LOWER[np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)]
    inside = ~_GAP[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    at = np.searchsorted(np.flatnonzero(opens), edges)
    last = np.flatnonzero(inside[:-1] & ~inside[1:])
    before = np.where(last > 0, data[np.maximum(last - 1, 0)], 0).astype(np.uint64)
    groups = mixed(data[last].astype(np.uint64) << np.uint64(8) | before) % np.uint64(GROUPS)
    return word_hashes_of(data, inside, opens), groups.astype(np.uint8), at


def word_counts(texts: DataFrame) -> DataFrame:
    """word (hash), letter group and count over all texts, the ends of texts apart."""

    def folded(hashes, groups):
        words, first, n = np.unique(np.concatenate(hashes), return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(words.view(np.int64)), pa.array(np.concatenate(groups)[first], pa.int16()), pa.array(n, pa.int64())],
            names=["word", "letters", "n"],
        )

    def run(batches):
        hashes, groups, held = [], [], 0
        for _, held_texts in blocks(batches, 0):
            h, g, _ = tokens(held_texts)
            hashes.append(h)
            groups.append(g)
            held += len(h)
            if held > MOST_WORDS:
                yield folded(hashes, groups)
                hashes, groups, held = [], [], 0
        if hashes:
            yield folded(hashes, groups)

    found = texts.select("text").mapInArrow(run, "word long, letters short, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.min("letters").alias("letters"))


class Frequent:
    """The table of frequent words: sorted hashes, counts, and the classes of the first few."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        top = np.lexsort((words, -counts))[:SINGLES]
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.single = np.zeros(len(words), np.uint8)
        self.single[np.searchsorted(self.words, words[top])] = np.arange(1, len(top) + 1)

    def look_up(self, hashes: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of each word (0: not in the table) and its class."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), (1 + SINGLES + groups).astype(np.uint8)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        met = self.words[at] == hashes
        counts = np.where(met, self.counts[at], 0)
        single = np.where(met, self.single[at], 0)
        return counts, np.where(single > 0, single, 1 + SINGLES + groups).astype(np.uint8)


class Network:
    """A GRU over classes; weights in one dictionary of float32 arrays."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, frequencies: np.ndarray) -> Network:
        """Untrained: whatever came before, it predicts the classes by their frequency."""
        rng = np.random.default_rng(11)
        scale = 1 / math.sqrt(HIDDEN)
        return cls(
            {
                "x": rng.normal(0, 0.3, (CLASSES, 3 * HIDDEN)).astype(np.float32),
                "u": rng.normal(0, scale, (HIDDEN, 3 * HIDDEN)).astype(np.float32),
                "o": rng.normal(0, 0.01, (HIDDEN, CLASSES)).astype(np.float32),
                "b": np.log(frequencies / frequencies.sum()).astype(np.float32),
            }
        )

    def step(self, before: np.ndarray, state: np.ndarray):
        w, n = self.w, HIDDEN
        x, u = w["x"][before], state @ w["u"]
        gates = 1 / (1 + np.exp(-(x[:, : 2 * n] + u[:, : 2 * n])))
        z, r = gates[:, :n], gates[:, n:]
        inner = u[:, 2 * n :]
        new = np.tanh(x[:, 2 * n :] + r * inner)
        return z, r, inner, new, new + z * (state - new)

    def logits(self, state: np.ndarray) -> np.ndarray:
        out = state @ self.w["o"] + self.w["b"]
        out -= out.max(axis=1, keepdims=True)
        return out - np.log(np.exp(out).sum(axis=1, keepdims=True))

    def gradient(self, before, target, fresh, valid, state):
        """Gradient over one window (steps by streams) and the state after it."""
        w, n = self.w, HIDDEN
        kept, grad = [], {k: np.zeros_like(v) for k, v in w.items()}
        for t in range(len(before)):
            state = state * ~fresh[t][:, None]
            z, r, inner, new, after = self.step(before[t], state)
            kept.append((state, z, r, inner, new, after))
            state = after
        total = max(1, int(valid.sum()))
        d_state = np.zeros_like(state)
        rows = np.arange(len(state))
        for t in reversed(range(len(before))):
            old, z, r, inner, new, after = kept[t]
            d = np.exp(self.logits(after))
            d[rows, target[t]] -= 1
            d *= (valid[t] / np.float32(total))[:, None]
            grad["o"] += after.T @ d
            grad["b"] += d.sum(axis=0)
            d_after = d @ w["o"].T + d_state
            d_new = d_after * (1 - z) * (1 - new * new)
            d_gates = np.concatenate([d_after * (old - new) * z * (1 - z), d_new * inner * r * (1 - r), d_new], axis=1)
            d_u = d_gates.copy()
            d_u[:, 2 * n :] *= r
            grad["u"] += old.T @ d_u
            # sums by class as one small product
            grad["x"] += (before[t][None, :] == np.arange(CLASSES)[:, None]).astype(np.float32) @ d_gates
            d_state = (d_after * z + d_u @ w["u"].T) * ~fresh[t][:, None]
        return grad, state


def streams(classes: np.ndarray, edges: np.ndarray, most: int):
    """Documents dealt to streams of nearly equal length, longest first.

    Gives, per step and stream, the place of the token, or -1; streams are ordered by
    length, so those still running are always the first ones.
    """
    lengths = np.diff(edges)
    n = max(1, min(most, len(lengths)))
    loads = [(0, s, []) for s in range(n)]
    for doc in np.argsort(-lengths, kind="stable").tolist():
        load, s, docs = heapq.heappop(loads)
        docs.append(doc)
        heapq.heappush(loads, (load + int(lengths[doc]), s, docs))
    loads.sort(key=lambda x: (-x[0], x[1]))
    place = np.full((loads[0][0], n), -1, np.int32)
    for column, (_, _, docs) in enumerate(loads):
        at = 0
        for doc in docs:
            place[at : at + lengths[doc], column] = np.arange(edges[doc], edges[doc + 1])
            at += int(lengths[doc])
    return place


def _with_ends(classes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class sequences with the end after each text, and where they begin."""
    return np.insert(classes, at[1:], 0), at + np.arange(len(at))


def train_on(network: Network, classes: np.ndarray, edges: np.ndarray, moments: dict) -> None:
    """One pass over the documents with Adam, window by window."""
    place = streams(classes, edges, min(STREAMS, max(16, len(classes) // 8192)))
    first = np.zeros(len(classes) + 1, bool)
    first[edges[:-1]] = True
    padded = np.append(classes, 0)
    for begin in range(0, len(place), WINDOW):
        part = place[begin : begin + WINDOW]
        width = int((part[0] >= 0).sum())
        part = part[:, :width]
        if begin == 0:
            state = np.zeros((width, HIDDEN), np.float32)
        valid = part >= 0
        fresh = first[part] & valid
        before = np.where(fresh, 0, padded[part - 1])
        grad, state = network.gradient(before, padded[part], fresh, valid.astype(np.float32), state[:width])
        moments["t"] = t = moments.get("t", 0) + 1
        for k, g in grad.items():
            m = moments[k, 1] = 0.9 * moments.get((k, 1), 0) + 0.1 * g
            v = moments[k, 2] = 0.99 * moments.get((k, 2), 0) + 0.01 * g * g
            network.w[k] -= (RATE / math.sqrt(1 + t / 200) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)).astype(np.float32)


def log_likelihood(network: Network, classes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Natural-log probability of the class sequence of each document."""
    out = np.zeros(len(classes))
    place = streams(classes, edges, 4 * STREAMS)
    first = np.zeros(len(classes), bool)
    first[edges[:-1]] = True
    state = np.zeros((place.shape[1], HIDDEN), np.float32)
    width = place.shape[1]
    for row in place:
        while width and row[width - 1] < 0:
            width -= 1
        at = row[:width]
        fresh = first[at]
        old = state[:width] * ~fresh[:, None]
        state = network.step(np.where(fresh, 0, classes[at - 1]), old)[-1]
        out[at] = network.logits(state)[np.arange(width), classes[at]]
    return np.add.reduceat(out, edges[:-1])


def _gathered(batches, text: int, made):
    """What ``made`` gives of each block of texts, until a partition's share of words is reached.

    Only that is held: the texts and the arrays of their letters go block by block.
    """
    held, size = [], 0
    for piece, texts in blocks(batches, text):
        held.append(made(piece, texts))
        size += sum(len(t or "") for t in texts)
        if size > 6 * MOST_WORDS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _joined(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences of several blocks, each with where its texts begin, as those of one block."""
    shifts = np.cumsum([0, *(len(classes) for classes, _ in held)])
    starts = [at[:-1] + shift for (_, at), shift in zip(held, shifts)]
    return np.concatenate([classes for classes, _ in held]), np.concatenate([*starts, shifts[-1:]])


def _trained(texts: DataFrame, table, weights: dict) -> dict:
    """Average of the copies trained on each partition, by their words."""
    shared = texts.sparkSession.sparkContext.broadcast((table, weights))

    def run(batches):
        frequent, start = shared.value
        network = Network({k: v.copy() for k, v in start.items()})
        moments, words = {}, 0

        def made(_, texts):
            hashes, groups, at = tokens(texts)
            return _with_ends(frequent.look_up(hashes, groups)[1], at)

        for held in _gathered(batches, 0, made):
            classes, edges = _joined(held)
            train_on(network, classes, edges, moments)
            words += len(classes)
        flat = np.concatenate([network.w[k].ravel() for k in sorted(network.w)]).astype(np.float64) * words
        if words:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat) + 1), pa.int32()), pa.array(np.append(flat, float(words)))], names=["i", "v"]
            )

    sums = texts.select("text").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    rows = {row.i: row.v for row in sums.collect()}  # one row per weight
    if not rows:
        return weights
    total, made, at = rows[len(rows) - 1], {}, 0
    for k, shape in sorted((k, v.shape) for k, v in weights.items()):
        size = math.prod(shape)
        made[k] = np.array([rows[i] / total for i in range(at, at + size)], np.float32).reshape(shape)
        at += size
    return made


def _part_score(docs: DataFrame, table, weights: dict) -> DataFrame:
    """Per document: what is known inside a task, and its other words with their numbers."""
    shared = docs.sparkSession.sparkContext.broadcast((table, weights))

    def run(batches):
        frequent, start = shared.value
        network = Network(start)

        def made(piece, texts):
            hashes, groups, at = tokens(texts)
            counts, classes = frequent.look_up(hashes, groups)
            n = np.diff(at)
            met = np.concatenate([[0], np.cumsum(counts > 0)])
            logs = np.concatenate([[0.0], np.cumsum(np.log10(counts + ALPHA))])
            by_class = np.zeros((len(texts), CLASSES), np.int32)
            text_of = np.repeat(np.arange(len(texts)), n)
            np.add.at(by_class, (text_of, classes), 1)
            # other words, once per document
            rare = np.flatnonzero(counts == 0)
            order = rare[np.lexsort((hashes[rare], text_of[rare]))]
            h, d = hashes[order], text_of[order]
            new = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))[: len(order)]
            begin = np.flatnonzero(new)
            times = np.diff(np.append(begin, len(order)))
            offsets = pa.array(np.searchsorted(d[begin], np.arange(len(texts) + 1)), pa.int32())
            columns = [
                # copies, so the batch with its texts is let go
                *piece.select([0, 1, 2]).take(pa.array(np.arange(len(texts)))).columns,
                pa.array(n + 1, pa.int64()),
                pa.array(met[at[1:]] - met[at[:-1]], pa.int64()),
                pa.array(logs[at[1:]] - logs[at[:-1]]),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(0, CLASSES * len(texts) + 1, CLASSES), pa.int32()), pa.array(by_class.ravel())
                ),
                pa.ListArray.from_arrays(offsets, pa.array(h[begin].view(np.int64))),
                pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
            ]
            return _with_ends(classes, at), columns

        for held in _gathered(batches, 3, made):
            ended, edges = _joined([sequences for sequences, _ in held])
            likelihood, done = log_likelihood(network, ended, edges) / math.log(10), 0
            for _, columns in held:
                rows = len(columns[0])
                yield pa.RecordBatch.from_arrays(
                    [*columns[:6], pa.array(likelihood[done : done + rows]), *columns[6:]],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_met", "logs", "network", "by_class", "words", "times"],
                )
                done += rows

    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, n_met long, logs double, network double, "
        "by_class array<int>, words array<long>, times array<int>"
    )
    return docs.select("row", "doc_id", "held_out", "text").mapInArrow(run, schema)


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Scores of all documents by a model of those that are not ``held_out``.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score (smoothed word counts)
    and score, both log10 probabilities of the complete text.
    """
    require(docs, "doc_id", "text")
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    learned = marked.filter("NOT held_out")
    counts = _saved(word_counts(learned), "lm-counts")
    n_texts = learned.count()
    top = counts.orderBy(F.col("n").desc(), "word").limit(FREQUENT).select("word", "n").toArrow()
    frequent = Frequent(top["word"].to_numpy().view(np.uint64), top["n"].to_numpy())
    singles = [(int(w), int(c)) for w, c in zip(frequent.words.view(np.int64), frequent.single, strict=True) if c]
    group = F.col("letters") + F.lit(1 + SINGLES)
    known = F.create_map(*[F.lit(x) for pair in singles for x in pair]) if singles else None
    kind = F.coalesce(F.element_at(known, F.col("word")), group) if singles else group
    sums = counts.groupBy(kind.cast("int").alias("class")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
    of_class = {row["class"]: (row.n, row.v) for row in sums.collect()}  # one row per class
    total = n_texts + sum(n for n, _ in of_class.values())
    distinct = (n_texts > 0) + sum(v for _, v in of_class.values())
    early = F.pmod(F.xxhash64("doc_id", "text"), F.lit(8)) == 0
    frequencies = np.array([n_texts, *(of_class.get(c, (0, 0))[0] for c in range(1, CLASSES))]) + 1.0
    weights = _trained(learned.filter(early), frequent, Network.fresh(frequencies).w)
    weights = _trained(learned.filter(~early), frequent, weights)

    parts = _saved(_part_score(marked.withColumn("row", F.monotonically_increasing_id()), frequent, weights), "lm-parts")
    others = parts.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", "x.words", "x.times")
    found = others.join(counts.select(F.col("word").alias("words"), "n"), "words")
    gained = found.groupBy("row").agg(
        F.sum("times").alias("more_met"),
        F.sum(F.col("times") * (F.log10(F.col("n") + F.lit(ALPHA)) - F.lit(math.log10(ALPHA)))).alias("more_logs"),
    )
    whole = math.log10(total + ALPHA * (distinct + 1))
    widths = [math.log10(n + ALPHA * (v + 1)) for n, v in (of_class.get(c, (0, 0)) for c in range(1, CLASSES))]
    # words in a class of their own still share it with the unseen word
    inner = F.aggregate(
        F.zip_with(F.slice("by_class", 2, CLASSES - 1), F.array(*[F.lit(w) for w in widths]), lambda n, w: n * w),
        F.lit(0.0), lambda a, x: a + x,
    )
    met = parts.join(gained, "row", "left")
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    return met.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_met") + F.coalesce("more_met", F.lit(0)) + F.lit(int(n_texts > 0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (logs + F.lit(math.log10(n_texts + ALPHA)) - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        (F.col("network") + logs - inner).alias("score"),
    )


def fold_of(column: str = "doc_id") -> Column:
    """Every tenth document by crc32 of its id is held out."""
    return fold(column, 10) == 0
