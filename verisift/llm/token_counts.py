"""Token counts of every prefix, for a word-end BPE vocabulary.

For a word, the encoding of each prefix ends in one token, and what stands before it is
the encoding of a shorter prefix. So one pass keeps the last token and the count of every
prefix, as a word that goes on and as a word that ends there. Per text, the counts at the
ends of its words are added up. The stored sums answer how many tokens a prefix has and
where a budget ends, without encoding again.

Prefixes are those of the normalised text (NFC, lower case, single blanks), on which the
vocabulary works. Lower case is per character, so a capital sigma always becomes U+03C3.

Edge cases: NULL and empty texts have no tokens; long words cost time in proportion to
their length; repeated rows are counted one by one; an empty table gives an empty table;
a NULL ``doc_id`` is carried; columns not named in ``keep`` are dropped.
"""

from __future__ import annotations

import bisect
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from verisift.llm.byte_bpe import MOST_BYTES, MOST_WORDS, SLICE_ROWS
from verisift.llm.lets import require
from verisift.llm.merge_order import MergeOrder, PrefixAutomaton

# Capital letters of later Unicode versions than Python's, with their small ones.
_LATER = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B}
_LATER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
_IS_LATER = re.compile(f"[{''.join(map(chr, _LATER))}]")


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies: bytes that print
    stand for themselves, the others follow from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter:
    """Counts for one vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], _byte_letters()
        end = model["end_of_word_suffix"]

        def raw(token: str) -> tuple[bytes, bool]:
            closed = token.endswith(end) and token != end
            return bytes(letters[c] for c in (token[: -len(end)] if closed else token)), closed

        vocabulary = model["vocab"]
        specials = [t["content"] for t in spec["added_tokens"]]
        self._text = {i: raw(t) for t, i in vocabulary.items() if t not in specials}
        self._open = {text: i for i, (text, closed) in self._text.items() if not closed}
        self._closed = {text: i for i, (text, closed) in self._text.items() if closed}
        merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            merges[vocabulary[a], vocabulary[b]] = (rank, vocabulary[a + b])

        def symbols(token: int) -> list[int]:
            text, closed = self._text[token]
            single = [self._open[bytes((c,))] for c in text]
            return [*single[:-1], self._closed[text[-1:]]] if closed else single

        order = MergeOrder(lambda a, b: merges.get((a, b)), symbols)
        self._machine = PrefixAutomaton(self._open, order, self._closed)
        self._length = {i: len(text) for i, (text, _) in self._text.items()}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._find, self._words_in = regex.compile(split).finditer, regex.compile(split).findall
        self._special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self._specials = set(specials)
        self._words: dict[str, int] = {}
        self._held = 0

    def _counts(self, piece: bytes) -> tuple[list[int], list[int]]:
        """For each prefix of a piece: its tokens if the word goes on, and if it ends there."""
        machine, length = self._machine, self._length
        if machine.full():
            machine.reset()
        state, going, ended = machine.start, [0], [0]
        for at, byte in enumerate(piece, 1):
            step = state << 8 | byte
            token = machine.last_steps.get(step)
            if token is None:
                token = machine.make_last(state, byte)
            ended.append(going[at - length[token]] + 1)
            found = machine.steps.get(step)
            if found is None:
                found = machine.make_step(state, byte)
            going.append(going[at - length[found & 0xFFFFF]] + 1)
            state = found >> 20
        return going, ended

    def prefixes(self, word: str) -> list[int]:
        """Tokens of each prefix of a word, by characters, each taken as a whole word."""
        ended = self._counts(word.encode("utf-8"))[1]
        out, at = [0], 0
        for letter in word:
            at += len(letter.encode("utf-8"))
            out.append(ended[at])
        return out

    def word(self, word: str) -> int:
        """Tokens of a whole word: the counts of its prefixes, closed at the end only."""
        machine, length = self._machine, self._length
        if machine.full():
            machine.reset()
        piece = word.encode("utf-8")
        steps, make = machine.steps.get, machine.make_step
        state, counts, at = machine.start, [0], 0
        for byte in piece[:-1]:
            at += 1
            found = steps(state << 8 | byte)
            if found is None:
                found = make(state, byte)
            counts.append(counts[at - length[found & 0xFFFFF]] + 1)
            state = found >> 20
        token = machine.last_steps.get(state << 8 | piece[-1])
        if token is None:
            token = machine.make_last(state, piece[-1])
        return counts[at + 1 - length[token]] + 1

    def _segments(self, text: str) -> list[str]:
        """Ordinary stretches and special strings; only the latter stay as they are."""
        return [s for s in self._special.split(text) if s] if self._special else [text]

    @staticmethod
    def _plain(text: str) -> str:
        plain = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return (plain.translate(_LATER) if _IS_LATER.search(plain) else plain).lower()

    def normalised(self, text: str) -> str:
        return "".join(
            s if s in self._specials else regex.sub(r"\s+", " ", self._plain(s)) for s in self._segments(text)
        )

    def sums(self, text: str | None) -> np.ndarray:
        """Tokens up to the end of each word or special string, in order."""
        known, steps = self._words, []
        if len(known) > MOST_WORDS or self._held > MOST_BYTES:
            known.clear()
            self._held = 0
        for segment in self._segments(text or ""):
            if segment in self._specials:
                steps.append(1)
                continue
            words = self._words_in(self._plain(segment))
            for word in set(words).difference(known):
                known[word] = self.word(word)
                self._held += len(word)
            steps.extend(map(known.__getitem__, words))
        return np.cumsum(steps, dtype=np.int32)

    def _pieces(self, text: str) -> list[tuple[int, int, bool]]:
        """Start, end and special mark of the words of a normalised text."""
        at, out = 0, []
        for segment in self._segments(text):
            if segment in self._specials:
                out.append((at, at + len(segment), True))
            else:
                out += [(at + m.start(), at + m.end(), False) for m in self._find(segment)]
            at += len(segment)
        return out

    def tokens_at(self, text: str, sums: list[int], length: int) -> int:
        """Tokens of the first ``length`` characters of a normalised text."""
        pieces = self._pieces(text)
        whole = bisect.bisect_right([end for _, end, _ in pieces], length)
        base = int(sums[whole - 1]) if whole else 0
        if whole == len(pieces) or pieces[whole][0] >= length:
            return base
        rest = text[pieces[whole][0] : length]
        return base + sum(self.prefixes(m[0])[-1] for m in self._find(rest))

    def fitting(self, text: str, sums: list[int], budget: int) -> int:
        """Characters of the longest prefix that ends with a word and has at most ``budget`` tokens."""
        whole = bisect.bisect_right(sums, budget)
        pieces = self._pieces(text)
        return len(text) if whole == len(pieces) else pieces[whole - 1][1] if whole else 0


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter per worker process and vocabulary."""
    if path not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def _mapped(df: DataFrame, keep: list[str], inputs: list[str], added: list[tuple[str, T.DataType]], make) -> DataFrame:
    require(df, *keep, *inputs)
    clash = {name for name, _ in added} & set(keep)
    if clash:
        raise ValueError(f"rename or drop first: {sorted(clash)}")
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, t) for n, t in added])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(at, SLICE_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[: len(keep)], *make(*piece.columns[len(keep) :])],
                    names=[*keep, *(name for name, _ in added)],
                )

    picked = [f"`{c}`" for c in keep] + [df[c].alias(f"_in_{i}_") for i, c in enumerate(inputs)]
    return df.select(*picked).mapInArrow(run, schema)


def prefix_store(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: doc_id), ``n_tokens`` and ``sums``, the running counts at
    the ends of the words of each text."""

    def make(texts: pa.Array) -> list[pa.Array]:
        own = counter(path)
        sums = [own.sums(t.as_py()) for t in texts]
        starts = np.cumsum([0, *map(len, sums)], dtype=np.int64)
        flat = np.concatenate([np.zeros(0, np.int32), *sums])
        return [
            pa.array([int(s[-1]) if len(s) else 0 for s in sums], pa.int64()),
            pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat, pa.int32())),
        ]

    added = [("n_tokens", T.LongType()), ("sums", T.ArrayType(T.IntegerType()))]
    return _mapped(docs, ["doc_id"] if keep is None else keep, ["text"], added, make)


def truncate(docs: DataFrame, stored: DataFrame, path: str, budget: int) -> DataFrame:
    """doc_id, ``prefix`` (normalised text within the budget, ending with a word) and its
    ``n_tokens``, from stored sums; ``doc_id`` must be unique."""

    def make(texts: pa.Array, sums: pa.Array) -> list[pa.Array]:
        own = counter(path)
        cut, counts = [], []
        for text, known in zip(texts.to_pylist(), sums.to_pylist(), strict=True):
            plain = own.normalised(text or "")
            cut.append(plain[: own.fitting(plain, known, budget)])
            whole = bisect.bisect_right(known, budget)
            counts.append(known[whole - 1] if whole else 0)
        return [pa.array(cut, pa.string()), pa.array(counts, pa.int64())]

    joined = docs.select("doc_id", "text").join(stored.select("doc_id", "sums"), "doc_id")
    added = [("prefix", T.StringType()), ("n_tokens", T.LongType())]
    return _mapped(joined, ["doc_id"], ["text", "sums"], added, make)
