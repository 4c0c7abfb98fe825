"""Byte-level BPE as a finite-state transducer, and streaming decoding.

While bytes are read, several readings are open: every start of a token that the bytes
since then may still complete, with the token before it. A state is that set of readings;
a transition reads one byte and closes the one reading that ends here (the pairwise rule
of ``merge_order`` picks it). Tokens that all open readings share are final and leave, at
the latest after ``LOOKAHEAD`` bytes and the longest token. States and transitions are
made when first needed and kept, up to a limit that only costs time.

Decoding runs in pieces; a UTF-8 state machine holds back the bytes of an unfinished
character between pieces.

Edge cases: NULL and empty texts encode to no tokens and decode to an empty text; a very
long piece takes time in proportion to its length; repeated rows are encoded one by one;
an empty table gives an empty table; a NULL ``doc_id`` and further columns are carried;
clashing names get underscores from the caller's choice of ``keep``.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from verisift.llm.lets import require
from verisift.llm.merge_order import MOST_PAIRS, MergeOrder, PrefixAutomaton

#: Memory limits of one worker; reaching one empties that memory.
MOST_WORDS = 300_000
MOST_BYTES = 1 << 24


class Limits(NamedTuple):
    """Memory limits of one codec: words, which leave in two turns, their bytes, pairs and steps."""

    words: int = MOST_WORDS
    size: int = MOST_BYTES
    pairs: int = MOST_PAIRS
    steps: int = 350_000


#: For a worker beside an executor whose heap is in use; it takes more time.
NARROW = Limits(100_000, 1 << 23, 1 << 16, 150_000)
#: Bytes read before the tokens shared by all open readings leave.
LOOKAHEAD = 512
#: Rows and, but for single long texts, bytes handled between two outputs; tokens decoded at a time.
SLICE_ROWS = 256
SLICE_BYTES = 1 << 20
PIECE = 1 << 14


class Transducer:
    """Bytes in, token ids out."""

    def __init__(self, ranks: dict[bytes, int], limits: Limits = Limits()):
        self.text_of = {rank: token for token, rank in ranks.items()}

        def merge(a: int, b: int):
            rank = ranks.get(self.text_of[a] + self.text_of[b])
            return None if rank is None else (rank, rank)

        order = MergeOrder(merge, lambda token: [ranks[bytes((c,))] for c in self.text_of[token]], limits.pairs)
        self._machine = PrefixAutomaton(ranks, order, most=limits.steps)
        self._length = {rank: len(token) for token, rank in ranks.items()}

    def _back(self, ends: list[int], at: int, until: int) -> list[int]:
        out, length = [], self._length
        while at > until:
            token = ends[at - 1]
            out.append(token)
            at -= length[token]
        out.reverse()
        return out

    def _shared(self, ends: list[int], state: int, at: int) -> int:
        """The end of the tokens that all open readings have in common."""
        starts = set(self._machine.open_starts(state, at))
        while len(starts) > 1:
            last = max(starts)
            starts.remove(last)
            starts.add(last - self._length[ends[last - 1]])
        return starts.pop()

    def encode(self, piece: bytes) -> list[int]:
        machine = self._machine
        if machine.full():
            machine.reset()
        if len(piece) <= LOOKAHEAD:
            return self._back(ends := self._read(piece, machine.start)[0], len(ends), 0)
        out: list[int] = []
        ends: list[int] = []
        state = machine.start
        for at in range(0, len(piece), LOOKAHEAD):
            if machine.full():
                state = machine.rebuilt(state)
            more, state = self._read(piece[at : at + LOOKAHEAD], state)
            ends += more
            done = self._shared(ends, state, len(ends))
            out += self._back(ends, done, 0)
            del ends[:done]
        return out + self._back(ends, len(ends), 0)

    def _read(self, piece: bytes, state: int) -> tuple[list[int], int]:
        """The last token of each prefix, and the state after it."""
        ends, steps, make = [], self._machine.steps.get, self._machine.make_step
        for byte in piece:
            found = steps(state << 8 | byte)
            if found is None:
                found = make(state, byte)
            ends.append(found & 0xFFFFF)
            state = found >> 20
        return ends, state


class Utf8Machine:
    """Incremental UTF-8: ``feed`` gives the finished characters and keeps the rest."""

    def __init__(self):
        self._rest = b""

    def feed(self, data: bytes, last: bool = False) -> str:
        data = self._rest + data
        cut = len(data)
        # only the last three bytes can belong to an unfinished character
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                needs = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                if needs > back:
                    cut -= back
                break
            if byte < 0x80:
                break
        if last:
            cut = len(data)
        self._rest = data[cut:]
        return data[:cut].decode("utf-8", errors="replace")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Texts to packed ids (little-endian unsigned 32 bit) and back."""

    def __init__(self, path: str, pattern: str, limits: Limits = Limits()):
        ranks = read_ranks(path)
        self._machine, self._limits = Transducer(ranks, limits), limits
        self._find = regex.compile(pattern).findall
        #: words met since the last turn, and those met in the turn before
        self._words: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._held = 0
        self._bytes = self._machine.text_of

    def encode(self, text: str | None) -> bytes:
        found = self._find(text or "")
        if len(self._words) > self._limits.words // 2 or self._held > self._limits.size // 2:
            # words still in use come back from the turn before, the others go with it
            self._older, self._words, self._held = self._words, {}, 0
        words, older = self._words, self._older
        for word in set(found).difference(words):
            packed = older.get(word)
            if packed is None:
                ids = self._machine.encode(word.encode("utf-8"))
                packed = struct.pack(f"<{len(ids)}I", *ids)
            words[word] = packed
            self._held += len(word)
        return b"".join(map(words.__getitem__, found))

    def decode(self, packed: bytes | None) -> str:
        machine, view, out = Utf8Machine(), memoryview(packed or b"").cast("I"), []
        for at in range(0, len(view), PIECE):
            out.append(machine.feed(b"".join(map(self._bytes.__getitem__, view[at : at + PIECE]))))
        return "".join(out) + machine.feed(b"", last=True)


_CODECS: dict[tuple[str, str, Limits], Codec] = {}


def codec(path: str, pattern: str, limits: Limits = Limits()) -> Codec:
    """One codec per worker process and vocabulary."""
    key = (path, pattern, limits)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(*key)
    return _CODECS[key]


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``SLICE_ROWS`` rows and ``SLICE_BYTES`` bytes of the last column."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            most = SLICE_BYTES + (ends[at - 1] if at else 0)
            rows = min(SLICE_ROWS, max(1, int(np.searchsorted(ends, most, side="right")) - at))
            yield batch.slice(at, rows)
            at += rows


def _run(df: DataFrame, keep: list[str], make, added: list[tuple[str, T.DataType]], source: str) -> DataFrame:
    """Carry ``keep`` and add columns made from the values of ``source``, a slice at a time."""
    clash = {name for name, _ in added} & set(keep)
    if clash:
        raise ValueError(f"rename or drop first: {sorted(clash)}")
    require(df, source, *keep)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, t) for n, t in added])

    def run(batches):
        for piece in _slices(batches):
            made = make(piece.column(piece.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:-1], *made], names=[*keep, *(name for name, _ in added)]
            )

    return df.select(*[f"`{c}`" for c in keep], df[source].alias("_from_")).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) and ``token_ids``, packed little-endian."""

    def make(texts: pa.Array) -> list[pa.Array]:
        own = codec(path, pattern)
        return [pa.array([own.encode(t.as_py()) for t in texts], pa.binary())]

    keep = docs.columns if keep is None else keep
    return _run(docs, keep, make, [("token_ids", T.BinaryType())], "text")


def decode(encoded: DataFrame, path: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the ids) and ``decoded``, the text of the ids."""

    def make(ids: pa.Array) -> list[pa.Array]:
        own = codec(path, pattern)
        return [pa.array([own.decode(i.as_py()) for i in ids], pa.string())]

    keep = [c for c in encoded.columns if c != "token_ids"] if keep is None else keep
    return _run(encoded, keep, make, [("decoded", T.StringType())], "token_ids")


def transcode(docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """``encode`` and ``decode`` in one pass over the texts: token_ids and decoded."""

    def make(texts: pa.Array) -> list[pa.Array]:
        own = codec(path, pattern)
        ids = [own.encode(t.as_py()) for t in texts]
        return [pa.array(ids, pa.binary()), pa.array([own.decode(i) for i in ids], pa.string())]

    keep = docs.columns if keep is None else keep
    return _run(docs, keep, make, [("token_ids", T.BinaryType()), ("decoded", T.StringType())], "text")


def round_trip(docs: DataFrame, path: str, pattern: str, keep: list[str]) -> DataFrame:
    """``encode``, and ``round_trip``: whether the ids decode to the text (NULL: the empty text).

    The decoded text is compared where it is made; neither text leaves the worker, which keeps
    to the narrow limits.
    """

    def make(texts: pa.Array) -> list[pa.Array]:
        own, ids, same = codec(path, pattern, NARROW), [], []
        for text in texts:
            text = text.as_py() or ""
            ids.append(own.encode(text))
            same.append(own.decode(ids[-1]) == text)
        return [pa.array(ids, pa.binary()), pa.array(same, pa.bool_())]

    return _run(docs, keep, make, [("token_ids", T.BinaryType()), ("round_trip", T.BooleanType())], "text")
