"""The trie of all conversation prefixes, by union-find over sorted neighbours.

A conversation is the sequence of the prints of its turns. Equal sequences fold to one row
with their number, so a conversation that is copied often is one row. The rows are sorted
and dealt by ranges. Neighbours with ``l`` common leading turns are an edge of depth ``l``;
inside a range a union-find takes the edges from the deepest up. Before two components
merge, each is raised to the depth below the edge, which finishes the nodes without a
branch that it passes; the merge makes the branching node, or adds a branch to it.

A node can continue in another range only if the first or the last row of its range runs
through it. Such nodes stay open: a range is contracted to these two rows, with what each of
their nodes has gathered (members, closed children, leaves and tokens below), and the rows
of many ranges in order are merged by the same union-find, until one group is left. What a
group closes is written as it is; names of parents that were still open are looked up by
range and node in the end.

The digest of the ids that end in a node runs through them in order; long lists are joined to
pieces in sorted ranges first, and the pieces are read as a stream, one node after the other.

Defined results: NULL role or text is empty; turns without a number come first, turns with
one number in the order of a print of role and text, equal turns repeat; rows without a
``conv_id`` belong to no conversation and take no part; a conversation rebuilt to nothing
is a member of the root only; an empty table gives an empty table; further columns are
dropped. The prints of one conversation's turns, 16 bytes each, must fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verisift.llm.lets import require
from verisift.session import scratch_path

#: Sequences of a range and turns in them, about, and ranges whose contracted rows are merged at once.
RANGE_ROWS, RANGE_TURNS, MERGED = 20_000, 200_000, 64
#: Characters of a piece of ids.
PIECE = 1 << 16
NOBODY = hashlib.sha256(b"").hexdigest()
_HIGHEST = np.iinfo(np.int64).max

#: A node: the smallest and the number of its members, what is in and below it, its print (where
#: rows carry prints), and its parent, by smallest member if closed or else by print.
NODE = [
    ("low", "long"), ("depth", "long"), ("members", "long"), ("children", "long"), ("leaves", "long"), ("saved", "long"),
    ("ends", "string"), ("print", "binary"), ("parent_low", "long"), ("parent_print", "binary"),
]
#: A row to merge on: keys, and by depth from 0 the prints and what the nodes have gathered.
PATH = [
    ("keys", "array<binary>"), ("prints", "array<binary>"), ("words", "array<long>"), ("lows", "array<long>"),
    ("members_at", "array<long>"), ("children_at", "array<long>"), ("leaves_at", "array<long>"), ("saved_at", "array<long>"),
    ("ends_at", "array<string>"),
]
OUT = [("part", "long"), ("side", "int"), *NODE, *PATH]
OUT_DDL = ", ".join(f"{name} {kind}" for name, kind in OUT)
_TYPES = {
    "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary()),
    "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
}
_ARROW = pa.schema([(name, _TYPES[kind]) for name, kind in OUT])


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def sequences(turns: DataFrame, *, block: int = 20) -> DataFrame:
    """One row per rebuilt conversation: conv_id, keys (prints of its turns) and words.

    Conversation ``c`` begins with the first ``h`` turns of conversation ``c - c % block`` and goes
    on with its own turns after its first ``h``; ``h`` is the crc32 of its decimal id, modulo 4.
    """
    require(turns, "conv_id", "turn", "role", "text")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    printed = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("numbered"),
            "turn",
            F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        ).alias("turn"),
    )
    told = printed.groupBy("conv_id").agg(
        F.transform(F.sort_array(F.collect_list("turn")), lambda t: F.struct(t["key"].alias("key"), t["words"].alias("words"))).alias(
            "turns"
        )
    )
    told = _saved(told, "trie-turns")
    base = told.filter(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("opening")
    )
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    known = told.withColumns({"base": F.col("conv_id") - F.col("conv_id") % block, "h": taken}).join(base, "base", "left")
    opening = F.coalesce("opening", F.array().cast(told.schema["turns"].dataType))
    whole = F.concat(
        F.slice(opening, F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.size("turns")),
    )
    return known.select("conv_id", whole.alias("turns")).select(
        "conv_id", F.col("turns.key").alias("keys"), F.col("turns.words").alias("words")
    )


def _name(keys: Column) -> Column:
    """The print of a whole sequence."""
    return F.md5(F.array_join(F.transform(keys, lambda k: F.hex(k)), ","))


def _pieces(ids: DataFrame) -> DataFrame:
    """(name, first, piece): the ascending ids of each name, joined to pieces.

    The ids are dealt by ranges of name and id, so one name's ids spread over many tasks.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[str, int, str]] = []
        name, first, held, size = None, 0, [], 0

        def close():
            if held:
                done.append((name, first, ",".join(held)))

        def batch_of(rows):
            columns = list(zip(*rows)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                names=["name", "first", "piece"],
            )

        for batch in batches:
            for new, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if new != name or size > PIECE:
                    close()
                    name, first, held, size = new, conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
            if len(done) > 4096:
                yield batch_of(done)
                done.clear()
        close()
        yield batch_of(done)

    parts = max(1, -(-ids.count() // (4 * RANGE_ROWS)))
    dealt = ids.repartitionByRange(parts, "name", "conv_id").sortWithinPartitions("name", "conv_id")
    return dealt.mapInArrow(join, "name string, first long, piece string")


def _digests(ids: DataFrame) -> DataFrame:
    """(name, ends): the SHA-256 of each name's ids, ascending, with commas between."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, ends = [], []
        name, running = None, None
        for batch in batches:
            for new, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if new != name:
                    if running is not None:
                        names.append(name)
                        ends.append(running.hexdigest())
                    name, running = new, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(piece.encode())
        if running is not None:
            names.append(name)
            ends.append(running.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ends, pa.string())], names=["name", "ends"])

    sorted_pieces = _pieces(ids).repartition("name").sortWithinPartitions("name", "first").select("name", "piece")
    return sorted_pieces.mapInArrow(digest, "name string, ends string")


def folded(convs: DataFrame) -> DataFrame:
    """One row per distinct sequence: keys, words, members, low (the smallest id) and ends."""
    named = _saved(convs.withColumn("name", _name(F.col("keys"))), "trie-convs")
    rows = named.groupBy("name").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct("conv_id", "keys", "words")).alias("first")
    )
    return rows.join(_digests(named.select("name", "conv_id")), "name").select(
        F.col("first.keys").alias("keys"), F.col("first.words").alias("words"), "members", F.col("first.conv_id").alias("low"), "ends"
    )


class _Row:
    """A sorted row: its keys, prints (None until needed) and words by depth, what it brings to
    each node on its way (``sums``: members, children, leaves, saved; ``low``) and ``ends``."""

    __slots__ = ("keys", "prints", "words", "sums", "low", "ends")

    def __init__(self, keys, prints, words, sums, low, ends):
        self.keys, self.prints, self.words, self.sums, self.low, self.ends = keys, prints, words, sums, low, ends

    def blank(self) -> _Row:
        """The same way without anything gathered."""
        size = len(self.keys) + 1
        return _Row(self.keys, self.prints, self.words, np.zeros((4, size), np.int64), np.full(size, _HIGHEST), {})


class _Component:
    """Rows joined by the union-find, raised to the node at depth ``at``.

    Besides what its rows bring along, that node has gathered ``children`` closed children, the
    nodes ``below``, with ``leaves`` and ``saved`` tokens.
    """

    __slots__ = ("at", "prints", "words", "sums", "low", "ends", "below", "children", "leaves", "saved", "first", "last")

    def __init__(self, row: _Row, first: bool, last: bool):
        self.at, self.prints, self.words = len(row.keys), row.prints, row.words
        self.sums, self.low, self.ends = row.sums, row.low, dict(row.ends)
        self.below: list[int] = []
        self.children = self.leaves = self.saved = 0
        self.first, self.last = first, last

    def take(self, other: _Component) -> None:
        """Join a component that stands at the same node."""
        upto = self.at + 1
        self.sums = self.sums[:, :upto] + other.sums[:, :upto]
        self.low = np.minimum(self.low[:upto], other.low[:upto])
        self.ends.update(other.ends)
        self.below.extend(other.below)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.first, self.last = self.first or other.first, self.last or other.last


def _common(a: list[bytes], b: list[bytes]) -> int:
    """How many leading keys two sequences share."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _prints(keys: list[bytes]) -> list[bytes]:
    """A print of every prefix of the sequence, the empty one included."""
    out = [b""]
    for key in keys:
        out.append(hashlib.blake2b(out[-1] + key, digest_size=16).digest())
    return out


class Forest:
    """The nodes of sorted rows. ``nodes`` are closed, in the order of ``NODE``; ``kept`` the
    contracted first and last row with the open nodes, none if the rows are ``whole``."""

    def __init__(self, rows: list[_Row], whole: bool):
        self.nodes: list[list] = []
        ways = rows[:1] + rows[1:][-1:]
        for row in ways:
            row.prints = row.prints or _prints(row.keys)
        self.kept = [] if whole else [row.blank() for row in ways]
        if rows:
            self._join(rows)

    def _join(self, rows: list[_Row]) -> None:
        parts = [_Component(r, i == 0, i == len(rows) - 1) for i, r in enumerate(rows)]
        boss = list(range(len(rows)))

        def find(i: int) -> int:
            while boss[i] != i:
                boss[i] = boss[boss[i]]
                i = boss[i]
            return i

        edges = [_common(a.keys, b.keys) for a, b in zip(rows, rows[1:])]
        for i in sorted(range(len(edges)), key=lambda i: -edges[i]):
            a, b = find(i), find(i + 1)
            for part in (parts[a], parts[b]):
                while part.at > edges[i]:
                    self._finish(part)
            if len(parts[a].below) < len(parts[b].below):
                a, b = b, a
            parts[a].take(parts[b])
            parts[b], boss[b] = None, a
        part = parts[find(0)]
        while part.at >= 0:
            self._finish(part)

    def _finish(self, part: _Component) -> None:
        """Close the component's node at its depth, or keep it open, and go up one."""
        d = part.at
        members, children, leaves, saved = (int(v) for v in part.sums[:, d])
        children, leaves, saved = children + part.children, leaves + part.leaves, saved + part.saved
        low, ends = int(part.low[d]), part.ends.pop(d, None)
        if self.kept and (part.first or part.last):
            # a node on both ways stays with the first row
            row = self.kept[0 if part.first else -1]
            row.sums[:, d] = members, children, leaves, saved
            row.low[d] = low
            if ends:
                row.ends[d] = ends
            for child in part.below:
                self.nodes[child][9] = row.prints[d]
            part.below, part.children, part.leaves, part.saved = [], 0, 0, 0
        else:
            leaves = leaves if children else 1
            saved += (members - 1) * int(part.words[d])
            for child in part.below:
                self.nodes[child][8] = low
            name = part.prints[d] if part.prints else None
            self.nodes.append([low, d, members, children, leaves, saved, ends or NOBODY, name, None, None])
            part.below, part.children, part.leaves, part.saved = [len(self.nodes) - 1], 1, leaves, saved
        part.at -= 1

    def table(self, part: int) -> pa.Table:
        """The rows of ``OUT``."""
        columns: dict[str, list] = {name: [] for name, _ in OUT}
        for node in self.nodes:
            for (name, _), value in zip(NODE, node):
                columns[name].append(value)
        gaps = [None] * len(self.nodes)
        for name, _ in [("side", None), *PATH]:
            columns[name].extend(gaps)
        for side, row in enumerate(self.kept):
            ends = [row.ends.get(d) for d in range(len(row.keys) + 1)]
            values = [row.keys, row.prints, [int(w) for w in row.words], row.low.tolist(), *row.sums.tolist(), ends]
            for (name, _), value in zip([("side", None), *PATH], [side, *values]):
                columns[name].append(value)
            for name, _ in NODE:
                columns[name].append(None)
        columns["part"] = [part] * len(columns["side"])
        return pa.table(columns, schema=_ARROW)


def _range_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of one sorted range of ``folded`` rows."""
    rows = []
    for batch in batches:
        for row in batch.to_pylist():
            size = len(row["keys"]) + 1
            sums = np.zeros((4, size), np.int64)
            sums[0] = row["members"]
            low = np.full(size, row["low"], np.int64)
            rows.append(_Row(row["keys"], None, [0, *row["words"]], sums, low, {size - 1: row["ends"]}))
    yield from Forest(rows, False).table(TaskContext.get().partitionId()).to_batches()


def _merged_forest(whole: bool):
    """Merges the contracted rows of neighbouring ranges or groups."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        rows = []
        for row in sorted(table.to_pylist(), key=lambda r: (r["part"], r["side"])):
            sums = np.array([row[c] for c in ("members_at", "children_at", "leaves_at", "saved_at")], np.int64)
            ends = {d: e for d, e in enumerate(row["ends_at"]) if e}
            rows.append(_Row(row["keys"], row["prints"], row["words"], sums, np.array(row["lows"], np.int64), ends))
        return Forest(rows, whole).table(key[0].as_py())

    return merge


def nodes(turns: DataFrame, *, block: int = 20) -> DataFrame:
    """Every node of the trie of the rebuilt conversations: conv_id (its smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = _saved(folded(sequences(turns, block=block)), "trie-rows")
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("keys")), F.lit(0)).alias("turns")).first()
    parts = max(1, -(-size["rows"] // RANGE_ROWS), -(-size["turns"] // RANGE_TURNS))
    dealt = rows.repartitionByRange(parts, "keys").sortWithinPartitions("keys")
    level = _saved(dealt.mapInArrow(_range_forest, OUT_DDL), "trie-forest")
    names = [name for name, _ in NODE]
    closed, open_nodes, resolved, step = [], [], [], 0
    while True:
        number = F.lit(step).alias("step")
        closed.append(level.filter("side IS NULL").select(number, "part", *names))
        if step:
            resolved.append(level.filter("side IS NULL").select("print", F.col("low").alias("found")))
        paths = level.filter("side IS NOT NULL").select("part", "side", *[name for name, _ in PATH])
        groups = paths.agg(F.max(F.floor(F.col("part") / MERGED))).first()[0]
        if groups is None:
            break
        open_nodes.append(paths.select(number, "part", F.explode("prints").alias("print")).distinct())
        grouped = paths.withColumn("group", F.floor(F.col("part") / MERGED)).groupBy("group")
        level = _saved(grouped.applyInArrow(_merged_forest(groups == 0), OUT_DDL), "trie-forest")
        step += 1

    def all_of(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out

    every = all_of(closed)
    if open_nodes:
        # looked up by range and print: the children of a node in many ranges do not meet
        names_of = all_of(open_nodes).join(all_of(resolved), "print").withColumnRenamed("print", "parent_print")
        every = every.join(names_of, ["step", "part", "parent_print"], "left")
    else:
        every = every.withColumn("found", F.lit(None).cast("long"))
    return every.select(
        F.col("low").alias("conv_id"),
        "depth",
        F.coalesce("parent_low", "found").alias("parent_conv_id"),
        F.col("members").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )
