"""Whitening of vectors by the eigenvectors of their covariance.

Entries become integers, ``floor(scale * c) + shift``. One pass takes their exact sums, a
second the scatter of the entries less their rounded means; what rounding left of the
means is taken off in the end. Blocks of rows multiply small integers, whose sums are exact
in doubles below 2**53, so neither the large shift nor the partitions change the scatter.

The scatter, of the size of the dimension squared, is factored on the driver: a Cholesky
factorisation that takes the largest remaining variance first, then one-sided Jacobi
rotations of the columns of its triangular factor until they are orthogonal. The squared
norms of the columns are the eigenvalues and the columns at length 1 the components. A
third pass measures the covariance of the whitened rows.

Defined results: vectors that are NULL, empty or hold a NULL or non-finite entry take no
part; vectors of different lengths, or entries beyond 2**52, raise a ValueError; equal
rows and rows with one id are rows of their own; a NULL id stays; directions without
variance have no component, so equal vectors, or a single one, give no rows; an empty
table gives an empty table; equal eigenvalues come in any order; further columns are kept
by ``whiten``, which gives its own columns a free name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verisift.llm.lets import free_name, require

#: Rows of a block that numpy multiplies at once.
BLOCK = 4096
#: Entries whose sums and differences stay exact.
LARGEST = float(1 << 52)


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: n rows with the integer sums ``sums``, and one column per component."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    scale: float
    shift: int

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if self.trace else self.eigenvalues

    def first(self, most: int) -> Whitening:
        """The same with the first ``most`` components."""
        return Whitening(
            self.n, self.sums, self.eigenvalues[:most], self.components[:, :most], self.trace, self.scale, self.shift
        )


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector has entries, all of them finite numbers."""
    require(vectors, column)
    odd = F.exists(
        F.col(column).cast("array<double>"),
        lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")),
    )
    return vectors.filter(F.coalesce((F.size(column) > 0) & ~odd, F.lit(False)))


def _blocks(batch: pa.RecordBatch, column: int, scale: float) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of whole entries before the shift, with the row they begin at."""
    for at in range(0, batch.num_rows, BLOCK):
        rows = batch.column(column).slice(at, BLOCK)
        widths = set(np.diff(rows.offsets.to_numpy()).tolist())
        if len(widths) > 1:
            raise ValueError(f"vectors of different lengths: {sorted(widths)}")
        scaled = np.floor(rows.flatten().to_numpy(zero_copy_only=False).astype(float) * scale)
        if np.abs(scaled).max(initial=0.0) > LARGEST:
            raise ValueError("an entry is too large for exact sums")
        yield at, scaled.astype(np.int64).reshape(len(rows), -1)


def _sums(vectors: DataFrame, column: str, scale: float, shift: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums of their entries."""

    def of_part(batches):
        n, total = 0, None
        for batch in batches:
            for _, rows in _blocks(batch, 0, scale):
                if total is not None and len(total) != rows.shape[1]:
                    raise ValueError(f"vectors of different lengths: {len(total)}, {rows.shape[1]}")
                n += len(rows)
                # one block fits 64 bits; a partition need not
                total = (0 if total is None else total) + rows.sum(axis=0, dtype=np.int64).astype(object)
        if n:
            yield pa.RecordBatch.from_pydict(
                {
                    "n": pa.array([n] * len(total), pa.int64()),
                    "i": pa.array(range(len(total)), pa.int32()),
                    "total": pa.array([str(t) for t in total]),
                }
            )

    found = (
        vectors.select(column)
        .mapInArrow(of_part, "n long, i int, total string")
        .groupBy("i")
        .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .orderBy("i")
        .collect()
    )
    if len({r.n for r in found}) > 1:
        raise ValueError("vectors of different lengths")
    n = found[0].n if found else 0
    return n, [int(r.total) + n * shift for r in found]


def _scatter(vectors: DataFrame, column: str, scale: float, middle: np.ndarray) -> np.ndarray:
    """Sum over rows of the outer product of the entries less ``middle``."""

    def of_part(batches):
        total = np.zeros((len(middle), len(middle)))
        for batch in batches:
            for _, rows in _blocks(batch, 0, scale):
                centred = (rows - middle).astype(float)
                total += centred.T @ centred
        upper = np.triu_indices(len(middle))
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array(upper[0], pa.int32()),
                "j": pa.array(upper[1], pa.int32()),
                "total": pa.array(total[upper]),
            }
        )

    parts = vectors.select(column).mapInArrow(of_part, "i int, j int, total double")
    out = np.zeros((len(middle), len(middle)))
    for i, j, total in parts.groupBy("i", "j").agg(F.sum("total")).collect():
        out[i, j] = out[j, i] = total
    return out


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """``L`` with ``L @ L.T`` equal to the matrix, one column per pivot, largest first.

    Pivots end where the remaining variance is rounding, so ``L`` has as many columns as
    the matrix has rank. Rows are in their original order.
    """
    left = matrix.astype(float).copy()
    size = len(left)
    least = np.finfo(float).eps * size * max(left.diagonal().max(initial=0.0), 0.0)
    columns, open_rows = [], np.ones(size, bool)
    while open_rows.any():
        pivot = int(np.argmax(np.where(open_rows, left.diagonal(), -np.inf)))
        if left[pivot, pivot] <= least:
            break
        column = np.where(open_rows, left[:, pivot], 0.0) / np.sqrt(left[pivot, pivot])
        left -= np.outer(column, column)
        open_rows[pivot] = False
        columns.append(column)
    return np.stack(columns, axis=1) if columns else np.zeros((size, 0))


def _rounds(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of ``size`` columns once, in rounds of pairs without a common column."""
    ring = list(range(size + size % 2))
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[: len(ring) // 2], reversed(ring)) if max(a, b) < size]
        yield np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def orthogonal_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor's columns rotated in pairs until all are orthogonal (one-sided Jacobi)."""
    columns = factor.copy()
    if columns.shape[1] < 2:
        return columns
    rounds = list(_rounds(columns.shape[1]))
    for _ in range(sweeps):
        worst = 0.0
        for a, b in rounds:
            x, y = columns[:, a], columns[:, b]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            cosine = np.abs(xy) / np.sqrt(xx * yy)
            worst = max(worst, float(cosine.max()))
            turn = cosine > np.finfo(float).eps
            if not turn.any():
                continue
            a, b, x, y, xx, yy, xy = a[turn], b[turn], x[:, turn], y[:, turn], xx[turn], yy[turn], xy[turn]
            slope = (yy - xx) / (2.0 * xy)
            tangent = np.where(slope < 0, -1.0, 1.0) / (np.abs(slope) + np.hypot(1.0, slope))
            cos = 1.0 / np.hypot(1.0, tangent)
            columns[:, a], columns[:, b] = cos * (x - tangent * y), cos * (tangent * x + y)
        if worst <= 4 * np.finfo(float).eps * np.sqrt(len(columns)):
            break
    return columns


def fit(vectors: DataFrame, column: str = "embedding", *, scale: float = 64.0, shift: int = 1_000_000) -> Whitening:
    """Fit on every usable row; the covariance has the divisor n."""
    vectors = usable(vectors, column)
    n, sums = _sums(vectors, column, scale, shift)
    if not n:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0, scale, shift)
    # nearest whole mean of the entries before the shift, and n times what is left of it
    plain = [s - n * shift for s in sums]
    middle = [(2 * s + n) // (2 * n) for s in plain]
    rest = np.array([float(s - n * m) for s, m in zip(plain, middle)])
    scatter = _scatter(vectors, column, scale, np.array(middle, np.int64)) - np.outer(rest, rest) / n
    turned = orthogonal_columns(pivoted_cholesky(scatter / n))
    values = (turned * turned).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    parts = turned[:, order] / np.sqrt(values[order])
    return Whitening(n, tuple(sums), values[order], parts, float(np.trace(scatter)) / n, scale, shift)


def _centred(rows: np.ndarray, fitted: Whitening) -> np.ndarray:
    """n times each entry less its sum, as exact integers."""
    sums = np.array([s - fitted.n * fitted.shift for s in fitted.sums], object)
    if float(np.abs(rows).max(initial=0)) * fitted.n + max(abs(s) for s in sums) < LARGEST:
        return rows * fitted.n - sums.astype(np.int64)
    return rows.astype(object) * fitted.n - sums


def whiten(vectors: DataFrame, fitted: Whitening, column: str = "embedding") -> DataFrame:
    """The usable rows with ``whitened`` array<double>, one entry per component, and
    ``deviation`` decimal(38,0), the squared distance from the mean times n squared."""
    vectors = usable(vectors, column)
    named, apart = free_name(vectors, "whitened"), free_name(vectors, "deviation")
    at = vectors.columns.index(column)
    weights = fitted.components / np.sqrt(fitted.eigenvalues)

    def of_part(batches):
        for batch in batches:
            for start, rows in _blocks(batch, at, fitted.scale):
                if rows.shape[1] != len(fitted.sums):
                    raise ValueError(f"a vector of length {rows.shape[1]}, fitted on {len(fitted.sums)}")
                centred = _centred(rows, fitted)
                found = (centred / fitted.n).astype(float) @ weights
                whole = centred.astype(object) if np.abs(centred).max(initial=0) >= 1 << 27 else centred
                squares = (whole * whole).sum(axis=1)
                flat = pa.array(found.ravel())
                edges = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * found.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(start, len(rows)).columns,
                        pa.ListArray.from_arrays(edges, flat),
                        pa.array([str(s) for s in squares]),
                    ],
                    names=[*batch.schema.names, named, apart],
                )

    if not fitted.n:
        empty = {named: F.lit(None).cast("array<double>"), apart: F.lit(None).cast("decimal(38,0)")}
        return vectors.withColumns(empty).filter("false")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    out = vectors.mapInArrow(of_part, f"{kept}, `{named}` array<double>, `{apart}` string")
    return out.withColumn(apart, F.col(apart).cast("decimal(38,0)"))


def identity_error(vectors: DataFrame, fitted: Whitening, column: str = "embedding") -> float:
    """Largest absolute entry of the measured covariance of the whitened rows less the identity."""
    size = len(fitted.eigenvalues)
    if not fitted.n or not size:
        return 0.0

    def of_part(batches):
        total, product = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                found = batch.column(0).slice(at, BLOCK).flatten().to_numpy().reshape(-1, size)
                total += found.sum(axis=0)
                product += found.T @ found
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array([*i, *range(size)], pa.int32()),
                "j": pa.array([*j, *[-1] * size], pa.int32()),
                "total": pa.array([*product[i, j], *total]),
            }
        )

    done = whiten(vectors.select(column), fitted, column).select("whitened")
    found = done.mapInArrow(of_part, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("t"))
    cells = {(r.i, r.j): r.t / fitted.n for r in found.collect()}
    return max(
        abs(v - cells[i, -1] * cells[j, -1] - (i == j)) for (i, j), v in cells.items() if j >= 0
    )
