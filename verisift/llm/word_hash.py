"""64-bit hashes of words and of runs of words, a whole text at a time in numpy."""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1
_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = np.random.default_rng(20_240_229).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base, modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 4096)
        grown = np.full(size, _BASE, np.uint64)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """One hash per word of the text; A-Z count as a-z if ``lower``."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if lower:
        data = _LOWER[data]
    inside = ~_GAP[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    return word_hashes_of(data, inside, opens)


def runs_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` neighbouring words, in order."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, power in enumerate(powers(width)):
        total += hashes[i : i + n] * power
    return mixed(total)


def prints(words: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A hash of the words [low, high) for each range, whatever stands around it."""
    n = len(words)
    power = powers(n + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * power[:n], dtype=np.uint64)])
    back = np.uint64(pow(pow(int(_BASE), n, 1 << 64), -1, 1 << 64))
    return mixed((total[high] - total[low]) * power[n - low] * back + (high - low).astype(np.uint64))


def hash_texts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of many texts in a row, and where each text's words begin and end."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    edges = np.cumsum([0, *(len(e) + 1 for e in encoded)])
    blob = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
    inside = ~_GAP[blob]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    at = np.searchsorted(np.flatnonzero(opens), edges)
    return word_hashes_of(blob, inside, opens), at


def word_hashes_of(data: np.ndarray, inside: np.ndarray, opens: np.ndarray) -> np.ndarray:
    if not inside.any():
        return np.zeros(0, np.uint64)
    letters = data[inside]
    starts = np.flatnonzero(opens[inside])
    lengths = np.diff(np.append(starts, len(letters)))
    place = np.arange(len(letters)) - np.repeat(starts, lengths)
    sums = np.add.reduceat(_BYTES[letters] * powers(int(lengths.max()))[place], starts)
    return mixed(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def blocks(batches, text: int, rows: int = 256, most: int = 1 << 22):
    """Slices of record batches with at most ``rows`` rows and, but for single long texts,
    ``most`` characters, each with its list of texts from column number ``text``."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            texts = batch.column(text).slice(at, rows).to_pylist()
            taken, size = 0, 0
            while taken < len(texts) and (not taken or size + len(texts[taken] or "") <= most):
                size += len(texts[taken] or "")
                taken += 1
            yield batch.slice(at, taken), texts[:taken]
            at += taken
