"""Language by nearest centroid.

A text becomes counts of its letter n-grams (one to three letters, lower case, one blank
for anything else) in 8,192 hashed cells, weighted by inverse document frequency over all
training documents and scaled to length one. Each language has several centroids, the
clusters of a sample of its training documents. The nearest centroid by cosine names the
language; a text further from it than the training texts of that language is rejected.

The clusters are fitted on about ``SAMPLE`` documents per language, chosen by a hash of
their id; everything else covers all documents.

Edge cases: NULL texts and texts without letters are ``und`` with score 0; documents without
``lang`` are not learned from; without any training document everything is ``und``; repeated
rows count as often as they occur; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verisift.llm.lets import require
from verisift.llm.word_hash import blocks, mixed

CELLS = 1 << 13
SAMPLE = 600
CLUSTERS = 4
UNKNOWN = "und"
#: Share of the least similarity of a language's sample below which a text is rejected.
SLACK = 0.8
_LETTER = np.zeros(0x110000, bool)


def _letters() -> np.ndarray:
    if not _LETTER[97]:
        _LETTER[:] = np.fromiter((chr(i).isalpha() for i in range(len(_LETTER))), bool, len(_LETTER))
    return _LETTER


def cells(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text, or None without letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    # one blank for each stretch of other characters
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    marks = np.where(letter, codes, 32)[keep].astype(np.uint64)
    marks = np.concatenate([np.array([32], np.uint64), marks, np.array([32], np.uint64)])
    out = np.zeros(CELLS, np.int64)
    total = np.zeros(len(marks), np.uint64)
    for width in (1, 2, 3):
        n = len(marks) - width + 1
        if n <= 0:
            break
        total = total[:n] * np.uint64(0x100000001B3) + marks[width - 1 :] + np.uint64(width << 40)
        hashed = mixed(total) >> np.uint64(64 - 13)
        if width == 1:
            hashed = hashed[marks != 32]
        out += np.bincount(hashed.astype(np.int64), minlength=CELLS)
    return out


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighed = np.log1p(counts) * idf
    return (weighed / max(float(np.linalg.norm(weighed)), 1e-12)).astype(np.float32)


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def inverse_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """The weight of each cell from all documents with letters, and their number."""

    def run(batches):
        seen, n = np.zeros(CELLS + 1, np.int64), 0
        for _, texts in blocks(batches, 0):
            for text in texts:
                counts = cells(text)
                if counts is not None:
                    seen[:-1] += counts > 0
                    n += 1
        seen[-1] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CELLS + 1), pa.int32()), pa.array(seen)], names=["cell", "n"])

    total = docs.select("text").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    seen = np.zeros(CELLS + 1)
    for row in total.collect():  # one row per cell
        seen[row.cell] = row.n
    return np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1.0, int(seen[-1])


def _clusters(points: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from the points that are furthest apart."""
    mean = points.mean(axis=0)
    chosen = [int(np.argmax(points @ mean))]
    nearest = points @ points[chosen[0]]
    while len(chosen) < min(k, len(points)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, points @ points[chosen[-1]])
    centres = points[chosen]
    for _ in range(15):
        own = np.argmax(points @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centres)
    return centres


def train(docs: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> tuple[np.ndarray, pd.DataFrame]:
    """Cell weights and centroids from ``docs`` (doc_id, text, lang), all of which may be used."""
    known = docs.filter(F.col("lang").isNotNull())
    idf, _ = inverse_frequency(known)
    # the few counts per language decide how many of its documents the sample takes
    sizes = {row.lang: row.n for row in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return idf, pd.DataFrame({"lang": [], "centre": [], "least": []})
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample / n))])
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("lang")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    chosen = known.filter(draw < F.element_at(share, F.col("lang"))).select("doc_id", "lang", "text")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(["doc_id", "text"])
        made = [c for c in map(cells, ordered["text"]) if c is not None]
        if not made:
            return pd.DataFrame({"lang": [], "centre": [], "least": []})
        points = np.stack([vector(c, idf) for c in made])
        centres = _clusters(points, clusters)
        least = float((points @ centres.T).max(axis=1).min())
        return pd.DataFrame(
            {"lang": group["lang"].iloc[0], "centre": [c.astype(np.float64).tolist() for c in centres], "least": least}
        )

    fitted = chosen.groupBy("lang").applyInPandas(fit, "lang string, centre array<double>, least double").toPandas()
    return idf, fitted.sort_values("lang", kind="stable").reset_index(drop=True)


def predict(docs: DataFrame, idf: np.ndarray, fitted: pd.DataFrame) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every document, from its text alone."""
    require(docs, "doc_id", "text")
    langs, least = fitted["lang"].tolist(), fitted["least"].tolist()
    centres = np.stack([np.asarray(c) for c in fitted["centre"]]).astype(np.float32) if langs else np.zeros((0, CELLS), np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((idf, centres))

    def run(batches):
        weights, known = shared.value
        for piece, texts in blocks(batches, 1):
            made = [cells(t) for t in texts]
            names, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            at = [i for i, c in enumerate(made) if c is not None]
            if at and len(known):
                close = np.stack([vector(made[i], weights) for i in at]) @ known.T
                best = np.argmax(close, axis=1)
                for row, i in enumerate(at):
                    score = float(close[row, best[row]])
                    names[i], scores[i] = langs[best[row]], min(max(score, 0.0), 1.0)
                    rejected[i] = score < SLACK * least[best[row]]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(names), pa.array(scores, pa.float64()), pa.array(rejected)],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean"
    )
