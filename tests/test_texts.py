"""Near-duplicate texts against a comparison of all pairs."""

from __future__ import annotations

import re

import numpy as np
import pytest

from verisift.operators import texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _table():
    rng = np.random.default_rng(21)
    letters = [f"{a}{b}{c}" for a in "tpkm" for b in "aeio" for c in "nrsl"]

    def prose(n):
        return list(rng.choice(letters, n))

    rows = [None, "", " \n", "one", "One", "two words", "TWO\tWORDS", "x" * 50_000]
    bases = [prose(int(n)) for n in rng.integers(30, 200, 12)]
    for base in bases:
        for _ in range(int(rng.integers(1, 9))):
            words = list(base)
            for _ in range(int(rng.integers(0, max(2, len(base) // 12)))):
                words[int(rng.integers(0, len(words)))] = "other"
            rows.append(" ".join(words))
    # a large group of near copies and a long text
    for i in range(120):
        words = list(bases[0])
        words[i % len(words)] = f"new{i}"
        rows.append(" ".join(words))
    long = prose(30_000)
    rows += [" ".join(long), " ".join([*long[:-50], *prose(50)])]
    order = rng.permutation(len(rows))
    return [(int(i), rows[j]) for i, j in enumerate(order)] + [(None, rows[30]), (None, None), (3, "a second text under one id")]


def _sets(rows):
    upper = {i: i + 32 for i in range(65, 91)}
    out = []
    for i, text in rows:
        words = WORD.findall((text or "").translate(upper))
        out.append((i, frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()))
    return out


@pytest.mark.parametrize(("together", "growth"), [(8, 16), (1, 2)])
def test_every_similar_text_is_found(spark, monkeypatch, together, growth):
    monkeypatch.setattr(texts, "TOGETHER", together)
    monkeypatch.setattr(texts, "GROWTH", growth)
    rows = _table()
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "id long, body string, set string, n int").repartition(4)
    found = texts.with_text_duplicates(df, "id", "body")
    assert found.columns == [*df.columns, "feat_text_copies", "feat_text_duplicate", "feat_similar_to", "feat_text_similarity"]
    got = {(r["id"], r["body"]): r for r in found.collect()}
    sets = _sets(rows)
    hits = missed = 0
    for (i, text), (_, own) in zip(rows, sets):
        row = got[i, text]
        if i is None or not own:
            assert (row["feat_text_copies"], row["feat_text_duplicate"]) == (0, False)
            continue
        likes = {}
        for j, other in sets:
            if j is not None and other and j < i and 5 * len(own & other) >= 4 * len(own | other):
                likes[j] = len(own & other) / len(own | other)
        assert row["feat_text_copies"] == sum(o == own for j, o in sets if j is not None) - 1
        hits += bool(likes) and row["feat_text_duplicate"]
        missed += bool(likes) and not row["feat_text_duplicate"]
        # nothing is reported that is not similar
        if row["feat_text_duplicate"]:
            assert row["feat_text_similarity"] == pytest.approx(likes[row["feat_similar_to"]])
    assert hits > 100 and hits / (hits + missed) >= 0.9 and missed == 0


def test_no_texts(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "id long, body string")
    found = texts.with_text_duplicates(df, "id", "body")
    assert found.where("feat_text_duplicate OR feat_text_copies > 0 OR feat_similar_to IS NOT NULL").isEmpty() and found.count() == 2
    assert texts.with_text_duplicates(df.limit(0), "id", "body").isEmpty()


def test_dropped_texts_are_not_moved_for_the_last_join(spark):
    df = spark.createDataFrame([(i, f"one two three four five six {i % 3}") for i in range(9)], "id long, text string")
    found = texts.with_text_duplicates(df, "id", "text").select("id", "feat_text_copies")
    assert {r.id: r.feat_text_copies for r in found.collect()} == {i: 2 for i in range(9)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert joins and not any("xxhash64(" in line for line in joins)
