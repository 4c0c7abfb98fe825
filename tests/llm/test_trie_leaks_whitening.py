"""The prefix trie, the decontamination and the whitening against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from verisift.llm import decontaminate, prefix_trie, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LEAK = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# -- conversations ---------------------------------------------------------------


def _turns():
    rng = np.random.default_rng(11)
    rows = []
    for conv in [*range(0, 47), 60, 75, 1001, 1020]:
        length = int(rng.integers(1, 7))
        for turn in range(length):
            # few texts, so that prefixes are shared at every depth
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", f"text {rng.integers(0, 2)} of words"))
    rows += [(200, 3, "user", "late"), (200, None, None, None), (200, None, "user", None)]
    rows += [(220, 1, "user", "x" * 200_000 + " y"), (220, 1, "user", "x" * 200_000 + " y"), (None, 1, "user", "lost")]
    # a conversation rebuilt to nothing: its base is absent and h takes all its turns
    bare = next(c for c in range(301, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 >= 1)
    rows.append((bare, 0, "user", "gone"))
    # a long conversation and many copies of one
    rows += [(500, t, "user", f"step {t}") for t in range(300)]
    rows += [(c, t, "user", f"copy {t}") for c in range(2000, 2400) for t in range(2)]
    return rows


def _trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))

    def ordered(conv):
        def name(role, text):
            return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()

        return [(r, t) for _, _, r, t in sorted((at, name(r, t), r, t) for at, r, t in own.get(conv, []))]

    built = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 4
        built[conv] = ordered(conv - conv % 20)[:h] + ordered(conv)[h:]
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(WORD.findall(node[-1][1])) if node else 0
        leaves[node] = sum(leaves[c] for c in children[node]) if children[node] else 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in children[node])
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("rows_of_range", "merged"), [(20_000, 64), (7, 2), (1, 3)])
def test_trie_equals_brute_force(spark, monkeypatch, rows_of_range, merged):
    monkeypatch.setattr(prefix_trie, "RANGE_ROWS", rows_of_range)
    monkeypatch.setattr(prefix_trie, "MERGED", merged)
    monkeypatch.setattr(prefix_trie, "PIECE", 200)
    rows = _turns()
    turns = spark.createDataFrame(
        [(*r, 1, "n", "k") for r in rows], "conv_id long, turn long, role string, text string, part int, name string, keys string"
    ).repartition(5)
    found = prefix_trie.nodes(turns).collect()
    assert sorted((tuple(r) for r in found), key=repr) == _trie(rows)


def test_trie_of_nothing(spark):
    turns = spark.createDataFrame([(None, 1, "user", "lost")], "conv_id long, turn long, role string, text string")
    assert prefix_trie.nodes(turns).count() == prefix_trie.nodes(turns.limit(0)).count() == 0


def test_contraction_keeps_only_the_outer_ways():
    rows = []
    for i in range(50):
        keys = [bytes([i // 25]), bytes([i // 5]), bytes([i])]
        sums = np.zeros((4, 4), np.int64)
        sums[0] = 1
        rows.append(prefix_trie._Row(keys, None, [0, 1, 1, 1], sums, np.full(4, i, np.int64), {3: "e"}))
    forest = prefix_trie.Forest(rows, False)
    # open are the root and three nodes below it on either side
    assert len(forest.nodes) == 1 + 2 + 10 + 50 - 7 and len(forest.kept) == 2
    assert forest.kept[0].sums[0].tolist() == [50, 25, 5, 1] and forest.kept[1].sums[0].tolist() == [0, 25, 5, 1]


# -- benchmark passages ----------------------------------------------------------


def _leak_tables():
    rng = np.random.default_rng(3)
    letters = [f"{a}{b}{c}" for a in "tpkm" for b in "aeio" for c in "nrsl"]

    def prose(n):
        return " ".join(rng.choice(letters, n))

    items = [(i, prose(int(rng.integers(11, 40)))) for i in range(12)]
    items += [(20, "Short One, two"), (21, "solo"), (22, "pair of"), (23, None), (24, ""), (25, "---"), (26, items[0][1]), (None, items[1][1])]
    items += [(27, "same " * 14), (28, items[2][1].upper()), (20, "Short One, two"), (29, "Ünï cödé ü " * 4)]
    texts = [None, "", " -- ", "solo", "SOLO!", "xsolo", "pair  of", "of pair", "a short-one two b", prose(200)]
    for i in range(12):
        words = items[i][1].split(" ")
        texts.append(prose(20) + " " + ", ".join(words).upper() + ". " + prose(20))
        texts.append(prose(5) + " " + " ".join(words[3 : 3 + i]))
    texts += ["same " * 9, "same " * 10, "Same, " * 33, items[1][1], items[2][1], "Ünï cödé ü " * 5, "ÜNÏ CÖDÉ Ü " * 5]
    texts += [(prose(50) + " ") * 2000 + items[3][1], "y" * 100_000 + " " + items[4][1]]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, items[5][1]), (None, prose(30)), (3, items[6][1]), (3, "solo")]
    return docs, items


def _leaks(docs, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        w = LEAK.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[i : i + width])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = LEAK.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key] - {None}
        ids = ",".join(sorted(map(str, found)))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_leaks_equal_brute_force(spark):
    docs, items = _leak_tables()
    frame = spark.createDataFrame([(*d, "w", 1, [1]) for d in docs], "doc_id long, text string, words string, at int, places array<int>")
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, window string")
    found = decontaminate.findings(frame.repartition(3), bench.repartition(2))
    rows = found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256").collect()
    expected = _leaks(docs, items)
    assert sorted((tuple(r) for r in rows), key=repr) == expected
    left = decontaminate.clean(frame, bench)
    assert left.columns == frame.columns
    kept = sorted((r.doc_id for r in left.collect()), key=repr)
    assert kept == sorted((d for d, _, n_hit, _, _ in expected if n_hit == 0), key=repr)
    spans = {r.doc_id: r.spans for r in found.filter("n_hit > 0").collect() if r.doc_id is not None}
    assert [tuple(s) for s in spans[4]] == [(0, 1)]


def test_leaks_of_empty_tables(spark):
    docs, items = _leak_tables()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    none = decontaminate.findings(frame, bench.limit(0))
    assert none.count() == len(docs) and none.filter("n_hit > 0 OR n_items > 0").isEmpty()
    assert decontaminate.findings(frame.limit(0), bench).isEmpty()
    assert decontaminate.clean(frame, bench.limit(0)).count() == len(docs)


def test_leaks_run_without_python(spark):
    docs, items = _leak_tables()
    frame = spark.createDataFrame(docs, "doc_id long, text string").filter("doc_id < 8")
    found = decontaminate.findings(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert not re.search("Python|Arrow|Pandas", found._jdf.queryExecution().executedPlan().toString())


# -- whitening -------------------------------------------------------------------


def _vectors():
    rng = np.random.default_rng(13)
    turned = rng.normal(size=(7, 7))
    rows = [(i, (rng.normal(size=7) * np.array([9, 5, 3, 2, 1, 0.5, 0.2]) @ turned + 40).tolist(), 1.0) for i in range(400)]
    rows += [(7, rows[3][1], 2.0), (7, rows[3][1], 2.0), (None, rows[5][1], None), (900, None, 1.0), (901, [], 1.0)]
    return rows + [(902, [1.0, None] + [0.0] * 5, 1.0), (903, [float("nan")] + [0.0] * 6, 1.0), (904, [float("-inf")] + [0.0] * 6, 1.0)]


def test_whitening_equals_eigenvectors(spark):
    rows = _vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened double").repartition(4)
    fitted = whitening.fit(frame)
    used = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    x = np.floor(64 * np.array([r[1] for r in used])).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    values, parts = values[::-1], parts[:, ::-1]
    assert fitted.n == n and fitted.sums == tuple(sums.tolist())
    np.testing.assert_allclose(fitted.eigenvalues, values, rtol=1e-9)
    np.testing.assert_allclose(fitted.explained, values / values.sum(), rtol=1e-9)
    np.testing.assert_allclose(np.abs((fitted.components * parts).sum(axis=0)), 1.0, atol=1e-12)
    done = whitening.whiten(frame, fitted)
    assert done.columns == ["vec_id", "embedding", "whitened", "whitened_", "deviation"]
    expected = (centred @ fitted.components) / np.sqrt(values)
    known = {tuple(r[1]): (e, int(d)) for r, e, d in zip(used, expected, ((n * x - sums) ** 2).sum(axis=1))}
    out = done.collect()
    assert len(out) == n
    for row in out:
        e, d = known[tuple(row.embedding)]
        np.testing.assert_allclose(row.whitened_, e, atol=1e-9)
        assert int(row.deviation) == d
    assert whitening.identity_error(frame, fitted) < 1e-10
    assert len(done.select(F.element_at("whitened_", 1)).distinct().collect()) > 300


def test_whitening_does_not_depend_on_partitions(spark):
    frame = spark.createDataFrame(_vectors(), "vec_id long, embedding array<double>, label double")
    one, many = whitening.fit(frame.coalesce(1)), whitening.fit(frame.repartition(9))
    assert (one.components == many.components).all() and (one.eigenvalues == many.eigenvalues).all()


def test_whitening_of_flat_and_empty_tables(spark):
    kind = "vec_id long, embedding array<double>"
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 3.0]) for i in range(9)], kind)
    fitted = whitening.fit(flat)
    assert len(fitted.eigenvalues) == 1 and whitening.identity_error(flat, fitted) < 1e-12
    for frame in (flat.limit(1), flat.limit(0), flat.filter("vec_id = 3").union(flat.filter("vec_id = 3"))):
        fitted = whitening.fit(frame)
        done = whitening.whiten(frame, fitted)
        assert len(fitted.eigenvalues) == 0 and whitening.identity_error(frame, fitted) == 0.0
        assert done.count() == frame.count() and done.filter("size(whitened) > 0").isEmpty()
    with pytest.raises(Exception, match="different lengths"):
        whitening.fit(flat.union(spark.createDataFrame([(1, [1.0])], kind)))


def test_factors():
    rng = np.random.default_rng(1)
    left = rng.normal(size=(30, 12))
    matrix = left @ left.T
    factor = whitening.pivoted_cholesky(matrix)
    assert factor.shape == (30, 12)
    np.testing.assert_allclose(factor @ factor.T, matrix, atol=1e-10)
    turned = whitening.orthogonal_columns(factor)
    gram = turned.T @ turned
    assert np.abs(gram - np.diag(gram.diagonal())).max() < 1e-11
    np.testing.assert_allclose(np.sort(gram.diagonal()), np.linalg.eigvalsh(matrix)[-12:], rtol=1e-10)
