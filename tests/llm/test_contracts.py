"""Every operator against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import math
import os
import re
import struct
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.normalizers import Lowercase

import corpus_pipeline
from verisift.llm import (
    byte_bpe,
    lang_id,
    line_dedup,
    lm_score,
    minhash,
    quality_rules,
    source_mix,
    substring,
    token_counts,
    topk,
)
from verisift.session import CLEANUP_CONF, scratch_path, scratch_root, stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, copies string, key long"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def _texts() -> list[str | None]:
    rng = np.random.default_rng(5)
    letters = [f"{a}{b}{c}" for a in "tpkm" for b in "aeio" for c in "nrsl"]

    def prose(n):
        return " ".join(rng.choice(letters, n))

    base, passage = prose(120), prose(60)
    near = base.split(" ")
    near[50] = "other"
    texts: list[str | None] = [None, "", "  \n\t ", "one", "Two words", base, base, base.upper().lower(), " ".join(near)]
    texts += [prose(40) + " " + passage + " " + prose(30) for _ in range(3)]
    texts += ["same " * 100, "ab cd " * 60, prose(3000), "\n".join([prose(12)] * 4 + [prose(9)])]
    texts += [prose(80) + "\n" + base.replace(" ", "\n", 3), "é Ü ß 日本 <|endoftext|> it's", "word " * 3 + "x" * 5000]
    return texts + [prose(int(n)) for n in rng.integers(5, 90, 12)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (i, t, None if i % 7 == 0 else "xy"[i % 2], None if i % 5 == 0 else f"s{i % 4}", len(t or ""), "w", "c", 1)
        for i, t in enumerate(_texts())
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def texts():
    return dict(enumerate(_texts()))


def words(text):
    return WORD.findall(text or "")


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert quality_rules.ledger(none).count() == 0
    assert source_mix.plan(none).count() == source_mix.mix(none).count() == 0
    assert byte_bpe.transcode(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert token_counts.prefix_store(none, WORDS).count() == 0
    assert line_dedup.decisions(none).count() == 0
    assert minhash.components_of(none).count() == 0
    assert substring.removal_digests(none).count() == 0
    assert lm_score.score(none, lm_score.fold_of()).count() == 0
    idf, fitted = lang_id.train(none.select("doc_id", "text", "lang"))
    assert lang_id.predict(none, idf, fitted).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(vectors, vectors, 3).count() == 0


def test_quality_rules(docs, texts):
    for row in quality_rules.ledger(docs).collect():
        w = words(texts[row.doc_id])
        runs = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if runs[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (texts[row.doc_id] or "").split("\n") if WORD.search(x)]
        assert row.n_words == len(w) and row.word_chars == sum(map(len, w))
        assert row.n_repeat_words == len(covered) and row.n_dup_lines == len(lines) - len(set(lines))
        assert bool(row.failure_bits & 3) == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
    book = quality_rules.ledger(docs)
    kept = {r.doc_id for r in book.filter(quality_rules.passes(F.col("failure_bits"), "full-1")).collect()}
    assert {r.doc_id for r in quality_rules.accept(docs).collect()} == kept
    by_rule = {r.rule: r for r in quality_rules.ablation(book, "base-1").collect()}
    bits = [r.failure_bits & 3 for r in book.collect()]
    assert by_rule["few_words"].n_failed == sum(b & 1 for b in bits)
    assert by_rule["few_words"].n_only_this == sum(b == 1 for b in bits)


def test_mix_meets_its_targets(docs, texts):
    rows = source_mix.plan(docs).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    total = sum(r["size"] for r in rows)
    goals = {r.source: r.target for r in rows}
    assert math.isclose(sum(goals.values()), 1.5 * total)
    for source, goal in goals.items():
        own = [r for r in rows if r.source == source]
        assert all(0 <= r.copies <= 2 and r["size"] == len(words(texts[r.doc_id])) for r in own)
        assert goal <= 2 * own[0].source_size
        assert abs(sum(r.copies * r["size"] for r in own) - goal) <= 2 * max(r["size"] for r in own)
    again = {(r.doc_id, r.copies) for r in source_mix.plan(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.copies) for r in rows}
    mixed = Counter(r.doc_id for r in source_mix.mix(docs).collect())
    assert mixed == Counter({r.doc_id: r.copies for r in rows if r.copies})
    assert source_mix.mix(docs).columns == docs.columns


def test_byte_bpe(docs, texts):
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )
    for row in byte_bpe.transcode(docs, RANKS, public_tokenizers.PATTERN).collect():
        ids = own.encode_ordinary(texts[row.doc_id] or "")
        assert bytes(row.token_ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert row.decoded == (texts[row.doc_id] or "")
    coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id"])
    decoded = byte_bpe.decode(coded, RANKS, public_tokenizers.PATTERN)
    assert {r.doc_id: r.decoded for r in decoded.collect()} == {i: t or "" for i, t in texts.items()}


def test_utf8_machine_in_any_pieces():
    data = "aé日😀z".encode()
    for cut in range(len(data)):
        machine = byte_bpe.Utf8Machine()
        assert machine.feed(data[:cut]) + machine.feed(data[cut:]) + machine.feed(b"", last=True) == "aé日😀z"


def test_token_counts(docs, texts):
    own = Tokenizer.from_file(WORDS)
    stored = token_counts.prefix_store(docs, WORDS)
    for row in stored.collect():
        assert row.n_tokens == len(own.encode(texts[row.doc_id] or "", add_special_tokens=False).ids)
    for row in token_counts.truncate(docs, stored, WORDS, 20).collect():
        assert row.n_tokens == len(own.encode(row.prefix, add_special_tokens=False).ids) <= 20
    counter = token_counts.counter(WORDS)
    text = counter.normalised("Hello it's 're a ÉCOLE <|endoftext|> end-of 12")
    sums = counter.sums(text)
    for n in range(len(text) + 1):
        if "<|" not in text[:n] or "|>" in text[:n]:  # prefixes that end inside a special string are plain text
            assert counter.tokens_at(text, sums, n) == len(own.encode(text[:n], add_special_tokens=False).ids)


def test_topk(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(300)] + [(300 + i, [1.0, 0.5, 0.0, -1.0]) for i in range(60)]
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0]), (902, [float("nan")] * 4), (903, [float("inf")] * 4), (None, [1.0] * 4), (920, [1.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = {i: np.floor(64 * np.array(v)).astype(int) for i, v in rows[:360]}
    got: dict = {}
    for r in topk.search(vectors, vectors.filter("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in good if i % 20 == 0}
    for q, found in got.items():
        best = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q)[:20]
        assert sorted(found) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]


def test_letters_become_small_as_in_the_library():
    library = Lowercase()
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000:
            char = unicodedata.normalize("NFC", chr(code))
            assert token_counts.PrefixCounter._plain(chr(code)) == library.normalize_str(char), hex(code)


def test_topk_of_repeated_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=3)]) for i in range(40)]
    rows += [rows[0], rows[0], rows[20], (20, [0.5, 0.5, 0.5]), (40, [0.25, 0.0, 0.0])] + [(7, [9.0, 9.0, 9.0])] * 5
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    whole = [(i, tuple(np.floor(64 * np.array(v)).astype(int).tolist())) for i, v in rows]
    expected = []
    for q, v in {r for r in whole if r[0] % 20 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)[:20]
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    got = [tuple(r) for r in topk.search(vectors, vectors.filter("vec_id % 20 = 0"), 20).collect()]
    assert sorted(got) == sorted(expected)


def test_lm_score(docs, texts):
    got = {r.doc_id: r for r in lm_score.score(docs, lm_score.fold_of()).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: [*words((t or "").translate(lower)), None] for i, t in texts.items()}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9)
        assert (got[i].held_out, got[i].n_tokens, got[i].train_tokens) == (held[i], len(ws), n)
        assert got[i].n_known == sum(counts[w] > 0 for w in ws)
        assert math.isfinite(got[i].score) and got[i].score < 0


def test_lm_score_beats_word_counts_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sums = lm_score.score(docs, lm_score.fold_of()).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert sums[2] > 0 and (sums[0] - sums[1]) / sums[2] > 0.1


def test_line_dedup(docs, texts):
    got = {r.doc_id: (r.n_lines, list(r.removed)) for r in line_dedup.decisions(docs).collect()}
    seen: list[set] = []
    for i, text in sorted(texts.items()):
        removed, n = [], 0
        for at, line in enumerate((text or "").split("\n")):
            own = set(words(line))
            if own:
                n += 1
                if any(9 * len(own & s) >= 4 * (len(own) + len(s)) for s in seen):
                    removed.append(at)
                seen.append(own)
        assert got[i] == (n, removed)
    cut = {r.doc_id: r.text for r in line_dedup.remove_lines(docs).collect()}
    for i, text in texts.items():
        if text is not None:
            lines = text.split("\n")
            assert cut[i] == "\n".join(x for at, x in enumerate(lines) if at not in got[i][1])


def test_line_dedup_of_shared_and_missing_ids(spark):
    rng = np.random.default_rng(9)

    def line(n=30):
        return " ".join(f"w{x}" for x in rng.integers(0, 100_000, n))

    base = line()
    other = base.rsplit(" ", 1)[0] + " other"
    rows = [(None, f"{base}\n{line()}"), (None, f"{line()}\n{other}"), (None, f"{other}\n{line()}"), (None, f"{line()}\n{line()}")]
    rows += [(3, f"{other}\n{line()}"), (3, f"{line()}\n{line()}"), (3, f"{line()}\n{base}"), (4, base), (4, line()), (4, None)]
    rows += [(None, f"common {line(3)}\n{line()}") for _ in range(40)]
    rows += rows[:2]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("a"), F.hash("text").alias("b")).distinct().collect()
    wanted, seen = {}, []
    for r in sorted(keyed, key=lambda r: (-(1 << 63) if r.doc_id is None else r.doc_id, r.a, r.b)):
        removed = []
        for at, text in enumerate((r.text or "").split("\n")):
            own = set(words(text))
            if own and any(9 * len(own & s) >= 4 * (len(own) + len(s)) for s in seen):
                removed.append(at)
            seen += [own] if own else []
        wanted[r.doc_id, r.text] = "\n".join(x for at, x in enumerate((r.text or "").split("\n")) if at not in removed)
    got = line_dedup.remove_lines(docs.withColumn("was", F.col("text"))).collect()
    assert len(got) == len(rows) and all((r.text or "") == wanted[r.doc_id, r.was] for r in got)
    decided = Counter((r.doc_id, r.n_removed) for r in line_dedup.decisions(docs).collect())
    lost = [(i, (t or "").count("\n") - (wanted[i, t].count("\n") if wanted[i, t] else -1)) for i, t in rows if t is not None]
    assert decided == Counter([*lost, (4, 0)])


def test_line_dedup_names_few_rows(spark, monkeypatch):
    """Lines that share frequent words but do not resemble each other share few tokens; every similar pair is found,
    also where texts are looked up by a shuffle and large groups take several rounds."""
    rng = np.random.default_rng(12)
    frequent, rare = [f"frequent{x}" for x in range(12)], [f"r{x}" for x in range(5000)]
    lines = [" ".join([*rng.permutation(frequent)[:8], *rng.choice(rare, 12)]) for _ in range(150)]
    near = lines[0].split(" ")
    lines += [" ".join([*near[:i], f"x{i}", *near[i + 1 :]]) for i in range(20)] + [lines[3], lines[3] + " more"]
    docs = spark.createDataFrame([(i // 5, line + "\n") for i, line in enumerate(lines)], "doc_id long, text string").repartition(3).cache()
    for name, value in (("MOST_BROADCAST", 0), ("TOGETHER", 1), ("GROWTH", 2)):
        monkeypatch.setattr(line_dedup, name, value)
    firsts = line_dedup.first_lines(docs)
    assert firsts.agg(F.max(F.size("tokens"))).first()[0] <= 9
    shared = line_dedup._members(line_dedup._saved(firsts, "test-firsts"))
    assert set(shared.columns) == {"token", "id", "n", "bits", "m"}  # no keys of 24 bytes for each token
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("a"), F.hash("text").alias("b")).distinct().collect()
    wanted, seen = {}, []
    for r in sorted(keyed, key=lambda r: (r.doc_id, r.a, r.b)):
        own = set(words(r.text))
        wanted[r.doc_id, r.text] = any(9 * len(own & s) >= 4 * (len(own) + len(s)) for s in seen)
        seen.append(own)
    assert 20 <= sum(wanted.values()) < 30
    got = line_dedup.remove_lines(docs.withColumn("was", F.col("text"))).collect()
    assert len(got) == len(lines) and all((r.text == "") == wanted[r.doc_id, r.was] for r in got)


def test_long_unlike_lines_are_no_candidates(spark, monkeypatch):
    """64 parity bits let pairs of long unlike lines that share a token through; the further bits do not."""
    rng = np.random.default_rng(5)
    # the two longest words are the same, so every line is under one token with each other one
    head = "a" * 120 + " " + "b" * 119
    lines = [" ".join([head, *(f"w{x}" for x in rng.choice(50_000, 150, replace=False))]) for _ in range(60)]
    lines += [lines[7] + " more", " ".join(lines[9].split(" ")[:-3])]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3).cache()
    saved, pairs = line_dedup._saved, []

    def counted(df, label):
        table = saved(df, label)
        if label == "line-pairs":
            pairs.append(table.count())
        return table

    monkeypatch.setattr(line_dedup, "MOST_BROADCAST", 3)  # several passes over the texts
    monkeypatch.setattr(line_dedup, "_saved", counted)
    got = {r.doc_id: list(r.removed) for r in line_dedup.decisions(docs).collect()}
    assert {i for i, gone in got.items() if gone} == {60, 61}
    assert sum(pairs) <= 8


def test_what_a_step_used_is_not_left_on_the_disk(spark):
    """Shuffle files go with the write that made them, and tables of tokens and sets when they were read."""

    def files():
        held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (held.apply(i).getName() for i in range(held.size())) if n.startswith("shuffle_")}

    def step():
        return spark.range(1000).repartition(4).groupBy((F.col("id") % 7).alias("k")).count()

    before = files()
    table = stored(step(), "test-step")
    assert not files() - before and table.count() == 7
    before = files()
    step().write.parquet(scratch_path(spark, "test-step"))
    assert files() - before  # what a plain write leaves
    assert spark.conf.get(CLEANUP_CONF) == "false"
    docs = spark.createDataFrame([(i, f"a b c d e f g h {i}\nx y z") for i in range(20)], "doc_id long, text string")
    old = set(os.listdir(scratch_root(spark)))
    assert sum(r.n_removed for r in line_dedup.decisions(docs).collect()) == 39 - 1
    assert not {n.rsplit("-", 1)[0] for n in set(os.listdir(scratch_root(spark))) - old} & {"line-tokens", "line-sets"}


def test_lang_id_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("held", lang_id.fold("doc_id", 5) == 0)
    idf, fitted = lang_id.train(docs.filter("NOT held").select("doc_id", "text", "lang"))
    found = lang_id.predict(docs, idf, fitted).join(docs.filter("held").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found)
    assert all(0 <= r.score <= 1 for r in found)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 --")], "doc_id long, text string")
    assert {(r.lang_pred, r.score) for r in lang_id.predict(odd, idf, fitted).collect()} == {("und", 0.0)}


@pytest.mark.parametrize(("width", "num"), [(3, 85), (5, 80)])
def test_minhash(docs, texts, width, num):
    sets = {}
    for i, t in texts.items():
        w = words((t or "").lower()) if (t or "").isascii() else words(t)
        sets[i] = {tuple(w[j : j + width]) for j in range(max(1, len(w) - width + 1))} if w else set()
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {i: new if x == old else x for i, x in label.items()}
    for r in minhash.components_of(docs, width, num, 100).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), label[r.doc_id], label[r.doc_id] == r.doc_id)
    kept = {r.doc_id for r in minhash.deduplicate(docs, width, num, 100).collect()}
    assert kept == {i for i in label if label[i] == i}


def test_minhash_of_two_texts_under_one_id(spark):
    rng = np.random.default_rng(4)
    near = {}
    rows = []
    for i in range(12):
        a, b = (" ".join(f"w{x}" for x in rng.integers(0, 100_000, 200)) for _ in range(2))
        # both texts of the id have a near copy of their own, under later ids
        rows += [(10 * i, a), (10 * i, b), (10 * i + 1, f"{a} end"), (10 * i + 2, f"{b} end")]
        near |= {10 * i + k: 10 * i for k in range(3)}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = minhash.components_of(docs, 5, 80, 100).collect()
    assert len(found) == len(rows) and all(r.component_id == near[r.doc_id] for r in found)
    kept = Counter(r.doc_id for r in minhash.deduplicate(docs, 5, 80, 100).collect())
    assert kept == Counter({10 * i: 2 for i in range(12)})


def test_substring(docs, texts):
    every = {i: words(t) for i, t in texts.items()}
    windows = Counter(tuple(w[j : j + 35]) for w in every.values() for j in range(len(w) - 34))
    for r in substring.removal_digests(docs).collect():
        w = every[r.doc_id]
        gone = {k for j in range(len(w) - 34) if windows[tuple(w[j : j + 35])] > 1 for k in range(j, j + 35)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (r.n_words, r.n_removed) == (len(w), len(gone))
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_repeated_rows(docs):
    twice = docs.union(docs)
    n = docs.count()
    assert quality_rules.ledger(twice).count() == source_mix.plan(twice).count() == 2 * n
    assert minhash.components_of(twice).count() == substring.removal_digests(twice).count() == 2 * n
    assert lm_score.score(twice, lm_score.fold_of()).count() == line_dedup.decisions(twice).count() == 2 * n


def test_pipeline_stages(spark, docs):
    stage = docs
    for name, run in corpus_pipeline.STAGES[:-1]:
        before, stage = stage, run(spark, stage, "")
        stage = spark.createDataFrame(stage.collect(), stage.schema)
        assert stage.columns == docs.columns, name
        if name in ("quality rules", "near duplicates"):
            assert stage.count() <= before.count()
    coded = corpus_pipeline.STAGES[-1][1](spark, stage, "").collect()
    assert coded and all(r.round_trip for r in coded)
