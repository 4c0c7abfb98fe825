"""What a worker of the encoding holds: bounded, and the same results as without the bounds."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken

import corpus_pipeline
from verisift.llm import byte_bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_codec_memories_turn_over():
    own = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN, byte_bpe.Limits(40, 1 << 23, 30, 50))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )
    rng = np.random.default_rng(3)
    for _ in range(60):
        text = "the same " + " ".join("".join(rng.choice(list("abcdeéß"), 6)) for _ in range(10))
        ids = np.frombuffer(own.encode(text), "<u4").tolist()
        assert ids == library.encode_ordinary(text) and own.decode(own.encode(text)) == text
        assert len(own._words) + len(own._older) <= 40 + 2 * 12
        assert len(own._machine._machine._order._pairs) <= 30
    assert "the" in own._words


def test_slices_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(byte_bpe, "SLICE_BYTES", 100)
    texts = ["x" * 60, None, "y" * 40, "z" * 300, "", "w" * 99, "v" * 2]
    batch = pa.RecordBatch.from_pydict({"id": list(range(7)), "text": pa.array(texts)})
    pieces = [p.column(1).to_pylist() for p in byte_bpe._slices([batch])]
    assert sum(pieces, []) == texts
    assert pieces == [texts[:3], [texts[3]], ["", texts[5]], [texts[6]]]


def test_encoding_of_the_pipeline_ships_no_second_text(spark):
    rows = [(1, "en", "a", "one two"), (2, "de", "b", None), (3, "de", "b", ""), (None, None, None, "é 日本 x")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    coded = corpus_pipeline.encode(spark, docs, "")
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert "decoded" not in plan
    found = {r.doc_id: r for r in coded.collect()}
    assert coded.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids", "round_trip"]
    assert all(r.round_trip for r in found.values()) and len(found) == 4
    assert found[2].n_tokens == found[3].n_tokens == 0 and len(found[1].token_ids) == 4 * found[1].n_tokens
