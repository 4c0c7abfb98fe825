"""What a worker of the language model holds: the sequences, not the texts."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from verisift.llm import lm_score


@pytest.mark.parametrize("rows", [1, 700])
def test_gathered_sequences_are_those_of_all_texts(rows):
    rng = np.random.default_rng(rows)
    words = np.array([f"w{i}" for i in range(500)])
    texts = [" ".join(rng.choice(words, 1200)) if i % 9 else None for i in range(rows)]
    table = lm_score.Frequent(np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def made(_, part):
        hashes, groups, at = lm_score.tokens(part)
        return lm_score._with_ends(table.look_up(hashes, groups)[1], at)

    hashes, groups, at = lm_score.tokens(texts)
    whole = lm_score._with_ends(table.look_up(hashes, groups)[1], at)
    del hashes, groups
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[i : i + 300])}) for i in range(0, rows, 300)]
    tracemalloc.start()
    (held,) = lm_score._gathered(batches, 0, made)
    classes, edges = lm_score._joined(held)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(classes, whole[0]) and np.array_equal(edges, whole[1])
    # one block's arrays, not those of all texts, which come to 40 bytes a letter and more
    assert peak < 60 * sum(len(t or "") for t in texts[:256]) + (1 << 20)
