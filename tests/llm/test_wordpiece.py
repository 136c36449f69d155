import random

import numpy as np
import pytest
from brute import token_count

from tripmart.llm import wordpiece

ALL_BYTES = [bytes([b]) for b in range(256)]


@pytest.mark.parametrize("seed", range(5))
def test_automaton_is_greedy(seed):
    rng = random.Random(seed)
    pieces = {bytes(rng.choice(b" abc") for _ in range(rng.randrange(2, 7))) for _ in range(60)} | set(ALL_BYTES)
    words = [bytes(rng.choice(b"abcd") for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    got = wordpiece.Automaton.of(sorted(pieces)).counts(data, ends - [len(w) for w in words], ends)
    assert got.tolist() == [token_count(w.decode(), pieces) for w in words]


def test_needs_all_bytes():
    with pytest.raises(ValueError):
        wordpiece.Automaton.of([b"a", b"b"])


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    vocabulary = set(wordpiece.read_vocabulary(wordpiece.VOCABULARY))
    got = {r.doc_id: r.n_tokens for r in wordpiece.count_tokens(docs).collect()}
    assert got == {r.doc_id: token_count(r.text, vocabulary) for r in docs.select("doc_id", "text").collect()}


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "a"), (3, "x" * 100_000), (3, "x" * 100_000), (4, "\tthe \x0b the\r\n")]
    got = wordpiece.count_tokens(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    vocabulary = set(wordpiece.read_vocabulary(wordpiece.VOCABULARY))
    assert sorted((r.doc_id or 0, r.n_words, r.n_tokens) for r in got) == sorted(
        (i or 0, len((t or "").split()), token_count(t, vocabulary)) for i, t in rows
    )
    assert wordpiece.count_tokens(spark.createDataFrame([], "doc_id long, text string")).count() == 0
