import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tripmart.llm import byte_bpe

FILES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module", params=FILES)
def both(request):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(request.param))
    own = byte_bpe.Codec(ranks, public_tokenizers.PATTERN)
    return own, tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<i4").tolist()


def texts(seed):
    rng = random.Random(seed)
    alphabets = ["ab ", "aeinorst -'", "the an in 's", "éàü ßñ", "0123456789.,", "\n\t \r\x0b\x1c　 ", "中文日本語 かな", "🙂👍🏽 ‍", "(){};=<>/"]
    for _ in range(300):
        pool = "".join(rng.sample(alphabets, rng.randrange(1, 4)))
        yield "".join(rng.choice(pool) for _ in range(rng.randrange(0, 200)))


@pytest.mark.parametrize("seed", range(3))
def test_same_ids_as_the_plain_library(both, seed):
    own, plain = both
    for text in texts(seed):
        got = ids(own, text)
        assert got == plain.encode_ordinary(text)
        assert own.decode(np.array(got, np.int32)) == text.encode()


def test_long_runs_and_parts(both, monkeypatch):
    own, plain = both
    for text in ("x" * 20_000, " " * 5_000 + "a", "\n \n" * 3_000, "ab" * 9_999 + "é", "<|endoftext|>" * 50):
        assert ids(own, text) == plain.encode_ordinary(text)
    monkeypatch.setattr(byte_bpe, "PART", 50)
    text = "It's  a   test\n\n of parts 's and \t tabs   x" * 200
    assert ids(own, text) == plain.encode_ordinary(text)


@pytest.mark.parametrize("seed", range(3))
def test_appends_and_edits_are_exact(both, seed):
    own, _ = both
    rng = random.Random(seed)

    def some(most):
        return bytes(rng.choice(b"the an ing ation e r s 01 \xc3\xa9") for _ in range(rng.randrange(most)))

    prefixes = byte_bpe.Prefixes(own.vocabulary)
    data = b""
    for _ in range(60):
        if rng.random() < 0.5:
            more = some(80)
            prefixes.append(more)
            data += more
        else:
            begin = rng.randrange(len(data) + 1)
            end, new = min(len(data), begin + rng.randrange(20)), some(20)
            prefixes.replace(begin, end, new)
            data = data[:begin] + new + data[end:]
        fresh = byte_bpe.Prefixes(own.vocabulary, data)
        assert bytes(prefixes.data) == data
        assert prefixes.last == fresh.last
        assert prefixes.tokens() == fresh.tokens()


def test_an_edit_is_local(both):
    own, _ = both
    data = b"".join(b" word%d" % i for i in range(20_000))
    prefixes = byte_bpe.Prefixes(own.vocabulary, data)
    count = prefixes.replace(1000, 1003, b"zz")
    assert count < 10 * own.vocabulary.longest
    assert prefixes.last == byte_bpe.Prefixes(own.vocabulary, data[:1000] + b"zz" + data[1003:]).last


def test_entries_that_no_merge_makes():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"xyz": 257, b"abab": 258}
    own = byte_bpe.Codec(ranks, r"[a-z]+|[^a-z]+")
    plain = tiktoken.Encoding("own", pat_str=r"[a-z]+|[^a-z]+", mergeable_ranks=ranks, special_tokens={})
    for text in ("xyz", "axyz", "xyzxyz", "ababab", "aab", "bab", "abababab ab"):
        assert ids(own, text) == plain.encode_ordinary(text)
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary({b"a": 0})


def expected(plain, text):
    got = plain.encode_ordinary(text or "")
    return len(got), hashlib.sha256(np.array(got, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


@pytest.fixture(scope="module")
def tokenizer(spark):
    return byte_bpe.Tokenizer(spark, public_tokenizers.path(FILES[0]), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def plain():
    ranks = byte_bpe.read_ranks(public_tokenizers.path(FILES[0]))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_whole_table(spark, tokenizer, plain):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in tokenizer.digests(tokenizer.encode(docs)).collect()}
    assert got == {r.doc_id: expected(plain, r.text) for r in docs.select("doc_id", "text").collect()}


def test_edges(spark, tokenizer, plain, monkeypatch):
    rows = [(1, None, 5), (2, "", 5), (None, "a", 5), (3, "x y " * 200_000, 5), (3, "x y " * 200_000, None), (4, "<|endoftext|>", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = tokenizer.digests(tokenizer.encode(docs)).collect()
    assert sorted((tuple(r)[1:] for r in got)) == sorted(expected(plain, t) for _, t, _ in rows)
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _, _ in rows)
    monkeypatch.setattr(byte_bpe, "DECODED", 4)
    decoded = {(r.doc_id, bytes(r.data)) for r in tokenizer.decode(tokenizer.encode(docs)).collect()}
    assert decoded == {(i, (t or "").encode()) for i, t, _ in rows}
    ids = spark.createDataFrame([(1, None), (2, []), (3, [64, None, 10**9])], "doc_id long, ids array<int>")
    assert {r.doc_id: bytes(r.data).decode() for r in tokenizer.decode(ids).collect()} == {1: "", 2: "", 3: "a��"}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokenizer.digests(tokenizer.encode(empty)).count() == tokenizer.decode(tokenizer.encode(empty)).count() == 0


def test_bytes_that_are_not_utf8(spark, tokenizer):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    assert [bytes(r.data) for r in tokenizer.decode(tokenizer.encode(docs)).collect()] == ["a�b".encode()]
