import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tripmart.llm import spelling
from tripmart.llm.staging import Stage


def words_of(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def neighbours(words):
    """By single deletions: near words share one, or one is a deletion of the other."""
    by, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by[w[:i], w[i + 1 :]].add(w)
            if (short := w[:i] + w[i + 1 :]) in words:
                near[w].add(short)
                near[short].add(w)
    for same in by.values():
        for w in same:
            near[w] |= same - {w}
    return near


def grouped(words):
    near = neighbours(words)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(
        ((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()), key=str
    )


def rows(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = words_of(docs.select("doc_id", "text").toLocalIterator())
    assert {r.word: r.n for r in spelling.observed(docs).collect()} == words
    got = rows(spelling.group(spelling.observed(docs)))
    assert got == grouped(words)
    assert any(r[1] for r in got)


def make(seed, alphabet, count, low, high):
    rng = random.Random(seed)
    words = {}
    while len(words) < count:
        word = "".join(rng.choice(alphabet) for _ in range(rng.randrange(low, high)))
        words[word] = rng.choice([1, 2, 9, 10, 90, 100, 5000])
        for _ in range(rng.randrange(3)):
            at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
            changed = word[:at] + rng.choice(alphabet) * (kind > 0) + word[at + (kind < 2) :]
            if changed:
                words[changed] = rng.choice([1, 3, 30, 1000])
    return words


@pytest.mark.parametrize(("alphabet", "low", "high"), [("ab", 1, 12), ("abcé", 6, 10), ("abcdefghij", 7, 14), ("a", 1, 60)])
def test_all_near_words_are_found(spark, monkeypatch, alphabet, low, high):
    words = make(low + high, alphabet, 50 if alphabet == "a" else 900, low, high)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = grouped(words)
    assert rows(spelling.group(df)) == want
    monkeypatch.setattr(spelling, "LONG", 2)
    monkeypatch.setattr(spelling, "RARE", 3)
    assert rows(spelling.group(df)) == want


def test_grams_left_by_an_edit_are_listed():
    rng = random.Random(3)
    for _ in range(2000):
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(7, 14)))
        at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
        other = word[:at] + rng.choice("abc") * (kind > 0) + word[at + (kind < 2) :]
        frequent = {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 5))): rng.randrange(20) for _ in range(15)}
        keys = [
            {k for b, e in spelling.listed(w, frequent) for k in (("L", w[:e]), ("R", w[b:]))} for w in (word, other)
        ]
        assert word == other or keys[0] & keys[1]


def test_long_lists_are_divided(spark, tmp_path):
    """Words of one beginning: their number of members grows in proportion, and so does what is compared."""
    rng = random.Random(1)
    words = {"internationalis" + "".join(rng.choice("abcdefghijklmnop") for _ in range(3)): 2 for _ in range(3000)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    stage = Stage(spark, str(tmp_path))
    assert rows(spelling.group(df, stage)) == grouped(words)
    members = spark.read.parquet(stage.path("divided"))
    sizes = [r["count"] for r in members.groupBy("key").count().collect()]
    assert max(sizes) <= spelling.LONG
    assert members.count() <= 60 * len(words)


def test_dictionary_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(spelling, "DICTIONARY", 20)
    monkeypatch.setattr(spelling, "RARE", 0)
    words = make(5, "abcdef", 2000, 7, 12)
    frequent = spelling.frequent_grams(spark.createDataFrame(list(words.items()), "word string, n long"))
    for size in (2, 3, 4):
        assert sum(len(gram) == size for gram in frequent) <= 20


def test_shortened_rests():
    for a, b, one in (("abc", "abd", True), ("abc", "ab", True), ("abc", "abdd", False), ("", "a", True), ("ab", "ba", True)):
        parts, owner = spelling.shortened([a, "other", b])
        assert bool(np.intersect1d(parts[owner == 0], parts[owner == 2]).size) == one
    assert len(spelling.shortened(["é" * 50_000])[0]) == 2
    assert len(spelling.shortened([])[0]) == 0


def test_edges(spark):
    long = "x" * 30_000
    docs = [(1, None), (2, ""), (None, "Variants variants VARIANTS variant"), (3, "Éléphant éléphant Éléphant " * 3), (3, long), (3, long), (4, f"{long}y")]
    df = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, n int")
    assert rows(spelling.group(spelling.observed(df))) == grouped(words_of(docs))
    repeated = spark.createDataFrame([("variant", 1), ("variant", 2), ("variants", 30), (None, 5), ("", 1)], "word string, n long")
    assert rows(spelling.group(repeated)) == grouped({"variant": 3, "variants": 30, "": 1})
    assert spelling.group(spelling.observed(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_chains_of_forms(spark):
    words = {"abcdefgh"[:k] + "h" * (20 - k): 10**k for k in range(8)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = rows(spelling.group(df))
    assert got == grouped(words)
    assert {r[2] for r in got} == {max(words, key=words.get)}
