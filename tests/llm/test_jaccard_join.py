import random

import pytest
from brute import components

from tripmart.llm import jaccard_join
from tripmart.llm.words import shingles
from tripmart.session import Stage

SF = "/root/testdata/sf0.01"


def joined(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(df).collect()), key=str)


def near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def crowd():
    """Texts that share one passage, near copies at all distances around the limit, and a chain of small steps."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(40)]
    base = [word() for _ in range(120)]
    texts = [" ".join(passage + [word() for _ in range(rng.randrange(0, 60))]) for _ in range(90)]
    texts += [near(rng, base, rng.randrange(0, 9)) for _ in range(90)]
    chain = list(base[:60])
    for i in range(30):
        chain[2 * i] = word()
        texts.append(" ".join(chain))
    texts += [texts[100]] * 20 + ["", " \t ", "one", "one", "one two", "ONE two", "a b c d", "a b c d e"]
    return list(enumerate(texts))


@pytest.mark.parametrize("limit", [64, 2])
def test_same_as_brute_force(spark, crowd, limit, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CROWD", limit)
    got = joined(spark.createDataFrame(crowd, "doc_id long, text string").repartition(5))
    assert got == sorted(((i, *x) for i, x in components(crowd).items()), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = components([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert joined(docs) == sorted(((i, *x) for i, x in expected.items()), key=str)


def test_nulls_repeats_and_other_columns(spark):
    rows = [(1, None, 5), (2, "a b c d e f", None), (None, "a b c d e f", 1), (2, "a b c d e f", 2), (3, "A B C D E F", 3)]
    got = joined(spark.createDataFrame(rows, "doc_id long, text string, n int"))
    assert got == sorted([(1, 0, 1), (2, 2, 2), (2, 2, 2), (3, 2, 2), (None, 2, 2)], key=str)


def test_empty_table(spark):
    assert joined(spark.createDataFrame([], "doc_id long, text string")) == []


def test_components_of_a_long_path(spark):
    from tripmart.llm.staging import components as connected

    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "u long, v long")
    got = {r.node: r.component for r in connected(links, Stage(spark), "path").collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_very_long_text(spark):
    rng = random.Random(1)
    long = " ".join(str(rng.randrange(10**9)) for _ in range(300_000))
    rows = [(1, long), (2, long + " x"), (3, long[: len(long) // 2])]
    assert [(i, c) for i, _, c in joined(spark.createDataFrame(rows, "doc_id long, text string"))] == [(1, 1), (2, 1), (3, 3)]


def test_shingles_follow_the_words():
    import pyarrow as pa

    values, bounds = shingles(pa.array(["A b c d e f", None, "x  a B\tc d e", "b c d e", "\x1ca b c d e"]))
    parts = [list(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    assert [len(p) for p in parts] == [2, 0, 2, 1, 1]
    assert parts[0][0] == parts[2][1] and len({*parts[0], *parts[2], *parts[3], *parts[4]}) == 5


def test_large_regions_without_their_base(spark, monkeypatch):
    """Two texts that differ in a few words, hundreds of edits of each at all distances, and neither text itself."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(130)]
    other = base[:100] + [word() for _ in range(4)] + base[104:]
    texts = [near(rng, base, rng.randrange(2, 11)) for _ in range(300)] + [near(rng, other, rng.randrange(2, 11)) for _ in range(150)]
    seen = []
    inner = jaccard_join._recentred
    monkeypatch.setattr(jaccard_join, "_recentred", lambda members, *a: seen.append(members.count()) or inner(members, *a))
    got = joined(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4))
    assert got == sorted(((i, *x) for i, x in components(list(enumerate(texts))).items()), key=str)
    assert seen[0] > 100
