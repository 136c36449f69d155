import random
import re

import pytest

from tripmart.llm import mixing
from tripmart.session import Stage

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def water_fill(sizes):
    """Targets by repeated sharing of the excess, source by source."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, free, target = float(sum(sizes.values())), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if 3 * sizes[s] < level * weight[s]}
        for s in above or free:
            target[s] = 3.0 * sizes[s] if s in above else level * weight[s]
        left -= sum(target[s] for s in above)
        free = free - above if above else set()
    return target


def check(rows, got, slack):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    target = water_fill(sizes)
    taken = {}
    want = sorted(((i, len(WORD.findall(t or "")), sizes[s], round(target[s], 6)) for i, t, s in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got), key=str) == want
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        key = (r.source_size, round(r.target, 6))
        taken[key] = taken.get(key, 0) + r.taken
    want = {}
    for s in sizes:
        key = (sizes[s], round(target[s], 6))
        want[key] = want.get(key, 0) + target[s]
    for key, total in want.items():
        assert abs(taken[key] - total) <= slack


def corpus():
    rng = random.Random(2)
    sources = ["src0"] * 60 + ["src1", "a", "Ä", "zz", None, "", "tiny"] * 12
    rows = [(i, " ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(0, 300))), s) for i, s in enumerate(sources)]
    return [(i, t if s != "tiny" else "x y", s) for i, t, s in rows] + [(7, None, "a"), (7, " \t", "a"), (None, "b c", "a"), (None, "b c", "a")]


@pytest.mark.parametrize("slots, slack", [(1_000_000, 4), (500, 150)])
def test_targets_and_takes(spark, slots, slack):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS rank").repartition(6)
    first = mixing.mix(df, slots=slots).collect()
    check(rows, first, slack)
    again = mixing.mix(df.repartition(3), slots=slots).collect()
    assert sorted(map(tuple, first), key=str) == sorted(map(tuple, again), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    check(rows, mixing.mix(docs).collect(), 4)


def test_schedule_is_even(spark):
    sources = spark.createDataFrame([(0, 0.0, 10.0), (1, 10.0, 40.0), (2, 40.0, 100.0)], "rank long, low double, high double")
    rows = sorted((r.id, r["rank"]) for r in mixing.schedule(sources, 1000, 100.0).collect())
    assert len(rows) == 1000
    for begin in range(0, 1000, 100):
        part = [r for i, r in rows[begin : begin + 100]]
        assert all(abs(part.count(r) - share) <= 3 for r, share in ((0, 10), (1, 30), (2, 60)))


def test_empty(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string"), Stage(spark)).count() == 0
    only = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    assert [tuple(r) for r in mixing.mix(only).collect()] == [(1, 0, 0, 0.0, 0)]
