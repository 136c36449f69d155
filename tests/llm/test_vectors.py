import numpy as np

from tripmart.llm import vectors

SF = "/root/testdata/sf0.01"


def brute(rows, asked, nearest=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for q, v in asked:
        scores = x @ np.array(v, np.float64)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q]
        out[q] = [(int(ids[j]), float(scores[j])) for j in order[:nearest]]
    return out


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def recall(got, want):
    hits = [sum(s >= want[q][-1][1] - 1e-9 for _, s in got.get(q, [])) / len(want[q]) for q in want]
    return float(np.mean(hits))


def test_whole_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = by_query(vectors.search(df, df.where("vec_id % 20 = 0")))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0])
    assert recall(got, want) >= 0.9
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0])) and q not in [i for i, _ in found]


def test_many_shards_and_norms(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 16))
    x = centres[rng.integers(0, 30, 4000)] + 0.4 * rng.standard_normal((4000, 16))
    x *= rng.uniform(0.5, 2, 4000)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(vectors, "SHARD", 1000)
    got = by_query(vectors.search(df, df.where("vec_id % 20 = 0")))
    want = brute(rows, rows[::20])
    assert recall(got, want) >= 0.9


def test_edges(spark):
    same = [(i, [1.0, 0.0]) for i in range(100, 160)]
    rows = [(1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows + same, "vec_id long, embedding array<double>").selectExpr("*", "0 AS id", "1 AS v")
    got = by_query(vectors.search(df, df))
    assert set(got) == {1, *range(100, 160)}
    assert got[1] == [(i, 2.0) for i in range(100, 120)]
    assert got[100] == [(1, 2.0)] + [(i, 1.0) for i in range(101, 120)]
    assert got[150] == [(1, 2.0)] + [(i, 1.0) for i in range(100, 119)]
    assert vectors.search(df.limit(0), df).count() == 0
    assert vectors.search(df, df.limit(0)).count() == 0


def test_stop_is_fitted_where_candidates_are_few(spark, monkeypatch):
    x = np.random.default_rng(5).standard_normal((6000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(vectors, "SHARD", 1000)
    monkeypatch.setattr(vectors, "LEAST", 600)
    got = by_query(vectors.search(df, df.where("vec_id % 20 = 0")))
    assert recall(got, brute(rows, rows[::20])) >= 0.9


def test_one_very_long_vector_leaves_no_query_without_rows(spark, monkeypatch):
    x = np.random.default_rng(6).standard_normal((4000, 16))
    x[17] *= 1000
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(vectors, "SHARD", 250)
    monkeypatch.setattr(vectors, "LEAST", 600)
    scored = vectors._scored
    monkeypatch.setattr(vectors, "_scored", lambda size: _bounded(scored(size), 500))
    got = by_query(vectors.search(df, df.where("vec_id % 20 = 0")))
    want = brute(rows, rows[::20])
    assert {q: len(found) for q, found in got.items()} == dict.fromkeys(want, 20)
    assert recall(got, want) >= 0.9


def _bounded(score, most):
    """Fails where a task is given more than ``most`` points."""

    def check(points, queries):
        assert points.num_rows <= most, points.num_rows
        return score(points, queries)

    return check
