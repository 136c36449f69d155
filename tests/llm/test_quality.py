import zlib

import numpy as np
import pyarrow as pa

from tripmart.llm import quality

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())
    marks = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    right = np.mean([q == r.predicted for q, r in marks])
    kept = np.mean([r.predicted for q, r in marks if q == 1])
    dropped = np.mean([1 - r.predicted for q, r in marks if q == 0])
    assert right >= 0.97 and kept >= 0.97 and dropped >= 0.9, (right, kept, dropped)


def test_labels_of_held_out_rows_and_negatives_dont_matter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    one = quality.fit(docs, labels)
    other = quality.fit(docs, labels.where(~quality.held_out(labels["doc_id"])))
    assert np.array_equal(one.weights, other.weights)


def test_labels_of_bad_texts_are_not_looked_at(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    one = quality.fit(docs, labels)
    good = labels.where("quality = 1")
    assert np.array_equal(one.weights, quality.fit(docs, good).weights)


def test_prior_is_estimated_from_scores():
    rng = np.random.default_rng(2)
    for share in (0.2, 0.5, 0.8):
        good = rng.normal(2, 1, 4000)
        web = np.where(rng.random(4000) < share, rng.normal(2, 1, 4000), rng.normal(-2, 1, 4000))
        assert abs(quality.class_prior(good, web) - share) < 0.06
    assert quality.class_prior(np.zeros(0), np.ones(3)) == 0.5


def test_non_negative_risk_learns_from_positives_only():
    rng = np.random.default_rng(1)
    width = len(quality.MEASURES)
    good, bad = rng.normal(1, 1, (3000, width)), rng.normal(-1, 1, (1000, width))
    model = quality.train(good[:1500], np.concatenate([good[1500:], bad]), 0.6)
    assert (model.score(good) > 0.5).mean() > 0.95 and (model.score(bad) < 0.5).mean() > 0.95


def test_edges(spark):
    rows = [(1, None, 1), (2, "", 2), (None, "some words here.", 3), (2, "x" * 200_000, 4), (2, "x" * 200_000, 4), (3, "\n\n|||", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1)], "doc_id long, quality int")
    for marks in (labels, labels.limit(0)):
        model = quality.fit(docs, marks)
        got = quality.score(docs, model).collect()
        assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
        assert not any(r.held_out for r in got if r.doc_id is None)
    assert all(r.score == 0.5 for r in got)
    assert quality.score(docs.limit(0), model).count() == 0
    assert quality.fit(docs.limit(0), labels).prior == 0.5
    assert quality.keep_good(docs, model).columns == docs.columns


def test_measures_of_all_texts_at_once_are_those_of_each():
    texts = ["A b. C!", None, "", "aa aa aa | 12", "ÉÉ é", "x\n\ny", "### ###"]
    together = quality.measures(pa.array(texts))
    alone = np.concatenate([quality.measures(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone) and np.isfinite(together).all()
