import random
from datetime import datetime, timedelta

import pytest

from tripmart.operators import evaluation
from tripmart.session import Stage

SCHEMA = "split string, is_rush_area int, y_pred int, y_prob double"


def brute_roc_auc(rows):
    pos = [score for label, score in rows if label]
    neg = [score for label, score in rows if not label]
    if not pos or not neg:
        return 0.5
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def brute_curve(rows):
    """Cumulative true and false positives at each distinct score."""
    points, tp, fp = [], 0, 0
    for score in sorted({score for _, score in rows}, reverse=True):
        tp += sum(1 for label, s in rows if s == score and label)
        fp += sum(1 for label, s in rows if s == score and not label)
        points.append((score, tp, fp))
    return points


def brute_average_precision(rows):
    total = sum(label for label, _ in rows)
    if total in (0, len(rows)):
        return 0.0
    area, before = 0.0, 0
    for _, tp, fp in brute_curve(rows):
        area += (tp - before) / total * tp / (tp + fp)
        before = tp
    return area


@pytest.fixture(params=["one range", "many ranges"])
def ranges(request, conf):
    if request.param == "many ranges":
        conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
        conf("spark.sql.shuffle.partitions", "13")
    return request.param


@pytest.fixture
def scored():
    generator = random.Random(7)
    rows = []
    for split, count in (("train", 900), ("test", 350)):
        for _ in range(count):
            label = int(generator.random() < 0.3)
            score = round(min(1.0, max(0.0, generator.gauss(0.4 + 0.2 * label, 0.2))), 2)
            # A third of all rows share one score.
            score = 0.5 if generator.random() < 0.33 else score
            rows.append((split, label, int(score >= 0.5), score))
    return rows


def per_split(rows, split):
    return [(label, score) for name, label, _, score in rows if name == split]


def test_areas_by_brute_force(spark, scored, ranges):
    ladder = evaluation.score_ladder(spark.createDataFrame(scored, SCHEMA), Stage(spark))
    roc = {row.split: row.roc_auc for row in evaluation.roc_auc(ladder).collect()}
    pr = {row.split: row.pr_auc for row in evaluation.average_precision(ladder).collect()}
    for split in ("train", "test"):
        assert roc[split] == pytest.approx(brute_roc_auc(per_split(scored, split)), abs=5.1e-5)
        assert pr[split] == pytest.approx(brute_average_precision(per_split(scored, split)), abs=5.1e-5)


def test_ranges_are_many_when_asked_for(spark, scored, ranges):
    stage = Stage(spark)
    evaluation.score_ladder(spark.createDataFrame(scored, SCHEMA), stage)
    used = spark.read.parquet(stage.path("score_ranges")).select("range").distinct().count()
    assert used == 1 if ranges == "one range" else used > 5


def test_curves_by_brute_force(spark, scored, ranges):
    ladder = evaluation.score_ladder(spark.createDataFrame(scored, SCHEMA), Stage(spark))
    roc = {tuple(row) for row in evaluation.roc_curve(ladder).collect()}
    pr = {tuple(row) for row in evaluation.precision_recall_curve(ladder).collect()}
    expected_roc, expected_pr = set(), set()
    for split in ("train", "test"):
        rows = per_split(scored, split)
        positives = sum(label for label, _ in rows)
        negatives = len(rows) - positives
        expected_roc.add((split, 0.0, 0.0, None))
        expected_pr.add((split, 0.0, 1.0, None))
        for score, tp, fp in brute_curve(rows):
            expected_roc.add((split, fp / negatives, tp / positives, score))
            expected_pr.add((split, tp / positives, tp / (tp + fp), score))
    assert roc == expected_roc
    assert pr == expected_pr


def test_corners_keep_the_curve(spark, ranges):
    labels = [1, 1, 1, 0, 1, 0, 1, 0, 0, 0, 0]
    rows = [("train", label, 0, 1 - at / 20) for at, label in enumerate(labels)]
    ladder = evaluation.score_ladder(spark.createDataFrame(rows, SCHEMA), Stage(spark))
    corners = evaluation.roc_curve(ladder, corners_only=True).orderBy("fpr", "tpr").collect()
    hits = [(round(row.fpr * 6), round(row.tpr * 5)) for row in corners]
    assert hits == [(0, 0), (0, 1), (0, 3), (1, 3), (1, 4), (2, 4), (2, 5), (6, 5)]


def test_splits_with_one_class(spark):
    rows = [("train", 0, 1, 0.7), ("train", 0, 0, 0.2), ("test", 1, 0, 0.3), ("test", 1, 1, 0.9)]
    metrics = evaluation.metrics_table(spark.createDataFrame(rows, SCHEMA), Stage(spark))
    table = {row.split: row.asDict() for row in metrics.collect()}
    assert table["Train"] == {
        "split": "Train", "precision": 0.0, "recall": 0.0, "f1": 0.0, "roc_auc": 0.5, "pr_auc": 0.0,
    }
    assert table["Test"] == {
        "split": "Test", "precision": 1.0, "recall": 0.5, "f1": 0.6667, "roc_auc": 0.5, "pr_auc": 0.0,
    }
    ladder = evaluation.score_ladder(spark.createDataFrame(rows, SCHEMA), Stage(spark))
    assert evaluation.roc_curve(ladder).isEmpty() and evaluation.precision_recall_curve(ladder).isEmpty()


def test_confusion_keeps_empty_cells(spark):
    rows = [("train", 1, 1, 0.9), ("train", 1, 1, 0.8), ("train", 0, 1, 0.6)]
    cells = evaluation.confusion_matrix(spark.createDataFrame(rows, SCHEMA))
    assert {(row.actual, row.predicted): row.rows for row in cells.collect()} == {
        (0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 2,
    }


START = datetime(2024, 3, 1)


@pytest.fixture
def scored_hours(spark):
    def make(hours):
        rows = [
            (split, START + timedelta(hours=hour), area, 4, 3, 1, int(prob >= 0.5), prob)
            for split, hour in hours
            for area, prob in (("a", 0.1), ("b", 0.39), ("c", 0.39), ("d", 0.6), ("e", 0.8), ("lost", 1.0))
        ]
        return spark.createDataFrame(
            rows,
            "split string, timestamp_hour timestamp, area_id string, demand_count bigint, "
            "rush_threshold bigint, is_rush_area int, y_pred int, y_prob double",
        )

    return make


@pytest.fixture
def places(spark):
    rows = [(area, 40.0 + at, -73.0) for at, area in enumerate("abcde")]
    return spark.createDataFrame(rows, "area_id string, lat double, lng double")


@pytest.mark.parametrize(
    "test_hours, middle, median", [([5, 6, 7], 6, 6), ([5, 6, 7, 8], 7, 6.5), ([5, 6, 20], 6, 6), ([9], 9, 9)]
)
def test_snapshot_hour(scored_hours, test_hours, middle, median):
    scored = scored_hours([("train", 0), ("train", 1)] + [("test", hour) for hour in test_hours])
    assert evaluation.snapshot_hour(scored).first()[0] == START + timedelta(hours=middle)
    assert evaluation.snapshot_hour(scored, "median").first()[0] == START + timedelta(hours=median)


def test_snapshot_without_test_hours(scored_hours):
    assert evaluation.snapshot_hour(scored_hours([("train", 0)])).first()[0] is None


def test_top_areas_at_an_hour(scored_hours, places):
    scored = scored_hours([("test", 5), ("test", 6)])
    rows = evaluation.top_rush_at_hour(scored, "2024-03-01 05:00:00", places, top_n=4).collect()
    assert [row.area_id for row in rows] == ["e", "d", "b", "c"]
    absent = evaluation.top_rush_at_hour(scored, "2024-03-01 09:00:00", places)
    assert absent.isEmpty() and len(absent.columns) == 8


def test_map_of_an_hour(scored_hours, places):
    rows = evaluation.rush_map_layer(scored_hours([("test", 5)]), "2024-03-01 05:00:00", places).collect()
    assert {row.area_id: row.color for row in rows} == {
        "a": "blue", "b": "cyan", "c": "cyan", "d": "orange", "e": "red",
    }
    assert {row.predicted_label for row in rows if row.area_id in "de"} == {evaluation.RUSH_TEXT}
    assert {row.actual_label for row in rows} == {evaluation.RUSH_TEXT}
    assert {(row.map_lat, row.map_lng) for row in rows} == {(42.0, -73.0)}
