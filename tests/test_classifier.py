import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.checks.adapters import demand_trips
from tripmart.operators import classifier
from tripmart.operators.panel import PanelOptions, build_rush_panel
from tripmart.session import Stage

SF = "/root/testdata/sf0.01"
LAGS = list(classifier.LAG_COLUMNS)


@pytest.fixture(scope="module")
def panel(spark):
    return build_rush_panel(demand_trips(spark, SF), PanelOptions(top_areas=4), Stage(spark)).data


def newton(features, labels, weights, penalties):
    """Minimum of weighted mean log loss plus half the penalised squares; first column is constant."""
    beta = np.zeros(features.shape[1])
    weights = weights / weights.sum()
    for _ in range(60):
        probability = 1 / (1 + np.exp(-features @ beta))
        gradient = features.T @ (weights * (probability - labels)) + penalties * beta
        curvature = weights * probability * (1 - probability)
        hessian = (features * curvature[:, None]).T @ features + np.diag(penalties)
        beta -= np.linalg.solve(hessian, gradient)
    return beta


def one_hot(values, categories):
    return (np.asarray(values)[:, None] == np.asarray(categories)[None, :]).astype(float)


def plain_probabilities(panel, inverse_penalty):
    """The calendar model fitted without Spark."""
    rows = panel.orderBy("area_id", "timestamp_hour").toPandas()
    train = (rows["split"] == "train").to_numpy()
    columns = [np.ones((len(rows), 1))]
    for name in ("area_id", "day_of_week", "hour_of_day", "month_of_year"):
        columns.append(one_hot(rows[name], sorted(rows.loc[train, name].unique())))
    numbers = rows[["is_weekend", *LAGS]].to_numpy(float)
    columns.append((numbers - numbers[train].mean(axis=0)) / numbers[train].std(axis=0, ddof=1))
    features = np.hstack(columns)
    labels = rows["is_rush_area"].to_numpy(float)
    share = labels[train].mean()
    weights = np.where(labels[train] == 1, 0.5 / share, 0.5 / (1 - share))
    penalties = np.full(features.shape[1], 1 / (inverse_penalty * train.sum()))
    penalties[0] = 0
    beta = newton(features[train], labels[train], weights, penalties)
    return 1 / (1 + np.exp(-features @ beta))


def scored_probabilities(model, panel):
    scored = classifier.score(model, panel).orderBy("area_id", "timestamp_hour")
    return np.array([row.y_prob for row in scored.select("y_prob").collect()])


def test_calendar_model_against_newton(panel):
    found = scored_probabilities(classifier.fit_calendar_model(panel), panel)
    assert found == pytest.approx(plain_probabilities(panel, 1.0), abs=2e-3)


def test_rush_model_scores_every_row(panel):
    model = classifier.fit_rush_model(panel)
    scored = classifier.score(model, panel)
    assert scored.columns == [*panel.columns, "y_prob", "y_pred"]
    assert scored.count() == panel.count()
    assert scored.where("(y_prob > 0.5) <> (y_pred = 1)").isEmpty()
    regression = model.stages[-1]
    assert (regression.getMaxIter(), regression.getRegParam()) == (100, 0.01)
    mean = scored.where("split = 'train'").groupBy("is_rush_area").agg(F.avg("y_prob")).orderBy("is_rush_area")
    low, high = (row[1] for row in mean.collect())
    assert high > low


def test_unseen_categories_are_scored(panel):
    model = classifier.fit_rush_model(panel)
    moved = panel.withColumn("area_id", F.lit("elsewhere"))
    assert classifier.score(model, moved).where("y_prob is null").isEmpty()


def test_class_weights(spark):
    rows = [("train", 1)] * 2 + [("train", 0)] * 6 + [("test", 1)] * 9
    panel = spark.createDataFrame(rows, "split string, is_rush_area int")
    weights = classifier.class_weights(panel).first()
    assert (weights.rush_weight, weights.other_weight) == (2.0, 8 / 12)
    assert 2 * weights.rush_weight == pytest.approx(6 * weights.other_weight)
    single = classifier.class_weights(panel.where("is_rush_area = 0")).first()
    assert (single.rush_weight, single.other_weight) == (1.0, 0.5)


def test_certificate_tells_the_optimum(panel):
    model = classifier.fit_rush_model(panel)
    found = {row.term: row for row in classifier.certificate(model, panel).collect()}
    assert max(abs(row.gradient) for row in found.values()) < 1e-4
    train = classifier.train_rows(panel)
    assert found["intercept"].rows == found["lag_24"].rows == train.count()
    assert found["day_of_week=Friday"].rows == train.where("day_of_week = 'Friday'").count()
    assert found["is_weekend"].rush_rows == train.where("is_weekend = 1 and is_rush_area = 1").count()
    early = classifier._fit(panel, classifier.LAG_FEATURES, maxIter=1, regParam=0.01)
    assert max(abs(row.gradient) for row in classifier.certificate(early, panel).collect()) > 1e-3
    lighter = classifier._fit(panel, classifier.LAG_FEATURES, maxIter=100, regParam=0.05)
    lighter.stages[-1].set(lighter.stages[-1].regParam, 0.01)
    assert max(abs(row.gradient) for row in classifier.certificate(lighter, panel).collect()) > 1e-3


def test_scores_after_an_observed_query(spark, panel):
    from pyspark.sql import Observation

    seen = Observation()
    panel.observe(seen, F.count("*").alias("rows")).write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == panel.count()
    model = classifier.fit_rush_model(panel)
    assert not model.stages[-1].hasSummary
    assert classifier.score(model, panel).where("y_prob IS NULL").isEmpty()
    assert classifier.certificate(model, panel).where("abs(gradient) > 1e-4").isEmpty()


def test_certificate_of_the_calendar_model(panel):
    model = classifier.fit_calendar_model(panel)
    found = classifier.certificate(model, panel, classifier.CALENDAR_FEATURES).collect()
    assert max(abs(row.gradient) for row in found) < 1e-4
    assert {"is_weekend", "month_of_year=1", "hour_of_day=0"} <= {row.term for row in found}


def test_certificate_with_one_class(panel):
    quiet = panel.withColumn("is_rush_area", F.lit(0))
    found = classifier.certificate(classifier.fit_rush_model(quiet), quiet).collect()
    assert {row.rush_rows for row in found} == {0}
