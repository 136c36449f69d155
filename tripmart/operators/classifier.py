"""Rush-hour classifier: weighted logistic regression over the demand panel."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from tripmart.operators.panel import LAGS

LABEL = "is_rush_area"
LAG_COLUMNS = tuple(f"lag_{lag}" for lag in LAGS)
TEXT_CATEGORIES = ("area_id", "day_of_week")


@dataclass(frozen=True)
class FeatureSet:
    """``numbers`` are brought to mean 0 and deviation 1; ``plain`` go in as they are."""

    text: tuple[str, ...] = TEXT_CATEGORIES
    codes: tuple[str, ...] = ("hour_of_day",)
    numbers: tuple[str, ...] = LAG_COLUMNS
    plain: tuple[str, ...] = ("is_weekend",)


LAG_FEATURES = FeatureSet()
CALENDAR_FEATURES = FeatureSet(
    codes=("hour_of_day", "month_of_year"), numbers=("is_weekend", *LAG_COLUMNS), plain=()
)


def train_rows(panel: DataFrame) -> DataFrame:
    return panel.where(F.col("split") == "train")


def class_weights(panel: DataFrame) -> DataFrame:
    """One row: train rows per class, and weights that let both classes count the same in total."""
    rush = F.count_if(F.col(LABEL) == 1)
    counts = train_rows(panel).agg(F.count("*").alias("train_rows"), rush.alias("rush_rows"))
    counts = counts.withColumn("other_rows", F.col("train_rows") - F.col("rush_rows"))

    def balanced(rows: str) -> Column:
        return F.when(F.col(rows) > 0, F.col("train_rows") / (2.0 * F.col(rows))).otherwise(1.0)

    return counts.withColumns({"rush_weight": balanced("rush_rows"), "other_weight": balanced("other_rows")})


def category_stages(features: FeatureSet) -> list:
    """Index and one-hot encode; values not seen in training become all zeros."""
    indexers = [
        StringIndexer(inputCol=name, outputCol=f"{name}_idx", handleInvalid="keep") for name in features.text
    ]
    inputs = [f"{name}_idx" for name in features.text] + list(features.codes)
    outputs = [f"{name}_vec" for name in (*features.text, *features.codes)]
    return [*indexers, OneHotEncoder(inputCols=inputs, outputCols=outputs, handleInvalid="keep")]


def number_stages(features: FeatureSet) -> list:
    return [
        VectorAssembler(inputCols=list(features.numbers), outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled_numbers", withMean=True, withStd=True),
    ]


def assemble_stage(features: FeatureSet) -> VectorAssembler:
    vectors = [f"{name}_vec" for name in (*features.text, *features.codes)]
    return VectorAssembler(inputCols=[*vectors, *features.plain, "scaled_numbers"], outputCol="features")


def feature_pipeline(features: FeatureSet = LAG_FEATURES) -> Pipeline:
    return Pipeline(stages=[*category_stages(features), *number_stages(features), assemble_stage(features)])


def weighted_train_rows(panel: DataFrame) -> DataFrame:
    # Class weights are two numbers; fixed here, they cost nothing in the iterations.
    weights = class_weights(panel).first()
    weight = F.when(F.col(LABEL) == 1, weights.rush_weight).otherwise(weights.other_weight)
    return train_rows(panel.withColumn("weight", weight))


def _fit(panel: DataFrame, features: FeatureSet, **settings) -> PipelineModel:
    regression = LogisticRegression(
        featuresCol="features", labelCol=LABEL, weightCol="weight", **settings
    )
    stages = [*feature_pipeline(features).getStages(), regression]
    model = Pipeline(stages=stages).fit(weighted_train_rows(panel))
    # The training summary holds the session and would be sent along with every task that scores; a session that has
    # observed a query can't be sent at all.
    model.stages[-1]._java_obj.setSummary(panel.sparkSession._jvm.scala.Option.empty())
    return model


def fit_rush_model(panel: DataFrame) -> PipelineModel:
    """Lags, area, day and hour; L2 penalty. Pass a staged panel: fitting reads it several times."""
    return _fit(panel, LAG_FEATURES, maxIter=100, regParam=0.01)


def fit_calendar_model(panel: DataFrame, inverse_penalty: float = 1.0) -> PipelineModel:
    """As ``fit_rush_model`` with the month added and the weekend flag scaled.

    The penalty is given as its inverse against the summed loss. Spark weighs it against the mean
    loss, so it is divided by the sum of weights, which for balanced weights is the train row count.
    """
    rows = train_rows(panel).count()
    penalty = 1.0 / (inverse_penalty * max(rows, 1))
    return _fit(panel, CALENDAR_FEATURES, maxIter=1000, regParam=penalty, standardization=False)


def score(model: PipelineModel, panel: DataFrame) -> DataFrame:
    """The panel, train and test rows alike, with the probability of a rush hour and the decision."""
    scored = model.transform(panel).withColumns(
        {
            "y_prob": vector_to_array("probability")[1],
            "y_pred": F.col("prediction").cast("int"),
        }
    )
    return scored.select(*panel.columns, "y_prob", "y_pred")


def term_names(scored: DataFrame, features: FeatureSet) -> list[str]:
    """What each place of the feature vector stands for: ``column=category``, or the column of a number."""
    attributes = scored.schema["features"].metadata["ml_attr"]["attrs"].values()
    names = [a["name"] for a in sorted((a for group in attributes for a in group), key=lambda a: a["idx"])]
    numbers = {f"scaled_numbers_{place}": name for place, name in enumerate(features.numbers)}
    for name in (*features.text, *features.codes):
        names = [found.replace(f"{name}_vec_", f"{name}=", 1) if found.startswith(f"{name}_vec_") else found for found in names]
    return [numbers.get(name, name) for name in names]


def certificate(model: PipelineModel, panel: DataFrame, features: FeatureSet = LAG_FEATURES) -> DataFrame:
    """``term, coefficient, gradient, rows, rush_rows``: whether a fitted model is the optimum, term by term.

    The gradient is that of the mean weighted loss with its penalty, per deviation of the term, worked out anew from the
    coefficients and the train rows of ``panel`` in one pass. The penalised loss is strictly convex, so where
    all gradients are 0 there is no other optimum. ``rows`` are the train rows with the category (all,
    for numbers), ``rush_rows`` those of them in rush. The result has one row a term: areas and a few dozen more.
    """
    regression = model.stages[-1]
    scored = model.transform(weighted_train_rows(panel)).withColumn("y_prob", vector_to_array("probability")[1])
    # Not quite 0 where a class alone is fitted exactly: a sum needs some weight.
    residual = F.greatest(F.col("weight") * F.abs(F.col("y_prob") - F.col(LABEL)), F.lit(1e-300))
    vector = F.col("features")
    sums = scored.groupBy(F.col(LABEL).alias("label")).agg(
        Summarizer.metrics("sum").summary(vector, residual).alias("residuals"),
        Summarizer.metrics("numNonZeros").summary(vector).alias("present"),
        F.sum(residual).alias("residual"),
        F.sum("weight").alias("weight"),
        F.count("*").alias("rows"),
    )
    spread = scored.agg(Summarizer.metrics("std").summary(vector, F.col("weight")).alias("s"))
    classes = sums.collect()
    deviation = spread.first().s.std.toArray()
    total = sum(row.weight for row in classes)
    # The loss of a row falls with the score if it is in rush, and grows with it if not.
    signs = [-1 if row.label == 1 else 1 for row in classes]
    loss = sum(sign * row.residuals.sum.toArray() for sign, row in zip(signs, classes)) / total
    level = sum(sign * row.residual for sign, row in zip(signs, classes)) / total
    places = len(deviation)
    counts = {
        wanted: (
            sum(row.rows for row in classes if row.label in wanted),
            sum((row.present.numNonZeros.toArray() for row in classes if row.label in wanted), np.zeros(places)),
        )
        for wanted in ((0, 1), (1,))
    }
    all_rows = [rows for rows, _ in counts.values()]
    result = [("intercept", float(regression.intercept), float(level), *all_rows)]
    for at, (name, value) in enumerate(zip(term_names(scored, features), regression.coefficients)):
        slope, spread_of = 0.0, deviation[at]
        # A term that never varies has no coefficient and no slope.
        if spread_of:
            scale = spread_of if regression.getStandardization() else 1 / spread_of
            slope = loss[at] / spread_of + regression.getRegParam() * value * scale
        having = all_rows if name in features.numbers else [int(present[at]) for _, present in counts.values()]
        result.append((name, float(value), float(slope), *having))
    return panel.sparkSession.createDataFrame(result, "term string, coefficient double, gradient double, rows long, rush_rows long")
