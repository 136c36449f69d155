"""Exact classifier metrics and curves, and the views of one scored hour.

Scored rows have ``split``, ``is_rush_area`` (0 or 1), ``y_pred`` and ``y_prob``. Rows are first
summed to distinct scores, so curves and areas cost what the number of distinct scores costs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tripmart.functions.trips import ratio
from tripmart.operators.panel import HOUR
from tripmart.session import Stage

# Map colours by upper end of probability, and the texts for rush and other hours.
PROBABILITY_COLORS = ((0.2, "blue"), (0.4, "cyan"), (0.6, "yellow"), (0.8, "orange"))
HIGHEST_COLOR = "red"
SPLITS = ("train", "test")
RUSH_TEXT = "🔴 Cao điểm"
OTHER_TEXT = "🟢 Bình thường"


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def both_splits(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, SPLITS))).alias("split"))


def outcome_counts(scored: DataFrame) -> DataFrame:
    """Per split: true and false positives and negatives; 0 for a split without rows."""
    actual, predicted = F.col("is_rush_area") == 1, F.col("y_pred") == 1
    counts = scored.groupBy("split").agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )
    return both_splits(scored.sparkSession).join(counts, "split", "left").fillna(0, ["tp", "fp", "fn", "tn"])


def precision_recall_f1(scored: DataFrame) -> DataFrame:
    """Per split, for the rush class; 0 where a ratio has nothing below the line."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return outcome_counts(scored).select(
        "split",
        F.round(or_zero(ratio(tp, tp + fp)), 4).alias("precision"),
        F.round(or_zero(ratio(tp, tp + fn)), 4).alias("recall"),
        F.round(or_zero(ratio(2 * tp, 2 * tp + fp + fn)), 4).alias("f1"),
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Four rows per split, cells without any row included."""

    def cell(actual: int, predicted: int, count: str) -> Column:
        return F.struct(
            F.lit(actual).alias("actual"), F.lit(predicted).alias("predicted"), F.col(count).alias("rows")
        )

    cells = F.array(cell(0, 0, "tn"), cell(0, 1, "fp"), cell(1, 0, "fn"), cell(1, 1, "tp"))
    return outcome_counts(scored).select("split", F.inline(cells))


def score_ladder(scored: DataFrame, stage: Stage) -> DataFrame:
    """Distinct scores per split, highest first, with counts at and running counts down to each.

    A running sum over a whole split would put it into one task. Scores are therefore cut into ranges
    by split and score, sums run within each range, and the sums of the ranges before are added.
    Adaptive execution sizes the ranges; they are staged, so that both steps see the same ones. Adds
    ``next_pos`` and ``next_neg``, the counts one score further down.
    """
    positive = F.sum("is_rush_area").alias("pos")
    negative = F.sum(1 - F.col("is_rush_area")).alias("neg")
    counts = scored.groupBy("split", F.col("y_prob").alias("score")).agg(positive, negative)
    cut = counts.repartitionByRange("split", F.desc("score"))
    cut = stage.table(cut.withColumn("range", F.spark_partition_id()), "score_ranges")

    range_sums = cut.groupBy("split", "range").agg(
        F.sum("pos").alias("range_pos"),
        F.sum("neg").alias("range_neg"),
        F.max_by(F.struct("pos", "neg"), "score").alias("head"),
    )
    in_split = Window.partitionBy("split").orderBy("range")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("split")
    # At most as many rows per split as there are ranges, so this is small whatever was scored.
    offsets = range_sums.select(
        "split",
        "range",
        F.coalesce(F.sum("range_pos").over(before), F.lit(0)).alias("pos_before"),
        F.coalesce(F.sum("range_neg").over(before), F.lit(0)).alias("neg_before"),
        F.sum("range_pos").over(whole).alias("all_pos"),
        F.sum("range_neg").over(whole).alias("all_neg"),
        F.lead("head").over(in_split).alias("next_head"),
    )
    down = Window.partitionBy("split", "range").orderBy(F.desc("score"))
    running = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.coalesce(F.lead(F.struct("pos", "neg")).over(down), F.col("next_head"))
    ladder = cut.join(offsets, ["split", "range"])
    return ladder.select(
        "split",
        "score",
        "pos",
        "neg",
        (F.sum("pos").over(running) + F.col("pos_before")).alias("tp"),
        (F.sum("neg").over(running) + F.col("neg_before")).alias("fp"),
        "all_pos",
        "all_neg",
        step.getField("pos").alias("next_pos"),
        step.getField("neg").alias("next_neg"),
    )


def roc_auc(ladder: DataFrame) -> DataFrame:
    """Exact area under the ROC curve per split, equal scores half counted; 0.5 for one class."""
    pairs_won = (F.col("tp") - F.col("pos") / 2.0) * F.col("neg")
    pairs = F.max(F.col("all_pos") * F.col("all_neg"))
    area = F.coalesce(ratio(F.sum(pairs_won), pairs), F.lit(0.5))
    return ladder.groupBy("split").agg(F.round(area, 4).alias("roc_auc"))


def average_precision(ladder: DataFrame) -> DataFrame:
    """Precision at each score weighted by the recall gained there; 0 for one class."""
    gained = F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))
    both = (F.max("all_pos") > 0) & (F.max("all_neg") > 0)
    area = F.when(both, ratio(F.sum(gained), F.max("all_pos"))).otherwise(0.0)
    return ladder.groupBy("split").agg(F.round(area, 4).alias("pr_auc"))


def both_classes(ladder: DataFrame) -> DataFrame:
    return ladder.where((F.col("all_pos") > 0) & (F.col("all_neg") > 0))


def roc_curve(ladder: DataFrame, corners_only: bool = False) -> DataFrame:
    """Points per split from (0, 0), which has no threshold, down the scores.

    Splits with one class have no curve. ``corners_only`` leaves out points on the straight line
    between their neighbours, which changes neither the curve nor its area.
    """
    points = both_classes(ladder)
    origin = points.groupBy("split").agg(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(None).cast("double").alias("threshold")
    )
    if corners_only:
        same_step = F.col("next_pos").eqNullSafe(F.col("pos")) & F.col("next_neg").eqNullSafe(F.col("neg"))
        first = F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")
        points = points.where(~same_step | first)
    return origin.unionByName(
        points.select(
            "split",
            (F.col("fp") / F.col("all_neg")).alias("fpr"),
            (F.col("tp") / F.col("all_pos")).alias("tpr"),
            F.col("score").alias("threshold"),
        )
    )


def precision_recall_curve(ladder: DataFrame) -> DataFrame:
    """Points per split down the scores, and the end point (recall 0, precision 1)."""
    points = both_classes(ladder)
    end = points.groupBy("split").agg(
        F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"), F.lit(None).cast("double").alias("threshold")
    )
    return end.unionByName(
        points.select(
            "split",
            (F.col("tp") / F.col("all_pos")).alias("recall"),
            (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
            F.col("score").alias("threshold"),
        )
    )


def metrics_table(scored: DataFrame, stage: Stage) -> DataFrame:
    """One row per split with all five metrics."""
    ladder = score_ladder(scored, stage)
    parts = [precision_recall_f1(scored), roc_auc(ladder), average_precision(ladder)]
    joined = reduce(lambda left, right: left.join(right, "split", "left"), parts)
    # A split without rows has one class at most: no ranking to speak of.
    return joined.fillna({"roc_auc": 0.5, "pr_auc": 0.0}).withColumn("split", F.initcap("split"))


def snapshot_hour(scored: DataFrame, method: str = "middle") -> DataFrame:
    """One row: an hour in the midst of the test hours.

    ``middle`` takes the hour at half of the sorted distinct hours; ``median`` may fall between two.
    """
    hours = scored.where(F.col("split") == "test").select(HOUR).distinct()
    if method == "median":
        middle = F.percentile(F.unix_seconds(HOUR), 0.5)
        return hours.agg(F.timestamp_seconds(middle).alias("snapshot_hour"))
    # Counted from the last hour, so of two middle ones it is the later.
    later = F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY unix_seconds({HOUR}) DESC)")
    return hours.agg(F.timestamp_seconds(later.cast("long")).alias("snapshot_hour"))


def scored_hour(scored: DataFrame, hour: str | Column, centroids: DataFrame) -> DataFrame:
    """Scored rows of one hour with their places; no rows when the hour is not in the panel."""
    at = F.lit(hour).cast("timestamp") if isinstance(hour, str) else hour
    return scored.where(F.col(HOUR) == at).join(centroids, "area_id")


def top_rush_at_hour(
    scored: DataFrame, hour: str | Column, centroids: DataFrame, top_n: int = 15
) -> DataFrame:
    """The areas most likely in rush at an hour; ties by area id."""
    rows = scored_hour(scored, hour, centroids).select(
        "area_id", "demand_count", "rush_threshold", "is_rush_area", "y_prob", "y_pred", "lat", "lng"
    )
    return rows.orderBy(F.desc("y_prob"), "area_id").limit(top_n)


def probability_color(probability: str = "y_prob") -> Column:
    color = F.lit(HIGHEST_COLOR)
    for upper, name in reversed(PROBABILITY_COLORS):
        color = F.when(F.col(probability) < upper, name).otherwise(color)
    return color


def rush_map_layer(scored: DataFrame, hour: str | Column, centroids: DataFrame) -> DataFrame:
    """Circle per area at an hour: place, colour, the values and texts shown for it, and the centre of
    the whole map."""

    def text(column: str) -> Column:
        return F.when(F.col(column) == 1, RUSH_TEXT).otherwise(OTHER_TEXT)

    rows = scored_hour(scored, hour, centroids)
    center = rows.agg(F.struct(F.avg("lat").alias("map_lat"), F.avg("lng").alias("map_lng")).alias("c")).scalar()
    return rows.select(
        "area_id",
        "lat",
        "lng",
        F.lit(10).alias("radius"),
        probability_color().alias("color"),
        "demand_count",
        "rush_threshold",
        text("is_rush_area").alias("actual_label"),
        text("y_pred").alias("predicted_label"),
        F.round("y_prob", 4).alias("probability"),
        center.getField("map_lat").alias("map_lat"),
        center.getField("map_lng").alias("map_lng"),
    )
