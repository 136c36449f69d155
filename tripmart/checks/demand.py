"""Checks of the demand panel, the classifier and the evaluation.

The evaluation is checked on a score computed from the lags, so that SQL can follow it. A fitted model is checked by
what SQL can list (terms, rows, classes) together with whether it is the optimum, whether its scores follow from its
coefficients, and whether other formulas give its metrics.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tripmart.checks.adapters import DEMAND_SQL, SILVER_SQL, demand_trips, raw_trips
from tripmart.checks.registry import check, half_up, time_text
from tripmart.functions.geo import area_id
from tripmart.operators import classifier, evaluation, panel as panels
from tripmart.operators.panel import HOUR, PanelOptions
from tripmart.operators.silver import write_silver
from tripmart.session import Stage
from tripmart.sources.tables import Lakehouse

TRAIN_TOP = PanelOptions(top_areas=5)
ALL_TOP = PanelOptions(top_areas=5, scope="all", spine="top_areas", quantile="exact")
SCORE = "lag_1 / (lag_1 + lag_2 + lag_24 + 1.0D)"
SCORE_SQL = "lag_1 / (lag_1 + lag_2 + lag_24 + 1.0e0)"
CUTOFF = 0.35


def panel_sql(options: PanelOptions) -> str:
    """CTEs up to ``panel``, with the settings of ``options``."""
    everywhere = options.scope == "all"
    spine_from = "dem" if options.spine == "top_areas" else "d"
    area_hours = "" if everywhere else "and d.h < (select t from sp)"
    quantile = "quantile_cont" if options.quantile == "exact" else "quantile_disc"
    hours = f"""hr as (select unnest(generate_series((select min(h) from {spine_from}),
      (select max(h) from {spine_from}), interval 1 hour)) as h),
    ix as (select h, row_number() over (order by h) - 1 as i, count(*) over () as n from hr),
    sp as (select min(h) as t from ix where i = cast(floor(n * cast(0.8 as double)) as bigint))"""
    top = f"""top as (select area_id, count(*) as trips from d where area_id is not null {area_hours}
      group by area_id order by trips desc, area_id limit {options.top_areas}),
    dem as (select h, area_id, count(*) as n from d where area_id in (select area_id from top)
      group by h, area_id)"""
    steps = f"{top}, {hours}" if everywhere else f"{hours}, {top}"
    return f"""{DEMAND_SQL},
    d as (select concat(cast(floor(start_lat * 100) / 100 as varchar), '_',
        cast(floor(start_lng * 100) / 100 as varchar)) as area_text,
      case when start_lat is not null and start_lng is not null then area_text end as area_id,
      date_trunc('hour', started_at) as h, start_lat, start_lng from demand_trips),
    {steps},
    grid as (select hr.h, top.area_id, coalesce(dem.n, 0) as demand_count
      from hr cross join top left join dem on dem.h = hr.h and dem.area_id = top.area_id),
    lagged as (select *, case when h < (select t from sp) then 'train' else 'test' end as split,
      coalesce(lag(demand_count, 1) over w, 0) as lag_1, coalesce(lag(demand_count, 2) over w, 0) as lag_2,
      coalesce(lag(demand_count, 24) over w, 0) as lag_24,
      coalesce(lag(demand_count, 168) over w, 0) as lag_168
      from grid window w as (partition by area_id order by h)),
    limits as (select area_id, {quantile}(demand_count, 0.9) as q from lagged where split = 'train'
      group by area_id),
    panel as (select lagged.h as timestamp_hour, lagged.area_id, demand_count,
      cast(hour(lagged.h) as integer) as hour_of_day, dayname(lagged.h) as day_of_week,
      cast(month(lagged.h) as integer) as month_of_year,
      cast(dayofweek(lagged.h) + 1 as integer) as day_of_week_num,
      case when dayofweek(lagged.h) in (0, 6) then 1 else 0 end as is_weekend,
      lag_1, lag_2, lag_24, lag_168, split, greatest(q, 3) as rush_threshold,
      case when demand_count >= greatest(q, 3) then 1 else 0 end as is_rush_area
      from lagged left join limits on limits.area_id = lagged.area_id),
    centroids as (select area_id, avg(start_lat) as lat, avg(start_lng) as lng from d
      where area_id is not null group by area_id)"""


PANEL_SQL = panel_sql(TRAIN_TOP)
PANEL_SELECT = f"select * replace ({time_text('timestamp_hour')} as timestamp_hour) from panel"
SCORED_SQL = f"""{PANEL_SQL},
    scored as (select *, {SCORE_SQL} as y_prob,
      case when {SCORE_SQL} >= {CUTOFF} then 1 else 0 end as y_pred from panel)"""
LADDER_SQL = f"""{SCORED_SQL},
    counts as (select split, y_prob as score, sum(is_rush_area) as pos, sum(1 - is_rush_area) as neg
      from scored group by split, y_prob),
    ladder as (select *, sum(pos) over w as tp, sum(neg) over w as fp,
      sum(pos) over (partition by split) as all_pos, sum(neg) over (partition by split) as all_neg,
      lead(pos) over w as next_pos, lead(neg) over w as next_neg
      from counts window w as (partition by split order by score desc))"""


def demand(spark, sf_dir) -> DataFrame:
    return panels.demand_by_area_hour(demand_trips(spark, sf_dir))


def rush_panel(spark, sf_dir, options: PanelOptions = TRAIN_TOP) -> panels.RushPanel:
    return panels.build_rush_panel(demand_trips(spark, sf_dir), options, Stage(spark))


def with_rule_score(panel: DataFrame) -> DataFrame:
    scored = panel.withColumn("y_prob", F.expr(SCORE))
    return scored.withColumn("y_pred", (F.col("y_prob") >= CUTOFF).cast("int"))


def scored_panel(spark, sf_dir) -> DataFrame:
    return with_rule_score(rush_panel(spark, sf_dir).data)


def ladder(spark, sf_dir) -> DataFrame:
    stage = Stage(spark)
    panel = panels.build_rush_panel(demand_trips(spark, sf_dir), TRAIN_TOP, stage)
    return evaluation.score_ladder(with_rule_score(panel.data), stage)


@check("grid_area_id", f"with {PANEL_SQL} select area_id, count(*) as trips from d group by area_id")
def grid_area_id_check(spark, sf_dir):
    areas = demand_trips(spark, sf_dir).select(area_id().alias("area_id"))
    return areas.groupBy("area_id").agg(F.count("*").alias("trips"))


@check("truncate_hour", f"with {PANEL_SQL} select {time_text('h')} as timestamp_hour, start_lat from d")
def truncate_hour_check(spark, sf_dir):
    return demand_trips(spark, sf_dir).select(panels.truncate_hour().alias(HOUR), "start_lat")


@check(
    "demand_by_area_hour",
    f"""with {PANEL_SQL} select area_id, {time_text('h')} as timestamp_hour, count(*) as demand_count
    from d group by area_id, h""",
)
def demand_by_area_hour_check(spark, sf_dir):
    return demand(spark, sf_dir).select("area_id", HOUR, "demand_count")


@check("hour_spine", f"with {PANEL_SQL} select {time_text('h')} as timestamp_hour from hr")
def hour_spine_check(spark, sf_dir):
    return panels.hour_spine(panels.hour_range(demand(spark, sf_dir)))


@check(
    "time_split",
    f"""with {PANEL_SQL} select {time_text('min(h)')} as first_hour, {time_text('max(h)')} as last_hour,
    count(*) as hours, {time_text('(select t from sp)')} as split_hour from hr""",
)
def time_split_check(spark, sf_dir):
    return panels.hour_range(demand(spark, sf_dir))


@check("top_areas", f"with {PANEL_SQL} select area_id, trips from top")
def top_areas_check(spark, sf_dir):
    counted = demand(spark, sf_dir)
    split_hour = panels.hour_range(counted).select("split_hour").scalar()
    return panels.top_areas(counted, 5, before=split_hour)


@check(
    "semi_filter_top_areas",
    f"""with {PANEL_SQL} select area_id, {time_text('h')} as timestamp_hour, n as demand_count from dem""",
)
def semi_filter_top_areas_check(spark, sf_dir):
    counted = demand(spark, sf_dir)
    split_hour = panels.hour_range(counted).select("split_hour").scalar()
    areas = panels.top_areas(counted, 5, before=split_hour)
    return panels.keep_areas(counted, areas).select("area_id", HOUR, "demand_count")


@check(
    "dense_panel",
    f"""with {PANEL_SQL} select area_id, {time_text('h')} as timestamp_hour, demand_count from grid""",
)
def dense_panel_check(spark, sf_dir):
    counted = demand(spark, sf_dir)
    hours = panels.hour_range(counted)
    areas = panels.top_areas(counted, 5, before=hours.select("split_hour").scalar())
    return panels.dense_panel(panels.keep_areas(counted, areas), areas, hours)


@check(
    "panel_calendar",
    f"""with {PANEL_SQL} select distinct {time_text('timestamp_hour')} as timestamp_hour, hour_of_day,
    day_of_week, month_of_year, day_of_week_num, is_weekend from panel""",
)
def panel_calendar_check(spark, sf_dir):
    return panels.add_calendar(panels.hour_spine(panels.hour_range(demand(spark, sf_dir))))


@check(
    "panel_lags",
    f"""with {PANEL_SQL} select area_id, {time_text('timestamp_hour')} as timestamp_hour, lag_1, lag_2,
    lag_24, lag_168 from panel""",
)
def panel_lags_check(spark, sf_dir):
    data = rush_panel(spark, sf_dir).data.select("area_id", HOUR, "demand_count")
    return panels.add_lags(data).drop("demand_count")


@check(
    "rush_threshold_approx",
    f"with {PANEL_SQL} select distinct area_id, rush_threshold from panel",
)
def rush_threshold_approx_check(spark, sf_dir):
    return rush_panel(spark, sf_dir).data.select("area_id", "rush_threshold").distinct()


@check(
    "rush_threshold_exact",
    f"with {panel_sql(ALL_TOP)} select distinct area_id, rush_threshold from panel",
)
def rush_threshold_exact_check(spark, sf_dir):
    return rush_panel(spark, sf_dir, ALL_TOP).data.select("area_id", "rush_threshold").distinct()


@check(
    "rush_label",
    f"""with {PANEL_SQL} select split, is_rush_area, count(*) as rows, cast(sum(demand_count) as bigint)
    as demand from panel group by split, is_rush_area""",
)
def rush_label_check(spark, sf_dir):
    data = panels.add_rush_label(rush_panel(spark, sf_dir).data.drop("is_rush_area"))
    return data.groupBy("split", "is_rush_area").agg(
        F.count("*").alias("rows"), F.sum("demand_count").alias("demand")
    )


@check(
    "area_centroids",
    f"with {PANEL_SQL} select area_id, round(lat, 6) as lat, round(lng, 6) as lng from centroids",
)
def area_centroids_check(spark, sf_dir):
    centers = panels.area_centroids(demand(spark, sf_dir))
    return centers.select("area_id", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"))


@check("rush_panel", f"with {PANEL_SQL} {PANEL_SELECT}")
def rush_panel_check(spark, sf_dir):
    return rush_panel(spark, sf_dir).data


@check("rush_panel_whole_period", f"with {panel_sql(ALL_TOP)} {PANEL_SELECT}")
def rush_panel_whole_period_check(spark, sf_dir):
    return rush_panel(spark, sf_dir, ALL_TOP).data


SILVER_STARTS = "demand_trips as (select started_at, start_lat, start_lng from silver)"


@check("rush_panel_of_silver", f"with {SILVER_SQL}, {PANEL_SQL.replace(DEMAND_SQL, SILVER_STARTS)} {PANEL_SELECT}")
def rush_panel_of_silver_check(spark, sf_dir):
    """From raw trips through a stored Silver table."""
    lakehouse = Lakehouse(spark, Stage(spark).root)
    lakehouse.write(raw_trips(spark, sf_dir), "bronze")
    write_silver(lakehouse)
    return panels.build_rush_panel(lakehouse.read("silver"), TRAIN_TOP).data


@check(
    "split_summary",
    f"""with {PANEL_SQL} select case split when 'train' then 'Train' else 'Test' end as split,
    {time_text('min(timestamp_hour)')} as start_time, {time_text('max(timestamp_hour)')} as end_time,
    count(*) as total_rows from panel group by split""",
)
def split_summary_check(spark, sf_dir):
    return panels.split_summary(rush_panel(spark, sf_dir).data)


@check(
    "panel_summary",
    f"""with {PANEL_SQL}, a as (select area_id, max(rush_threshold) as threshold from panel group by area_id),
    t as (select count(distinct area_id) as areas, count(*) as total_rows,
      cast(sum(is_rush_area) as bigint) as rush_rows from panel)
    select *, {half_up("rush_rows * 100.0e0 / total_rows", 2)} as rush_pct,
      (select quantile_cont(threshold, 0.5) from a) as median_threshold,
      printf('%d (%.2f%%)', rush_rows, rush_rows * 100.0e0 / total_rows) as rush_text from t""",
)
def panel_summary_check(spark, sf_dir):
    return panels.panel_summary(rush_panel(spark, sf_dir).data)


@check(
    "area_summary",
    f"""with {PANEL_SQL} select area_id, cast(sum(demand_count) as bigint) as total_demand,
    max(rush_threshold) as rush_threshold, cast(sum(is_rush_area) as bigint) as rush_hours
    from panel group by area_id order by total_demand desc, area_id limit 3""",
)
def area_summary_check(spark, sf_dir):
    return panels.area_summary(rush_panel(spark, sf_dir).data, 3)


MAP_SQL = """v as (select area_id, {value} as value from panel group by area_id)
    select area_id, value, round(lat, 6) as lat, round(lng, 6) as lng,
    round(5 + 15 * value / case when max(value) over () > 0 then max(value) over () else 1 end, 6) as radius,
    case when value > 0 then 'crimson' else 'blue' end as color,
    round(avg(lat) over (), 6) as map_lat, round(avg(lng) over (), 6) as map_lng
    from v join centroids using (area_id)"""


def _rounded(layer: DataFrame, *columns: str) -> DataFrame:
    return layer.withColumns({column: F.round(column, 6) for column in columns})


@check(
    "area_map_layer",
    f"with {PANEL_SQL}, {MAP_SQL.format(value='cast(sum(demand_count) as double)')}",
)
def area_map_layer_check(spark, sf_dir):
    built = rush_panel(spark, sf_dir)
    layer = panels.area_map_layer(built.data, built.centroids)
    return _rounded(layer, "lat", "lng", "radius", "map_lat", "map_lng")


@check("area_map_layer_mean", f"with {PANEL_SQL}, {MAP_SQL.format(value='avg(demand_count)')}")
def area_map_layer_mean_check(spark, sf_dir):
    built = rush_panel(spark, sf_dir)
    layer = panels.area_map_layer(built.data, built.centroids, "mean_demand")
    return _rounded(layer, "lat", "lng", "radius", "map_lat", "map_lng")


@check(
    "class_weights",
    f"""with {PANEL_SQL}, t as (select count(*) as train_rows,
      count(*) filter (is_rush_area = 1) as rush_rows, count(*) filter (is_rush_area = 0) as other_rows
      from panel where split = 'train')
    select *, case when rush_rows > 0 then train_rows / (2.0e0 * rush_rows) else 1.0e0 end as rush_weight,
      case when other_rows > 0 then train_rows / (2.0e0 * other_rows) else 1.0e0 end as other_weight
    from t""",
)
def class_weights_check(spark, sf_dir):
    return classifier.class_weights(rush_panel(spark, sf_dir).data)


INDEX_SQL = """{name}_at as (select {name}, cast(row_number() over (order by count(*) desc, {name}) - 1
    as double) as i from panel where split = 'train' group by {name})"""


@check(
    "feature_index_onehot",
    f"""with {PANEL_SQL}, {INDEX_SQL.format(name='area_id')}, {INDEX_SQL.format(name='day_of_week')}
    select {time_text('timestamp_hour')} as timestamp_hour, area_id, a.i as area_id_idx,
      w.i as day_of_week_idx, cast(a.i as bigint) as area_id_hot, cast(w.i as bigint) as day_of_week_hot,
      cast(hour_of_day as bigint) as hour_of_day_hot
    from panel join area_id_at a using (area_id) join day_of_week_at w using (day_of_week)""",
)
def feature_index_onehot_check(spark, sf_dir):
    """Category indexes, and where each one-hot vector has its one."""
    data = rush_panel(spark, sf_dir).data
    model = classifier.Pipeline(stages=classifier.category_stages(classifier.LAG_FEATURES)).fit(
        classifier.train_rows(data)
    )
    encoded = model.transform(data)
    hot = {
        f"{name}_hot": F.array_position(vector_to_array(f"{name}_vec"), 1.0) - 1
        for name in ("area_id", "day_of_week", "hour_of_day")
    }
    return encoded.withColumns(hot).select(HOUR, "area_id", "area_id_idx", "day_of_week_idx", *hot)


@check(
    "feature_scale_assemble",
    f"""with {PANEL_SQL}, s as (select {", ".join(
        f"avg({lag}) as {lag}_mean, stddev_samp({lag}) as {lag}_std" for lag in classifier.LAG_COLUMNS)}
      from panel where split = 'train')
    select {time_text('timestamp_hour')} as timestamp_hour, area_id, {", ".join(
        f"round(({lag} - {lag}_mean) / {lag}_std, 6) as {lag}" for lag in classifier.LAG_COLUMNS)}
    from panel, s""",
)
def feature_scale_assemble_check(spark, sf_dir):
    """The lags as they stand at the end of the assembled feature vector."""
    data = rush_panel(spark, sf_dir).data
    model = classifier.feature_pipeline().fit(classifier.train_rows(data))
    features = model.transform(data).withColumn("values", vector_to_array("features"))
    count = len(classifier.LAG_COLUMNS)
    lags = [
        F.round(F.element_at("values", position - count), 6).alias(lag)
        for position, lag in enumerate(classifier.LAG_COLUMNS)
    ]
    return features.select(HOUR, "area_id", *lags)


#: All gradients of a fitted model are below this.
OPTIMAL = 1e-4


def terms_sql(options: PanelOptions, features: classifier.FeatureSet) -> str:
    """The terms of a model, with the train rows and rush rows that have each."""

    def group(name: str) -> str:
        return f"select concat('{name}=', cast({name} as varchar)), count(*), count(*) filter (is_rush_area = 1) from train group by {name}"

    def unknown(name: str) -> str:
        return f"select '{name}=__unknown', 0, 0"

    def codes(name: str) -> str:
        # The codes of a number run from 0 to the largest; those without rows are terms all the same.
        return f"""select concat('{name}=', cast(i as varchar)), count(train.{name}), count(train.{name}) filter (is_rush_area = 1)
          from (select unnest(generate_series(0, (select max({name}) from train))) as i) left join train on train.{name} = i group by i"""

    def number(name: str) -> str:
        return f"select '{name}', count(*), count(*) filter (is_rush_area = 1) from train"

    def plain(name: str) -> str:
        return f"select '{name}', count(*) filter ({name} <> 0), count(*) filter ({name} <> 0 and is_rush_area = 1) from train"

    parts = ["select 'intercept' as term, count(*) as rows, count(*) filter (is_rush_area = 1) as rush_rows from train"]
    parts += [part(name) for name in features.text for part in (group, unknown)]
    parts += map(codes, features.codes)
    parts += [*map(plain, features.plain), *map(number, features.numbers)]
    return f"""with {panel_sql(options)}, train as (select * from panel where split = 'train'),
      terms as ({" union all ".join(parts)}) select *, true as optimal from terms"""


def _certified(model, panel: DataFrame, features: classifier.FeatureSet) -> DataFrame:
    found = classifier.certificate(model, panel, features)
    return found.select("term", "rows", "rush_rows", (F.abs("gradient") < OPTIMAL).alias("optimal"))


@check("rush_fit", terms_sql(TRAIN_TOP, classifier.LAG_FEATURES))
def rush_fit_check(spark, sf_dir):
    """The terms of the fitted model, and that it is the optimum in each: gradients worked out from panel and coefficients."""
    data = rush_panel(spark, sf_dir).data
    return _certified(classifier.fit_rush_model(data), data, classifier.LAG_FEATURES)


@check("rush_fit_calendar", terms_sql(ALL_TOP, classifier.CALENDAR_FEATURES))
def rush_fit_calendar_check(spark, sf_dir):
    """As ``rush_fit`` for the feature set with months, over the whole-period panel."""
    data = rush_panel(spark, sf_dir, ALL_TOP).data
    return _certified(classifier.fit_calendar_model(data), data, classifier.CALENDAR_FEATURES)


def with_plain_score(model, panel: DataFrame) -> DataFrame:
    """The scored panel, with ``plain_prob``: the probability by hand, from the terms' coefficients and the columns of the panel."""
    scored = classifier.score(model, panel)
    terms = {row.term: row.coefficient for row in classifier.certificate(model, panel).collect()}
    lags = classifier.LAG_COLUMNS
    spread = [f(lag).alias(f"{lag}_{f.__name__}") for lag in lags for f in (F.avg, F.stddev_samp)]
    numbers = classifier.train_rows(panel).agg(*spread).first()
    value = F.lit(terms["intercept"]) + F.col("is_weekend") * terms["is_weekend"]
    for name in ("area_id", "day_of_week", "hour_of_day"):
        known = F.create_map(*[F.lit(x) for term, c in terms.items() if term.startswith(f"{name}=") for x in (term, c)])
        value += F.coalesce(F.try_element_at(known, F.concat(F.lit(f"{name}="), F.col(name).cast("string"))), F.lit(0.0))
    for lag in lags:
        value += (F.col(lag) - numbers[f"{lag}_avg"]) / numbers[f"{lag}_stddev_samp"] * terms[lag]
    return scored.withColumn("plain_prob", 1 / (1 + F.exp(-value)))


def _agrees() -> dict:
    return {
        "as_by_hand": F.abs(F.col("y_prob") - F.col("plain_prob")) < 1e-9,
        "decided": (F.col("y_prob") > 0.5).cast("int") == F.col("y_pred"),
    }


@check(
    "rush_score",
    f"""with {PANEL_SQL} select area_id, {time_text('timestamp_hour')} as timestamp_hour, split, is_rush_area,
      true as as_by_hand, true as decided from panel""",
)
def rush_score_check(spark, sf_dir):
    """Every row of the panel, and whether its score is the logistic function of its terms, and its decision that of its score."""
    data = rush_panel(spark, sf_dir).data
    scored = with_plain_score(classifier.fit_rush_model(data), data)
    return scored.withColumns(_agrees()).select("area_id", HOUR, "split", "is_rush_area", "as_by_hand", "decided")


PRF_SQL = """select split,
    count(*) filter (is_rush_area = 1 and y_pred = 1) as tp,
    count(*) filter (is_rush_area = 0 and y_pred = 1) as fp,
    count(*) filter (is_rush_area = 1 and y_pred = 0) as fn,
    count(*) filter (is_rush_area = 0 and y_pred = 0) as tn from scored group by split"""
PRF_COLUMNS = f"""{half_up("coalesce(tp * 1.0e0 / nullif(tp + fp, 0), 0)", 4)} as precision,
    {half_up("coalesce(tp * 1.0e0 / nullif(tp + fn, 0), 0)", 4)} as recall,
    {half_up("coalesce(2.0e0 * tp / nullif(2 * tp + fp + fn, 0), 0)", 4)} as f1"""
AREA_SQL = f"""select split,
    {half_up("sum((tp - pos / 2.0e0) * neg) / max(all_pos * 1.0e0 * all_neg)", 4)} as roc_auc,
    {half_up("sum(pos * 1.0e0 * tp / (tp + fp)) / max(all_pos)", 4)} as pr_auc from ladder group by split"""


@check("eval_prf", f"with {SCORED_SQL}, c as ({PRF_SQL}) select split, {PRF_COLUMNS} from c")
def eval_prf_check(spark, sf_dir):
    return evaluation.precision_recall_f1(scored_panel(spark, sf_dir))


@check("eval_roc_auc", f"with {LADDER_SQL}, a as ({AREA_SQL}) select split, roc_auc from a")
def eval_roc_auc_check(spark, sf_dir):
    return evaluation.roc_auc(ladder(spark, sf_dir))


@check("eval_pr_auc", f"with {LADDER_SQL}, a as ({AREA_SQL}) select split, pr_auc from a")
def eval_pr_auc_check(spark, sf_dir):
    return evaluation.average_precision(ladder(spark, sf_dir))


ROC_SQL = """select split, fp * 1.0e0 / all_neg as fpr, tp * 1.0e0 / all_pos as tpr, score as threshold
    from ladder {where} union all select distinct split, 0.0e0, 0.0e0, null from ladder"""


@check("eval_roc_curve", f"with {LADDER_SQL} {ROC_SQL.format(where='')}")
def eval_roc_curve_check(spark, sf_dir):
    return evaluation.roc_curve(ladder(spark, sf_dir))


@check(
    "eval_roc_curve_corners",
    f"""with {LADDER_SQL} {ROC_SQL.format(where='''where next_pos is null or next_pos <> pos
    or next_neg <> neg or tp + fp = pos + neg''')}""",
)
def eval_roc_curve_corners_check(spark, sf_dir):
    return evaluation.roc_curve(ladder(spark, sf_dir), corners_only=True)


@check(
    "eval_pr_curve",
    f"""with {LADDER_SQL} select split, tp * 1.0e0 / all_pos as recall, tp * 1.0e0 / (tp + fp) as precision,
    score as threshold from ladder union all select distinct split, 0.0e0, 1.0e0, null from ladder""",
)
def eval_pr_curve_check(spark, sf_dir):
    return evaluation.precision_recall_curve(ladder(spark, sf_dir))


@check(
    "eval_confusion",
    f"""with {SCORED_SQL}, c as ({PRF_SQL})
    select split, 0 as actual, 0 as predicted, tn as rows from c union all select split, 0, 1, fp from c
    union all select split, 1, 0, fn from c union all select split, 1, 1, tp from c""",
)
def eval_confusion_check(spark, sf_dir):
    return evaluation.confusion_matrix(scored_panel(spark, sf_dir))


@check(
    "eval_metrics_table",
    f"""with {LADDER_SQL}, c as ({PRF_SQL}), a as ({AREA_SQL})
    select case split when 'train' then 'Train' else 'Test' end as split, {PRF_COLUMNS}, roc_auc, pr_auc
    from c join a using (split)""",
)
def eval_metrics_table_check(spark, sf_dir):
    stage = Stage(spark)
    panel = panels.build_rush_panel(demand_trips(spark, sf_dir), TRAIN_TOP, stage)
    return evaluation.metrics_table(with_rule_score(panel.data), stage)


#: The metrics by other formulas: ROC-AUC from the ranks of the rush rows, average precision from running counts.
PLAIN_METRICS = """
with ranked as (
  select split, is_rush_area as y, y_pred, rank() over (partition by split order by y_prob) as low,
    count(*) over (partition by split, y_prob) as ties,
    count(*) over (partition by split order by y_prob desc) as at_least,
    sum(is_rush_area) over (partition by split order by y_prob desc) as rush_at_least from {scored}
), sums as (
  select split, count(*) as rows, sum(y) as rush_rows, sum(y * y_pred) as tp, sum(y_pred) as predicted,
    sum(case when y = 1 then low + (ties - 1) / 2.0D end) as ranks, sum(y * rush_at_least / at_least) as precisions
  from ranked group by split
)
select initcap(split) as split, rows, rush_rows, round(tp / predicted, 4) as precision, round(tp / rush_rows, 4) as recall,
  round(2 * tp / (predicted + rush_rows), 4) as f1,
  round((ranks - rush_rows * (rush_rows + 1) / 2.0D) / (rush_rows * (rows - rush_rows)), 4) as roc_auc,
  round(precisions / rush_rows, 4) as pr_auc from sums
"""


@check(
    "eval_model_metrics",
    f"""with {PANEL_SQL} select case split when 'train' then 'Train' else 'Test' end as split, count(*) as rows,
      count(*) filter (is_rush_area = 1) as rush_rows, true as agree from panel group by split""",
)
def eval_model_metrics_check(spark, sf_dir):
    """The metrics table of the fitted model, and whether other formulas give the same to three decimals."""
    stage = Stage(spark)
    data = panels.build_rush_panel(demand_trips(spark, sf_dir), TRAIN_TOP, stage).data
    scored = stage.table(classifier.score(classifier.fit_rush_model(data), data), "scored")
    plain = spark.sql(PLAIN_METRICS, scored=scored)
    names = ("precision", "recall", "f1", "roc_auc", "pr_auc")
    same = [F.abs(F.coalesce(F.col(f"p.{name}"), F.lit(0.0)) - F.col(f"m.{name}")) < 1e-3 for name in names]
    table = evaluation.metrics_table(scored, stage).alias("m").join(plain.alias("p"), "split", "right")
    return table.select("split", "p.rows", "p.rush_rows", F.coalesce(reduce(Column.__and__, same), F.lit(False)).alias("agree"))


TEST_HOURS_SQL = "select timestamp_hour as h from panel where split = 'test' group by timestamp_hour"
SNAPSHOT_SQL = f"""th as ({TEST_HOURS_SQL}),
    snap as (select h from (select h, row_number() over (order by h) - 1 as i, count(*) over () as n from th)
      where i = n // 2)"""


@check(
    "snapshot_hour",
    f"""with {PANEL_SQL}, {SNAPSHOT_SQL} select 'middle' as method, {time_text('h')} as snapshot_hour from snap
    union all select 'median', {time_text("make_timestamp(cast(quantile_cont(epoch_us(h), 0.5) as bigint))")}
    from th""",
)
def snapshot_hour_check(spark, sf_dir):
    data = rush_panel(spark, sf_dir).data
    hours = [
        evaluation.snapshot_hour(data, method).withColumn("method", F.lit(method))
        for method in ("middle", "median")
    ]
    return hours[0].unionByName(hours[1])


def scored_with_hour(spark, sf_dir):
    built = rush_panel(spark, sf_dir)
    hour = evaluation.snapshot_hour(built.data).scalar()
    return with_rule_score(built.data), hour, built.centroids


HOUR_SQL = f"""{SCORED_SQL}, {SNAPSHOT_SQL}, at_hour as (
    select * from scored join centroids using (area_id) where timestamp_hour = (select h from snap))"""


@check(
    "top_rush_at_hour",
    f"""with {HOUR_SQL} select area_id, demand_count, rush_threshold, is_rush_area, y_prob, y_pred,
    round(lat, 6) as lat, round(lng, 6) as lng from at_hour order by y_prob desc, area_id limit 3""",
)
def top_rush_at_hour_check(spark, sf_dir):
    return _rounded(evaluation.top_rush_at_hour(*scored_with_hour(spark, sf_dir), top_n=3), "lat", "lng")


@check(
    "rush_map_layer",
    f"""with {HOUR_SQL} select area_id, round(lat, 6) as lat, round(lng, 6) as lng, 10 as radius,
    case when y_prob < 0.2 then 'blue' when y_prob < 0.4 then 'cyan' when y_prob < 0.6 then 'yellow'
      when y_prob < 0.8 then 'orange' else 'red' end as color, demand_count, rush_threshold,
    case when is_rush_area = 1 then '🔴 Cao điểm' else '🟢 Bình thường' end as actual_label,
    case when y_pred = 1 then '🔴 Cao điểm' else '🟢 Bình thường' end as predicted_label,
    {half_up("y_prob", 4)} as probability, round(avg(lat) over (), 6) as map_lat,
    round(avg(lng) over (), 6) as map_lng from at_hour""",
)
def rush_map_layer_check(spark, sf_dir):
    layer = evaluation.rush_map_layer(*scored_with_hour(spark, sf_dir))
    return _rounded(layer, "lat", "lng", "map_lat", "map_lng")


@check(
    "top_rush_model",
    f"""with {HOUR_SQL} select area_id, demand_count, rush_threshold, is_rush_area, round(lat, 6) as lat, round(lng, 6) as lng,
      true as as_by_hand, true as decided from at_hour""",
)
def top_rush_model_check(spark, sf_dir):
    """The areas the fitted model holds most likely in rush at the snapshot hour: all of them, as there are fewer than 15."""
    built = rush_panel(spark, sf_dir)
    scored = with_plain_score(classifier.fit_rush_model(built.data), built.data)
    hour = evaluation.snapshot_hour(built.data).scalar()
    plain = scored.where(F.col(HOUR) == hour).select("area_id", "plain_prob")
    top = evaluation.top_rush_at_hour(scored, hour, built.centroids).join(plain, "area_id", "left").withColumns(_agrees())
    return _rounded(top.drop("y_prob", "y_pred", "plain_prob"), "lat", "lng")
