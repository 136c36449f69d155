"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the local cores. Each query gets one run to warm
up and then the median of ``BENCH_RUNS`` runs; results are fetched in full by a ``noop`` write.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable
from pathlib import Path

from tripmart.checks import QUERIES
from tripmart.checks.adapters import demand_trips, raw_trips, silver_trips
from tripmart.checks.demand import TRAIN_TOP, with_rule_score
from tripmart.checks.storage import land_csv
from tripmart.operators import classifier, evaluation
from tripmart.operators.bronze import ingest_bronze
from tripmart.operators.gold import build_gold, build_gold_tables
from tripmart.operators.panel import build_rush_panel
from tripmart.operators.silver import write_silver
from tripmart.plans import dashboard, serving
from tripmart.session import Stage, build_session
from tripmart.sources.tables import Lakehouse

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
QUERY_NAMES = (
    "silver_transform",
    "quality_summary",
    "gold_daily_rides",
    "gold_station_od_pairs",
    "gold_monthly_summary",
    "q_top_days",
    "q_top_od_pairs",
    "dash_kpis",
    "rush_panel",
    "eval_metrics_table",
)


def fetch(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(run: Callable[[], object]) -> float:
    run()
    times = []
    for _ in range(RUNS):
        begin = time.perf_counter()
        run()
        times.append(time.perf_counter() - begin)
    return round(statistics.median(times), 3)


def main() -> None:
    spark = build_session(
        "tripmart-bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    # The steps on stored tables, as the whole run does them.
    lakehouse = Lakehouse(spark, Stage(spark).root)
    lakehouse.write(raw_trips(spark, SF_DIR), "bronze")
    times["step_silver_write"] = median_seconds(lambda: write_silver(lakehouse))
    silver = lakehouse.read("silver")
    times["step_eight_gold_tables"] = median_seconds(
        lambda: [fetch(table) for table in build_gold_tables(silver).values()]
    )
    times["step_gold_write"] = median_seconds(lambda: build_gold(lakehouse))

    # What a dashboard asks for, from the stored Gold tables.
    days, pairs, months = (
        lakehouse.read(name) for name in ("gold_daily_rides", "gold_station_od_pairs", "gold_monthly_summary")
    )
    times["stored_top_days"] = median_seconds(lambda: fetch(serving.top_days(days)))
    times["stored_top_od_pairs"] = median_seconds(lambda: fetch(serving.top_od_pairs(pairs)))
    times["stored_monthly_chart"] = median_seconds(lambda: fetch(dashboard.chart_monthly_total(months)))

    # Landed CSV files to Bronze.
    landing = land_csv(raw_trips(spark, SF_DIR), Stage(spark).path("landing"))
    landed = Lakehouse(spark, Stage(spark).root)
    times["step_csv_to_bronze"] = median_seconds(lambda: ingest_bronze(landed, landing))

    panel = build_rush_panel(demand_trips(spark, SF_DIR), TRAIN_TOP, Stage(spark)).data
    times["step_model_fit"] = median_seconds(lambda: classifier.fit_rush_model(panel))
    scored = with_rule_score(panel)
    times["step_evaluation"] = median_seconds(
        lambda: fetch(evaluation.metrics_table(scored, Stage(spark)))
    )

    # Queries from the plain tables.
    for name in QUERY_NAMES:
        times[name] = median_seconds(lambda: fetch(QUERIES[name](spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
                "trips": silver_trips(spark, SF_DIR).count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
