"""Bike-share trips on Spark: raw files to cleaned trips, aggregate tables, dashboards and a demand
panel with a rush-hour classifier."""

from tripmart.functions.geo import haversine_km
from tripmart.functions.naming import canonical_name, normalize_columns
from tripmart.operators.bronze import ingest_bronze
from tripmart.operators.classifier import certificate, fit_calendar_model, fit_rush_model, score
from tripmart.operators.evaluation import (
    confusion_matrix,
    metrics_table,
    precision_recall_curve,
    roc_curve,
    rush_map_layer,
    score_ladder,
    snapshot_hour,
    top_rush_at_hour,
)
from tripmart.operators.gold import build_gold, build_gold_tables
from tripmart.operators.panel import (
    WHOLE_PERIOD,
    PanelOptions,
    RushPanel,
    area_map_layer,
    area_summary,
    build_rush_panel,
    panel_summary,
    split_summary,
)
from tripmart.operators.quality import quality_summary, require_non_empty, validate_lakehouse
from tripmart.operators.silver import transform_to_silver, write_silver
from tripmart.plans.medallion import run_lakehouse
from tripmart.plans.serving import preview_gold
from tripmart.session import Stage, build_session, cluster_settings, shuffle_partitions
from tripmart.sources.raw_csv import read_raw_csv
from tripmart.sources.tables import Lakehouse, export_parquet, read_trip_starts
from tripmart.sources.zip_csv import read_zip_csv

__all__ = [
    "certificate",
    "WHOLE_PERIOD",
    "Lakehouse",
    "PanelOptions",
    "RushPanel",
    "Stage",
    "area_map_layer",
    "area_summary",
    "build_gold",
    "build_gold_tables",
    "build_rush_panel",
    "build_session",
    "canonical_name",
    "cluster_settings",
    "confusion_matrix",
    "export_parquet",
    "fit_calendar_model",
    "fit_rush_model",
    "haversine_km",
    "ingest_bronze",
    "metrics_table",
    "normalize_columns",
    "panel_summary",
    "precision_recall_curve",
    "preview_gold",
    "quality_summary",
    "read_raw_csv",
    "read_trip_starts",
    "read_zip_csv",
    "require_non_empty",
    "roc_curve",
    "run_lakehouse",
    "rush_map_layer",
    "score",
    "score_ladder",
    "shuffle_partitions",
    "snapshot_hour",
    "split_summary",
    "top_rush_at_hour",
    "transform_to_silver",
    "validate_lakehouse",
    "write_silver",
]
