"""The whole run: raw files to Bronze, Silver and Gold, and a preview."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tripmart.operators.bronze import ingest_bronze
from tripmart.operators.gold import build_gold
from tripmart.operators.silver import write_silver
from tripmart.plans.serving import preview_gold
from tripmart.session import Stage
from tripmart.sources.tables import Lakehouse


@dataclass(frozen=True)
class RunResult:
    """Rows stored by table, the quality of Silver, and what the Bronze rows were like before cleaning."""

    rows: dict[str, int]
    quality: DataFrame
    found: dict[str, int]
    preview: dict[str, DataFrame]


def run_lakehouse(
    lakehouse: Lakehouse,
    input_path: str,
    zipped: bool = False,
    columns: Sequence[str] | None = None,
    stage: Stage | None = None,
    only_landed_months: bool = False,
) -> RunResult:
    """Build every table below the root from the files at ``input_path``.

    With ``only_landed_months`` the months that landed again are replaced in Silver and the others stay.

    Layers pass data on only through stored tables; each step can be run again by itself.
    """
    if stage is None:
        # Intermediate tables of the run's own are gone when it ends.
        with Stage(lakehouse.spark) as own:
            return run_lakehouse(lakehouse, input_path, zipped, columns, own, only_landed_months)
    bronze_rows = ingest_bronze(lakehouse, input_path, zipped, columns, stage)
    silver = write_silver(lakehouse, only_landed_months=only_landed_months)
    gold_rows = build_gold(lakehouse, stage)
    rows = {"bronze": bronze_rows, "silver": silver.rows, **gold_rows}
    return RunResult(rows, silver.quality, silver.found, preview_gold(lakehouse))
