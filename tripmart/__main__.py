"""``python -m tripmart run LANDING ROOT [--zipped]``, ``validate ROOT`` or ``preview ROOT``: jobs to submit."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from tripmart.operators.quality import validate_lakehouse
from tripmart.plans.medallion import run_lakehouse
from tripmart.plans.serving import preview_gold
from tripmart.session import build_session
from tripmart.sources.tables import Lakehouse


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tripmart", description=__doc__)
    parser.add_argument("--format", default="parquet", help="table format, such as delta where it is installed")
    jobs = parser.add_subparsers(dest="job", required=True)
    run = jobs.add_parser("run", help="landed files to Bronze, Silver and Gold")
    run.add_argument("landing")
    run.add_argument("root")
    run.add_argument("--zipped", action="store_true", help="the landed files are ZIP archives")
    jobs.add_parser("validate", help="check all ten tables").add_argument("root")
    jobs.add_parser("preview", help="show the first rows of the Gold tables").add_argument("root")
    chosen = parser.parse_args(arguments)

    lakehouse = Lakehouse(build_session(), chosen.root, chosen.format)
    if chosen.job == "run":
        result = run_lakehouse(lakehouse, chosen.landing, chosen.zipped)
        for table, rows in result.rows.items():
            print(f"{table}: {rows} rows")
        result.quality.show()
    elif chosen.job == "validate":
        validate_lakehouse(lakehouse).show(truncate=False)
    else:
        for name, table in preview_gold(lakehouse).items():
            print(name)
            table.show()


if __name__ == "__main__":
    main()
