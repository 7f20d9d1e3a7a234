"""Batch jobs: refresh the dimensions and load facts from the lake.

    spark-submit --py-files listenlake.zip listenlake/plans/main.py --lake gs://bucket/output \\
        --warehouse gs://bucket/warehouse --first 2024-01-01 --last 2024-01-31

Everything is safe to run again: dimensions keep the keys they gave, and the facts
of the given dates are replaced. Facts that differ from their plays in number or duration
are not committed, and the job fails.
"""

from __future__ import annotations

import argparse
from datetime import date

from listenlake.operators.scratch import clear_scratch
from listenlake.plans.warehouse import Warehouse
from listenlake.session import build_session
from listenlake.streaming.ingest import read_lake

GRAINS = {"day": False, "hour": True}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Refresh dimensions and load facts from the lake")
    parser.add_argument("--lake", required=True, help="folder of the streamed tables")
    parser.add_argument("--warehouse", required=True, help="folder for dimensions and facts")
    parser.add_argument("--first", required=True, type=date.fromisoformat, help="first date to load")
    parser.add_argument("--last", required=True, type=date.fromisoformat, help="last date to load")
    parser.add_argument("--effective", type=date.fromisoformat, help="date of new versions, default --last")
    parser.add_argument("--grain", choices=[*GRAINS, "both"], default="hour")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session("listenlake-batch")
    plays = read_lake(spark, f"{args.lake}/listen_events", "listen_events")

    store = Warehouse(spark, args.warehouse, plays, args.effective or args.last, args.first, args.last)
    try:
        store.refresh_all()
        for grain, by_hour in GRAINS.items():
            if args.grain in (grain, "both"):
                store.load_facts(args.first, args.last, by_hour)
    finally:
        clear_scratch(spark)


if __name__ == "__main__":
    main()
