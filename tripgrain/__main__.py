"""Run the full refresh as a Spark job.

    spark-submit --py-files tripgrain.zip tripgrain/__main__.py --trips DIR [DIR ...] --lookup CSV --out DIR \
        [--start 2026-01-01 --end 2026-02-01 --name January]
"""

from __future__ import annotations

import argparse
from datetime import datetime

from tripgrain.plans.refresh import run_refresh
from tripgrain.session import build_session, drop_copies
from tripgrain.sources import read_lookup, read_trips
from tripgrain.spec import TripSpec


def main() -> None:
    default = TripSpec()
    parser = argparse.ArgumentParser(description="Stage, enrich, report, check and publish one period of trips.")
    parser.add_argument("--trips", nargs="+", required=True, help="Parquet files or folders")
    parser.add_argument("--lookup", required=True, help="CSV of locations")
    parser.add_argument("--out", required=True, help="folder all executors reach")
    parser.add_argument("--start", type=datetime.fromisoformat, default=default.period_start)
    parser.add_argument("--end", type=datetime.fromisoformat, default=default.period_end)
    parser.add_argument("--name", default=default.period_name, help="the period's name in column and check names")
    args = parser.parse_args()

    spec = TripSpec(period_start=args.start, period_end=args.end, period_name=args.name)
    spark = build_session("trip-refresh")
    try:
        result = run_refresh(read_trips(spark, args.trips, spec), read_lookup(spark, args.lookup, spec), spec, args.out)
        print(f"{result.checks.count()} checks passed")
        result.summary.show(truncate=False)
    finally:
        drop_copies(spark)
        spark.stop()


if __name__ == "__main__":
    main()
