"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default 8). Every query is run to
its last row into a sink that discards them. Times include planning and everything a query stores on its
way. Each query runs BENCH_RUNS times (default 2) and its fastest run counts, since the first one mostly
measures how the JVM compiles the generated code; `first_run_total` gives the first runs' sum as well.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gate.queries import QUERIES  # noqa: E402
from tripgrain.session import build_session  # noqa: E402

HEADLINE = (
    "profile_raw profile_quality staged_trips enriched_trips daily_demand zone_performance hourly_demand "
    "zone_hour_detail zone_hour_performance route_totals route_averages priority_windows segment_comparison "
    "checks_staging checks_enriched checks_daily checks_zones checks_hourly checks_zone_hourly checks_routes "
    "checks_presentation check_gate summary zone_hour_heatmap top_zones week_over_week hour_leaders "
    "duration_seconds duration_text export_csv verified_extract"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    timed = {name: [run(name) for _ in range(runs)] for name in names}
    seconds = {name: min(times) for name, times in timed.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run_total": round(sum(times[0] for times in timed.values()), 3),
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
