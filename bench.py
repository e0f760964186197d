"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripstar.plans.catalog import all_queries  # noqa: E402
from tripstar.session import local_session  # noqa: E402

HEADLINE = [
    "coerce_types",
    "error_reason",
    "route_counts",
    "clean_rows",
    "quarantine_rows",
    "file_metrics",
    "quality_alert",
    "quality_report",
    "new_files_anti",
    "dim_date",
    "dim_date_events",
    "fact_keys",
    "fact_measures",
    "fact_duration",
    "fact_trips",
    "fact_dense_id",
    "star_lookup_generic",
    "gold_row_counts",
    "check_overview",
    "check_nulls",
    "check_fk_orphans",
    "check_measures",
    "check_years",
    "check_bad_year_sample",
    "check_summary",
    "top_dates",
    "trips_by_vendor",
    "trips_by_payment",
    "csv_ingest_metrics",
    "csv_gold_fact",
]
REPEATS = 2
END_TO_END = "csv_"  # these write and read files: one timed run


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(
        os.environ.get("BENCH_CPUS", "8"),
        **{"spark.python.sql.dataFrameDebugging.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    times = {}
    for name in HEADLINE:
        repeats = 1 if name.startswith(END_TO_END) else REPEATS
        runs = sorted(seconds(lambda: queries[name](spark, sf_dir)) for _ in range(repeats))
        times[name] = round(runs[0], 3)
        print(name, times[name], file=sys.stderr)
    spark.stop()
    result = {
        "metric": "sum of best query seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
