"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from seismic_lake.session import local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "typed_clean",
    "latest_revision",
    "clean_rows",
    "clean_per_year",
    "reject_reasons",
    "catalog_parse",
    "daily_line_parse",
    "html_to_lines",
    "feed_latest",
    "neighbour_name",
    "tier_stitch",
    "interval_join",
    "haversine_pairs",
    "mutual_best_links",
    "coverage_by_band",
    "dq_metrics",
    "dq_results",
    "dq_runs_wide",
    "run_history",
    "daily_counts",
    "strongest_shaking",
    "per_year",
    "per_year_ratio",
    "line_points",
    "capped_windows",
    "incremental_rows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # One small query first, so the first figure is not the JVM warming up.
    QUERIES["per_year"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
