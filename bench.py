"""Headline queries, forced with a noop write; prints one JSON line.

BENCH_SF_DIR  tables to read, default /root/testdata/sf0.1
BENCH_CPUS    local cores, default 8
BENCH_RUNS    timed runs per query after one warm-up, default 3 (the median counts)
BENCH_QUERIES comma-separated names, or "all"
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quotemill.session import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "listing_rows",
    "build_master",
    "top_equities",
    "report_rows",
    "master_last_wins",
    "carry_down",
    "capital_ranking",
    "row_index",
    "latest_snapshot",
    "stale_sources",
    "missing_units",
    "contains_many",
    "key_lookup",
    "conform_prices",
    "brokerage_prices",
    "archive_rows",
    "export_missing",
    "csv_round_trip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    spark = build_session("quotemill-bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timed.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timed[1:] or timed), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "median seconds over headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
