"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local threads (8).
Every query runs once to warm up at the smallest scale, then once, timed, with all of its
result computed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HEADLINE = [
    "decisions",
    "gate_outcomes",
    "decision_trace",
    "rule_evaluations",
    "matched_rule",
    "window_avg",
    "window_last",
    "progress_records",
    "metrics_long",
    "parse_stats",
    "scan_logs",
    "entries_from_text",
    "entries_from_lines",
    "dedup_records",
    "record_order",
    "file_order",
    "cluster_completeness",
    "rule_problems",
    "upsert_decisions",
    "stream_decisions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")

    from checks.queries import QUERIES
    from driverlens.session import build_session

    spark = build_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")

    # The events come as one small file, which would be one scan task: deal them to as many
    # files as there are threads, before anything is timed.
    spread = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for where in (sf_dir, warm_dir):
        if os.path.isdir(where):
            events = spark.read.parquet(f"{where}/events.parquet").repartition(cpus)
            events.write.parquet(f"{spread}/{os.path.basename(where.rstrip('/'))}/events.parquet")

    def run(name: str, where: str) -> float:
        where = f"{spread}/{os.path.basename(where.rstrip('/'))}"
        begin = time.perf_counter()
        QUERIES[name](spark, where).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        if os.path.isdir(warm_dir):
            run(name, warm_dir)
        seconds[name] = round(run(name, sf_dir), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
