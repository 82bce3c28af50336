"""Headline queries at one scale; prints one JSON line.

Every query is timed as a full write to the noop sink, by default once warm (``BENCH_WARM=0``
leaves the warm-up out) and then ``BENCH_RUNS`` times, of which the median counts. The position
lines, which stand for the input files, are written first and reported as
``lines_written``. ``BENCH_QUERIES`` names other queries, or ``all``. A budget of
``BENCH_SECONDS`` ends the warm-ups, not the queries, so that every query is measured.
Times go to stderr as they come.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contractloom.workloads.fixture import position_lines  # noqa: E402
from contractloom.workloads.queries import QUERIES  # noqa: E402

HEADLINE = (
    "record_type_counts", "occurrence_number", "flatten_contracts", "qualifier_amount",
    "party_by_role", "dedup_contracts", "classify_withdrawal", "request_rows",
    "enrich_failures", "failure_breakdown", "document_tags", "error_code_summary",
    "crossref_responses", "entry", "validate_documents", "reconcile_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    budget = float(os.environ.get("BENCH_SECONDS", "240"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    names = list(QUERIES) if list(names) == ["all"] else names
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("contractloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED", "/tmp/contractloom-bench"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    start = begun = time.perf_counter()
    position_lines(spark, sf_dir).schema
    lines = round(time.perf_counter() - start, 3)
    print(f"lines written {lines}", file=sys.stderr, flush=True)
    warmed = []
    for name in names:
        if os.environ.get("BENCH_WARM", "1") == "1" and time.perf_counter() - begun < budget:
            once(name)
            warmed.append(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "lines_written": lines,
        "cold": [n for n in names if n not in warmed],
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cores": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
