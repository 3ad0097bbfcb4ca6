"""Benchmark: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each job is built and fully executed (a ``noop`` write forces every row;
jobs that write and read back include their writes). Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
with the median of $BENCH_RUNS runs per job (after one warm-up pass). The
session cache is cleared before every run, so each run includes its scans.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
SHUFFLE = int(os.environ.get("BENCH_SHUFFLE", str(CPUS * 2)))

HEADLINE = [
    "fact_book", "edition_clean", "work_clean", "author_clean", "dim_work", "dim_subject",
    "work_subject", "work_author", "dim_edition", "dim_time", "dim_author",
    "merge_upsert", "dedup_latest", "salted_agg", "check_keys", "null_profile",
    "stream_dedup", "stream_upsert", "warehouse_load", "warehouse_star", "quality_report",
]


def _session():
    from bookmart.session import get_session
    spark = get_session(f"local[{CPUS}]", "bookmart-bench", shuffle_partitions=SHUFFLE, extra={
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024),
    })
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _run(spark, fn):
    spark.catalog.clearCache()        # every run pays for its own scans
    t0 = time.perf_counter()
    fn().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def star_build(spark):
    """Whole build, cleaned frames checkpointed once, 8 tables written."""
    from bookmart.plans import build, fixtures
    from bookmart.session import scratch_path
    from bookmart.sources import sinks
    star = build.build_star(fixtures.raw_works(spark, SF_DIR), fixtures.raw_editions(spark, SF_DIR),
                            fixtures.raw_authors(spark, SF_DIR))
    root = scratch_path(spark, "bench-star")
    for name, df in star.items():
        sinks.partitioned_write(df, f"{root}/{name}", "2025-01-15")
    return spark.read.parquet(f"{root}/fact_book")


def main():
    from bookmart.plans import jobs
    spark = _session()
    todo = {n: (lambda n=n: jobs.JOBS[n](spark, SF_DIR)) for n in HEADLINE}
    todo["star_build"] = lambda: star_build(spark)
    only = os.environ.get("BENCH_ONLY")
    if only:
        todo = {k: v for k, v in todo.items() if re.fullmatch(only, k)}
    for fn in todo.values():          # warm-up (JIT, file cache)
        _run(spark, fn)
    times = {}
    for name, fn in todo.items():
        times[name] = round(statistics.median(_run(spark, fn) for _ in range(RUNS)), 3)
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else SF_DIR,
                      "cpus": CPUS, "runs": RUNS}))


if __name__ == "__main__":
    main()
