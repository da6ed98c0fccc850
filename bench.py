"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built from the raw tables and run to completion with the
``noop`` sink (full execution, no collect).  One warm-up run, then the
median of ``BENCH_REPEATS`` runs.  ``full_refresh`` writes every table of
the pipeline once to a scratch folder (fact written once, five marts read
from it), the way a production run would.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordersmith.plans import pipeline  # noqa: E402
from ordersmith.plans.registry import QUERIES  # noqa: E402
from ordersmith.session import local_session, scratch_path  # noqa: E402
from ordersmith.sources.feeds import AS_OF, feeds_from_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = ("canonical_orders", "fact_orders", "kpi_daily_currency", "kpi_country_daily", "kpi_status_daily",
            "dim_customers", "kpi_freshness_lag")


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    fn()  # warm-up
    times = []
    for _ in range(REPEATS):
        t = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t)
    return round(statistics.median(times), 3)


def build_time(name: str) -> float:
    """Seconds to build the query's plan in Python (fixed, data-independent)."""
    times = []
    for _ in range(REPEATS):
        t = time.perf_counter()
        QUERIES[name](spark_session(), SF_DIR)
        times.append(time.perf_counter() - t)
    return round(statistics.median(times), 3)


_SPARK = None


def spark_session():
    return _SPARK


def main() -> None:
    global _SPARK
    spark = _SPARK = local_session(cores=CPUS, shuffle_partitions=max(8, 2 * CPUS), app="ordersmith-bench")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ordersmith-bench-"))
    results = {}
    for name in HEADLINE:
        results[name] = timed(lambda n=name: run_noop(QUERIES[n](spark, SF_DIR)))

    def full():
        m, s = feeds_from_dir(spark, SF_DIR)
        # the fact and the five marts, as in earlier rounds (all ten tables: see README)
        pipeline.full_refresh(spark, m, s, scratch_path(spark, "bench-refresh"), AS_OF, write_staging=False, write_canonical=False)

    results["full_refresh"] = timed(full)
    build = {name: build_time(name) for name in HEADLINE}
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "plan_build_sec": build,
        "sf": float(m.group(1)) if m else SF_DIR,
        "cores": CPUS,
        "repeats": REPEATS,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
