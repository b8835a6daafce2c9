"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``; every run executes the
whole plan into Spark's ``noop`` sink (nothing is collected to the driver).
One warm-up run, then the median of ``$BENCH_REPEAT`` (default 3) timed
runs per query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from goldleaf.plans.catalog import QUERIES  # noqa: E402
from goldleaf.session import get_session  # noqa: E402

HEADLINE = [
    "silver_dedup_order_items",
    "silver_upsert_orders",
    "gold_fact_orders",
    "gold_dim_customers_scd2",
    "clickstream_window_counts",
    "stream_window_counts",
    "dq_null",
    "dq_range",
    "dq_duplicate",
]


def run_once(spark, name: str, sf_dir: str) -> tuple[float, float]:
    """Seconds to build the plan (with any jobs it runs), and in all."""
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    built = time.perf_counter() - t0
    df.write.format("noop").mode("overwrite").save()
    return built, time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    spark = get_session(f"local[{cpus}]", app="goldleaf-bench",
                        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                        extra=extra)
    per_query, build, failed = {}, {}, {}
    for name in names:
        try:
            run_once(spark, name, sf_dir)  # warm-up: JIT, file listing, codegen cache
            times = [run_once(spark, name, sf_dir) for _ in range(repeat)]
            per_query[name] = round(statistics.median(t for _, t in times), 3)
            build[name] = round(statistics.median(t for t, _ in times), 3)
        except Exception as e:  # report, keep measuring the rest
            per_query[name] = None
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "headline_total_median_sec",
           "value": round(sum(v for v in per_query.values() if v is not None), 3),
           "unit": "sec", "queries": per_query, "build_sec": build, "sf": sf, "cpus": int(cpus), "repeat": repeat}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
