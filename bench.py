"""Time the headline queries on one machine and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES
(comma-separated names, default the headline list). Each query is built and run twice; the second
time is reported, plan building included. Results go to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import time

from caudal.queries.catalog import QUERIES
from caudal.session import local_session

HEADLINE = (
    "daily_kpis",
    "fact_portfolio",
    "silver_movements",
    "fact_transactions",
    "client_value",
    "monthly_income",
    "rolling_30d",
    "suspicious_flag",
    "dedup_by_key",
    "upsert_orders",
    "silver_fees",
    "masked_customers",
    "quality_suite",
    "run_summary",
)


def timed(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else list(HEADLINE)
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, memory="12g", app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(timed(spark, name, sf_dir), 3)
    print(json.dumps({
        "metric": "headline queries, warm, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
