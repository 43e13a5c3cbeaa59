"""Headline timings: prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8)
choose data and cores.  Every query runs twice, written to Spark's ``noop``
sink, so all rows and columns are computed and nothing passes through the
driver.  The second run is reported: at this size the first one mostly times
code generation and the JIT.  Its total is printed too, as ``cold_seconds``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tripstrata.plans.registry import QUERIES
from tripstrata.session import build_session

HEADLINE = (
    "gold_daily_summary gold_daily_summary_lineitem gold_location_performance "
    "gold_location_performance_lineitem gold_hour_zone gold_hour_demo gold_spark gold_sim "
    "silver_dbt silver_strict reject_summary dq_report_strict dedupe_latest merge_upsert "
    "incremental_run as_of_version rollback_to_version expire_versions top_pickup_zones "
    "partition_manifest"
).split()


def timed(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "tripstrata-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, seconds = 0.0, {}
    for name in names:
        first, second = (timed(spark, sf_dir, name) for _ in range(2))
        cold += first
        seconds[name] = round(second, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold_seconds": round(cold, 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
