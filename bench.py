"""Times the headline queries and prints one JSON line.

The session first runs a few unlisted queries, so that no listed one pays for its start. Each query then runs once
unmeasured (class loading, code generation) and three times measured; the median counts.
Results go to Spark's no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driver_queries.catalog import QUERIES  # noqa: E402
from windgrid import build_session  # noqa: E402

HEADLINE = [
    "clean_spe",
    "clean_wind",
    "quality_report_long",
    "asset_code_join",
    "asset_semi",
    "level_join",
    "level_join_dedupe",
    "business_rules",
    "continuity",
    "completeness",
    "validation_report",
    "projects",
    "generation_daily",
    "restrictions_by_reason",
    "restrictions_summary",
    "dim_tempo",
    "fact_generation",
    "partitioned_roundtrip",
    "full_run",
    "full_run_without_report",
]
WARM_UP = ["null_pct", "join_metrics", "dim_conjunto", "month_coverage"]
RUNS = 3


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "windgrid-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in WARM_UP * 3:
        seconds(QUERIES[name], spark, sf_dir)
    timings = {}
    for name in HEADLINE:
        seconds(QUERIES[name], spark, sf_dir)
        timings[name] = round(statistics.median(seconds(QUERIES[name], spark, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    result = {
        "metric": "headline queries, sum of median seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
