"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 BENCH_RUNS=3 python bench.py [name ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans import registry  # noqa: E402
from millrace.session import session  # noqa: E402

HEADLINE = [
    "join_sort_merge", "join_salted", "agg_count_avg_sum", "startree_cube", "topk_groups",
    "dense_row_ids", "window_sliding", "sessionize", "merge_upsert", "wordcount_alnum",
    "metric_histogram_quantile", "lineage_reach", "join_fanout_count", "join_skew_aqe", "latency_percentiles",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(runs + 1):  # the first run warms up
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "median wall time, summed over the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
