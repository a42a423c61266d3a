"""Time the composite jobs: prints one JSON line with seconds per query.

Every query is run to the end into Spark's ``noop`` sink. All run once to warm
up, then each three times, of which the median counts.
"""

import json
import os
import statistics
import sys
import time

from shelfmark.session import build_session
from shelfmark.workload.queries import QUERIES

HEADLINE = (
    "stage_customers", "stage_orders", "stage_order_items", "stage_products", "dim_products",
    "fact_sales", "dq_report", "upsert_snapshot", "sink_partitioned_roundtrip", "full_refresh",
)
RUNS = 3


def run(spark, name, sf_dir):
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names):
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            # Small inputs on one machine: all cores rather than full partitions.
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        run(spark, name, sf_dir)
    seconds = {
        name: round(statistics.median(run(spark, name, sf_dir) for _ in range(RUNS)), 3)
        for name in names
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "median seconds per query, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
