"""Times the headline queries and prints one JSON line.

Reads the tables in $BENCH_SF_DIR on local[$BENCH_CPUS]. Every query runs once to warm up and is then timed;
its result is computed in full and thrown away.
"""

import json
import os
import re
import time

from spindlewatch.plans.queries import QUERIES
from spindlewatch.session import build_session

HEADLINE = [
    "decode_messages",
    "tumbling_avg",
    "latest_status_rows",
    "label_changes",
    "control_messages",
    "control_routing",
    "missing_profiles",
    "monitor_status",
    "round_robin_templates",
    "refdata_topup",
    "stream_tumbling_avg",
    "stream_latest_status",
    "stream_label_changes",
    "stream_control_messages",
]


def run(spark, name, sf_dir):
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__log__level="ERROR",
    )
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
                "events": events,
                "events_per_sec": {n: round(events / s) for n, s in seconds.items()},
            }
        )
    )


if __name__ == "__main__":
    main()
