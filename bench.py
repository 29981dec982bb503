"""Seconds per feature family, data set, label and vote query. Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = [
    "label_train_set", "label_all_windows", "agg_windowed_counts",
    "family_u", "family_ucs", "family_c", "family_s", "family_uc", "family_us", "family_cs",
    "order_log_labels", "order_log_family_uc",
    "ds_assemble", "vote_majority", "eval_threshold_sweep",
]


def main() -> None:
    from cartwise.session import build_session
    from checks.spark_queries import registry

    spark = build_session("bench", f"local[{CPUS}]", {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()
    # One small query first, so that no headline pays for starting the JVM.
    queries["label_test_set"](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in HEADLINES:
        began = time.perf_counter()
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)$", SF_DIR.rstrip("/"))
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
