"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the number of local threads.
Every query runs whole into a sink that discards the rows, after one small warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from tallyloom.plans.catalog import REGISTRY

HEADLINES = [
    "panel_daily",
    "quality_profile",
    "rolling_columns",
    "calendar_window_columns",
    "feature_table",
    "split_by_time",
    "store_health",
    "model_comparison",
    "psi_features",
    "drift_action",
    "cusum_per_store",
    "cusum_per_user",
    "forecast_features",
    "forecast_intervals",
    "gbt_forecast",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.time()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.time() - start, 3)

    chosen = sys.argv[1:] or HEADLINES
    run("stores_without_orders")
    times = {}
    for name in chosen:
        times[name] = run(name)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    scale = Path(sf_dir).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
