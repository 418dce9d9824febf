"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload import queries as q  # noqa: E402
from workload.folders import with_shared_folder  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "motion_features",
    "motion_features_hot",
    "first_n_per_series",
    "window_summary",
    "window_summary_default",
    "window_summary_uneven",
    "window_summary_hot",
    "feature_window_summary",
    "raw_windows",
    "channel_tensor",
    "scan_readings",
    "fuse_sensors",
    "fused_features",
    "overview",
    "describe_axes",
    "correlation_matrix",
    "box_summary",
    "subject_split",
    "split_rows",
    "classification_report",
    "standardized_axes",
    "stacked_predictions",
    "sequence_predictions",
)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    with_shared_folder(spark)
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{SF_DIR}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.monotonic()
        q.ALL[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.monotonic() - start, 3)
    sf = re.search(r"sf([\d.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "headline_queries_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf.group(1)) if sf else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
