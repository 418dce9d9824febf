"""``python -m strideframe --raw <folder> --work <folder> [--skip-features] [--eda] [--sequence]``"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from strideframe.plans import PipelineConfig, run_pipeline, run_sequence


def main() -> None:
    parser = argparse.ArgumentParser(prog="strideframe")
    parser.add_argument("--raw", required=True, help="folder with <device>/<sensor>/*.txt")
    parser.add_argument("--work", required=True, help="folder for feature, window and model tables")
    parser.add_argument("--skip-features", action="store_true", help="keep feature tables that are there")
    parser.add_argument("--eda", action="store_true", help="also show the exploratory tables")
    parser.add_argument("--sequence", action="store_true", help="run the raw-window pipeline instead")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(message)s")

    spark = SparkSession.builder.appName("strideframe").getOrCreate()
    cfg = PipelineConfig(raw=args.raw, work=args.work)
    tables = run_sequence(spark, cfg, args.eda) if args.sequence else run_pipeline(spark, cfg, args.skip_features, args.eda)
    stored = ("_features", "_windows", "channels", "predictions", "rejects")
    for name, table in tables.items():
        if not name.endswith(stored):
            print(name)
            # small tables, shown whole; they are stored below the work folder too
            print(table.toPandas().to_string(index=False))


if __name__ == "__main__":
    main()
