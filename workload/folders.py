"""The folder for intermediate tables, for sessions that name none."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Where a local session without a checkpoint folder keeps its intermediate tables.
SETTING = "STRIDEFRAME_SHARED_DIR"
DEFAULT = "/tmp/checkpoints/strideframe"


def with_shared_folder(spark: SparkSession) -> None:
    """Set a checkpoint folder if the session has none.

    The setting names it; only a session that runs on one machine may do without.
    """
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir():
        return
    folder = os.environ.get(SETTING) or (DEFAULT if context.master.startswith("local[") or context.master == "local" else None)
    if folder is None:
        raise RuntimeError(f"set spark.checkpoint.dir or {SETTING} to a folder that all executors share")
    context.setCheckpointDir(folder)
