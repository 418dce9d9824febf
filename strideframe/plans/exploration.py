"""The exploratory tables of one device, each a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strideframe import operators as ops
from strideframe.schemas import axes


def explore_device(features: DataFrame, accel: str, gyro: str) -> dict[str, DataFrame]:
    """Summaries of a written feature table, over all its rows."""
    raw = [*axes(accel), *axes(gyro)]
    magnitude, jerk = (
        [f"{p}_x_{name}" for p in (accel, gyro)] for name in ("magnitude", "jerk")
    )
    return {
        "overview": ops.overview(features),
        "activity_counts": ops.activity_counts(features),
        "subject_counts": ops.subject_counts(features),
        "describe": ops.describe_long(features, raw),
        "boxes": ops.with_activity_name(ops.box_summary(features, [*raw, magnitude[0]], written=True)),
        "correlation": ops.corr_matrix(features, [*raw, *magnitude, *jerk]),
        "activity_names": ops.category_names(features),
    }


def explore_fused(fused: DataFrame) -> dict[str, DataFrame]:
    """Summaries of fused sensors without features: counts, statistics, correlation
    of every measured column, boxes by activity code."""
    values = [c for c in fused.columns if c not in ("subject_id", "activity_label", "timestamp")]
    return {
        "activity_counts": ops.counts_by(fused, "activity_label"),
        "describe": ops.describe_long(fused, values),
        "correlation": ops.corr_matrix(fused, values),
        "boxes": ops.box_summary(fused, values),
    }
