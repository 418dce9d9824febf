"""Joining the sensors of one device."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strideframe.schemas import axes


def rename_axes(
    df: DataFrame, prefix: str, keep: Sequence[str] = ("subject_id", "activity_label", "timestamp")
) -> DataFrame:
    """Only the key columns and the axes, the axes under ``prefix``."""
    return df.select(*keep, *[F.col(a).alias(p) for a, p in zip("xyz", axes(prefix))])


def first_per_key(df: DataFrame, on: Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``tie_break``, then by the other columns.

    A window whose rank is cut at 1: Spark drops later rows before the shuffle too.
    """
    rest = [c for c in df.columns if c not in on and c not in tie_break]
    order = W.partitionBy(*on).orderBy(*tie_break, *rest)
    first = df.withColumn("_row", F.row_number().over(order)).where(F.col("_row") == 1)
    return first.drop("_row")


def fuse_sensors(
    accel: DataFrame,
    gyro: DataFrame,
    prefixes: tuple[str, str],
    on: Sequence[str] = ("subject_id", "timestamp"),
    label: str = "activity_label",
    dedupe: str = "none",
    tie_break: Sequence[str] = ("x", "y", "z"),
    strategy: str | None = None,
) -> DataFrame:
    """Inner join of two sensors on subject and aligned time; the label is the first one's.

    Keys that occur more than once multiply; ``dedupe="first"`` keeps one reading
    per key and sensor instead. ``strategy`` is a join hint such as ``"merge"``;
    without one Spark chooses, and splits skewed partitions at run time.
    """
    if dedupe not in ("none", "first"):
        raise ValueError(f"dedupe must be 'none' or 'first', not {dedupe!r}")
    left = rename_axes(accel, prefixes[0], (on[0], label, *on[1:]))
    right = rename_axes(gyro, prefixes[1], on)
    if dedupe == "first":
        named = [[dict(zip("xyz", axes(p))).get(c, c) for c in tie_break] for p in prefixes]
        left = first_per_key(left, on, (label, *named[0]))
        right = first_per_key(right, on, named[1])
    if strategy:
        right = right.hint(strategy)
    return left.join(right, list(on), "inner")
