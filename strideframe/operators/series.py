"""Ordered series: positions, previous values and running totals.

A series is every row that shares the key columns, in the order of the order
columns. Ordinary series are numbered with a plain window. A series with more
than ``MAX_SERIES_ROWS`` rows would put all of them into one task, so such hot
series take another way to the same result:

1. their rows are range-partitioned by (series, order), which cuts one series
   into many ordered parts;
2. each part is numbered on its own and written once;
3. one small row per part (its total and its last values) is carried over to the
   next part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strideframe.sources.storage import materialize

MAX_SERIES_ROWS = 5_000_000
PART_ROWS = 1_000_000
MAX_PARTS = 8_192
#: Rows that one task numbers, as far as whole series allow; more rows take more tasks.
TASK_ROWS = 200_000
#: Rows of a hot series that one task sorts to find the first few.
SHARE_ROWS = 1_000_000


@dataclass(frozen=True)
class HotGroups:
    """Keys of the groups that are too large for one task, with a number each."""

    keys: tuple[str, ...]
    table: DataFrame
    groups: int
    rows: int
    part_rows: int = PART_ROWS

    def side(self) -> DataFrame:
        """The table as a join side; it is written, so that Spark knows its size."""
        return self.table.select(*[F.col(k).alias(f"_hot_{k}") for k in self.keys], "_series")

    def condition(self) -> Column:
        same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in self.keys]
        return reduce(lambda a, b: a & b, same)

    def rest(self, df: DataFrame) -> DataFrame | None:
        """Rows of all other groups; None when the hot group is the whole table."""
        if not self.keys:
            return None
        return df.join(self.side(), self.condition(), "left_anti")

    def members(self, df: DataFrame) -> DataFrame:
        """Rows of the hot groups, with ``_series``."""
        if not self.keys:
            return df.withColumn("_series", F.lit(0).cast("long"))
        return df.join(self.side(), self.condition(), "inner").drop(*[f"_hot_{k}" for k in self.keys])


def hot_groups(
    df: DataFrame,
    keys: Sequence[str],
    max_rows: int = MAX_SERIES_ROWS,
    part_rows: int = PART_ROWS,
) -> HotGroups | None:
    """Count rows per group and keep the groups above ``max_rows``, if there are any.

    The count is one job over the key columns, combined before it shuffles, and it is always
    taken; only where a group is hot is it taken again, to be written. Give it a scan or a
    written table, and give its result to all operators over the same keys. There are at
    most rows / max_rows hot groups.
    """
    return _counted(df, keys, max_rows, part_rows)[0]


def _counted(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_SERIES_ROWS, part_rows: int = PART_ROWS) -> tuple[HotGroups | None, int]:
    """The hot groups, if there are any, and the rows of the whole table, by one count."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    most, rows = counts.agg(F.max("_rows"), F.sum("_rows")).first()
    if most is None or most <= max_rows:
        return None, rows or 0
    hot = counts.where(F.col("_rows") > max_rows)
    table = materialize(hot.withColumn("_series", F.monotonically_increasing_id()), "hot-groups")
    total = table.agg(F.count(F.lit(1)).alias("groups"), F.sum("_rows").alias("rows")).first()
    return HotGroups(tuple(keys), table, total["groups"], total["rows"], part_rows), rows


def resolve_hot(df: DataFrame, keys: Sequence[str], hot: HotGroups | None | str) -> HotGroups | None:
    return hot_groups(df, keys) if isinstance(hot, str) and hot == "auto" else hot


def _spread(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Whole series in partitions of about ``TASK_ROWS`` rows, so that no task's sorts and windows
    grow with the table; as Spark deals them where that is no more than its cores."""
    parts = min(math.ceil(rows / TASK_ROWS), MAX_PARTS)
    if not keys or parts <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(parts, *keys)


def ordering(order_by: Sequence[str], nulls_last: bool = False) -> list[Column]:
    return [F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc_nulls_first() for c in order_by]


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    position: str = "pos",
    lags: Sequence[str] = (),
    weight: str | None = None,
    length: str | None = None,
    nulls_last: bool = False,
    hot: HotGroups | None | str = "auto",
) -> DataFrame:
    """Add each row's place in its series.

    ``position`` counts from 0; with ``weight`` it is the total weight of the
    rows before. ``prev_<c>`` holds the previous row's value of every column in
    ``lags``. ``length`` names a column for the size of the series. ``order_by``
    should include tie-breakers, or tied rows come in any order.
    """
    # the count that finds hot series also tells how many tasks the others need
    hot, n_rows = _counted(df, keys) if isinstance(hot, str) and hot == "auto" else (hot, 0)
    columns = df.columns
    order = ordering(order_by, nulls_last)
    amount = F.col(weight).cast("long") if weight else F.lit(1).cast("long")

    def place(w) -> Column:
        if weight is None:
            return F.row_number().over(w).cast("long") - 1
        before = F.sum(amount).over(w.rowsBetween(W.unboundedPreceding, -1))
        return F.coalesce(before, F.lit(0).cast("long"))

    def previous(w) -> list[Column]:
        return [F.lag(c).over(w).alias(f"prev_{c}") for c in lags]

    def whole_windows(rows: DataFrame) -> DataFrame:
        group = W.partitionBy(*keys)
        size = [F.sum(amount).over(group).alias(length)] if length else []
        w = group.orderBy(*order)
        return _spread(rows, keys, n_rows).select("*", place(w).alias(position), *previous(w), *size)

    if hot is None:
        return whole_windows(df)
    rest = hot.rest(df)
    pieces = _number_parts(hot.members(df), hot, columns, order, amount, place, previous, position, lags, length)
    return pieces if rest is None else whole_windows(rest).unionByName(pieces)


def _number_parts(members, hot, columns, order, amount, place, previous, position, lags, length) -> DataFrame:
    # Tied rows may lie on either side of a cut; the input partition they came
    # from is the last sort key, so that even a mass of equal rows is spread.
    # The number of parts is bounded, as the driver keeps a status for each; beyond it
    # parts grow, and their sorts spill.
    parts = min(max(2, math.ceil(hot.rows / hot.part_rows)), MAX_PARTS)
    ranged = (
        members.withColumn("_origin", F.spark_partition_id())
        .repartitionByRange(parts, F.col("_series"), *order, F.col("_origin"))
        .drop("_origin")
        .withColumn("_part", F.spark_partition_id())
    )
    w = W.partitionBy("_series", "_part").orderBy(*order)
    local = ranged.select(
        "*",
        (F.row_number().over(w) == 1).alias("_first"),
        F.lead(F.lit(1)).over(w).isNull().alias("_last"),
        place(w).alias("_place"),
        *previous(w),
    )
    # Where a part ends is settled once it is written; from here on every reader
    # sees the same parts.
    cut = materialize(local, "series-parts")

    # One row per part: its last one. Small, and written so that its size is known.
    by_part = W.partitionBy("_series").orderBy("_part")
    ends = cut.where("_last").withColumn("_amount", F.col("_place") + amount)
    before = F.sum("_amount").over(by_part.rowsBetween(W.unboundedPreceding, -1))
    edges = materialize(
        ends.select(
            F.col("_series").alias("_edge_series"),
            F.col("_part").alias("_edge_part"),
            F.coalesce(before, F.lit(0).cast("long")).alias("_offset"),
            *[F.lag(c).over(by_part).alias(f"_before_{c}") for c in lags],
            *([F.sum("_amount").over(W.partitionBy("_series")).alias(length)] if length else []),
        ),
        "series-edges",
    )
    joined = cut.join(
        edges, (F.col("_series") == F.col("_edge_series")) & (F.col("_part") == F.col("_edge_part"))
    )
    carried = [
        F.when(F.col("_first"), F.col(f"_before_{c}")).otherwise(F.col(f"prev_{c}")).alias(f"prev_{c}")
        for c in lags
    ]
    return joined.select(
        *columns,
        (F.col("_place") + F.col("_offset")).alias(position),
        *carried,
        *([length] if length else []),
    )


def first_n(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    n: int,
    position: str | None = None,
    nulls_last: bool = True,
    hot: HotGroups | None | str = "auto",
    share_rows: int = SHARE_ROWS,
) -> DataFrame:
    """The first ``n`` rows of every series; ``position`` names a 0-based row number to keep.

    Hot series are cut down first within shares of about ``share_rows`` rows: a row
    among the first ``n`` of its series is also among the first ``n`` of its share.
    Where the shares' survivors are still many, they are shared out again.
    """
    hot = resolve_hot(df, keys, hot)
    order = ordering(order_by, nulls_last)
    row = F.row_number()
    if hot is not None:
        candidates, shares = hot.members(df), math.ceil(hot.rows / share_rows)
        w = W.partitionBy("_series", "_share").orderBy(*order)
        while shares > 1:
            scattered = candidates.withColumn("_share", F.pmod(F.xxhash64(*df.columns), F.lit(shares)))
            candidates = scattered.withColumn("_row", row.over(w)).where(F.col("_row") <= n).drop("_row", "_share")
            left = math.ceil(shares * n / share_rows)
            shares = left if left < shares else 1
        candidates = candidates.select(*df.columns)
        rest = hot.rest(df)
        df = candidates if rest is None else rest.unionByName(candidates)
    w = W.partitionBy(*keys).orderBy(*order)
    numbered = df.withColumn("_row", row.over(w)).where(F.col("_row") <= n)
    if position:
        numbered = numbered.withColumn(position, F.col("_row").cast("long") - 1)
    return numbered.drop("_row")
