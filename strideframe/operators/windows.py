"""Sliding windows by row count over each series.

Window ``i`` of a series covers its rows ``i*step .. i*step+size-1``; only full
windows exist. Statistics are put together from panes of gcd(size, step) rows, each with
its mean and squared deviations. Panes lie in blocks as long as a window. Running moments
from a block's first pane on, and from its last pane back, are kept for every pane; a
window is what is left of the block it begins in and the beginning of the next one, two
moments to merge. So no row or pane is copied, whatever size and step are.
A window never has more than ``size`` rows, so no group is hot after numbering.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.functions import decode, nan_to_null
from strideframe.operators.series import HotGroups, first_n, number_rows
from strideframe.schemas import CLASS_INDEX, SERIES_KEYS, WINDOW_KEYS

WINDOW_SIZE = 200
WINDOW_STEP = 100


def _check(size: int, step: int) -> None:
    if size < 1 or step < 1:
        raise ValueError("window size and step must be positive")


def _explode_windows(size: int, step: int, position: str = "pos"):
    """Indices of all windows, full or not, that hold the row at ``position``."""
    pos = F.col(position)
    lowest = F.greatest(F.lit(0).cast("long"), F.expr(f"({position} - {size - step}) div {step}"))
    # below zero ``div`` rounds towards zero, which the floor at 0 makes harmless
    highest = F.expr(f"{position} div {step}")
    inside = pos - highest * step < size
    return F.explode(F.when(inside, F.sequence(lowest, highest)))


def _explode_panes(panes_per_window: int):
    pane = F.col("_pane")
    return F.explode(F.sequence(F.greatest(F.lit(0).cast("long"), pane - (panes_per_window - 1)), pane))


def assign_windows(
    df: DataFrame,
    keys: Sequence[str] = SERIES_KEYS,
    order_by: Sequence[str] = ("timestamp",),
    size: int = WINDOW_SIZE,
    step: int = WINDOW_STEP,
    hot: HotGroups | None | str = "auto",
) -> DataFrame:
    """One row per reading and full window: adds ``window_index`` and ``pos``, the
    0-based place of the reading in its series."""
    _check(size, step)
    numbered = number_rows(df, keys, order_by, length="_length", nulls_last=True, hot=hot)
    full = F.col("window_index") * step + size <= F.col("_length")
    return (
        numbered.withColumn("window_index", _explode_windows(size, step))
        .where(full)
        .withColumn("window_index", F.col("window_index").cast("int"))
        .drop("_length")
    )


def summarize_windows(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = SERIES_KEYS,
    order_by: Sequence[str] = ("timestamp",),
    size: int = WINDOW_SIZE,
    step: int = WINDOW_STEP,
    method: str = "pane",
    out_type: str = "float",
    hot: HotGroups | None | str = "auto",
) -> DataFrame:
    """Mean and population standard deviation of ``cols`` in every full window.

    Values are taken as 32-bit floats and accumulated as doubles. A null or NaN
    reading makes both statistics of its column and window null. ``method="explode"``
    copies each row into its windows instead of merging panes, with the same result.
    """
    _check(size, step)
    if method not in ("pane", "explode"):
        raise ValueError(f"method must be 'pane' or 'explode', not {method!r}")
    needed = list(dict.fromkeys([*keys, *order_by, *cols]))
    numbered = number_rows(df.select(*needed), keys, order_by, nulls_last=True, hot=hot)

    # One SQL text per column: with dozens of columns, building the same
    # expressions from single function calls would take longer than small runs.
    values = [f"nvl(cast(cast(`{c}` AS float) AS double), double('NaN')) AS `{c}`" for c in cols]
    group = [f"`{k}`" for k in keys]
    if method == "pane":
        stats = _merged_panes(numbered, cols, keys, values, size, step)
    else:
        moments = [F.expr(f"{f}(`{c}`) AS `{c}_{s}`") for c in cols for f, s in (("avg", "mean"), ("stddev_pop", "std"))]
        stats = (
            numbered.withColumn("window_index", _explode_windows(size, step))
            .selectExpr(*group, "window_index", *values)
            .groupBy(*keys, "window_index")
            .agg(F.count(F.lit(1)).alias("_rows"), *moments)
            .where(F.col("_rows") == size)
        )

    out = [
        f"if(isnan(`{c}_{s}`), NULL, cast(`{c}_{s}` AS {out_type})) AS `{c}_{s}`"
        for c in cols
        for s in ("mean", "std")
    ]
    return stats.selectExpr(*group, "cast(window_index AS int) AS window_index", *out)


def _merged_panes(numbered: DataFrame, cols: Sequence[str], keys: Sequence[str], values: list[str], size: int, step: int) -> DataFrame:
    """``keys, window_index, <c>_mean, <c>_std`` of all full windows, from merged panes."""
    pane = math.gcd(size, step)
    k, hop = size // pane, step // pane
    group = [f"`{c}`" for c in keys]

    def each(template: str) -> list[str]:
        return [template.format(v=f"`{c}`", m=f"`{c}_m`", q=f"`{c}_q`", c=c) for c in cols]

    panes = numbered.selectExpr(*group, f"pos div {pane} AS _pane", *values)
    if pane == 1:
        # each row is a pane: nothing to group; what is no finite number deviates from itself by NaN
        full = panes.selectExpr(*group, "_pane", f"_pane div {k} AS _block", *each("{v} AS {m}"), *each("{v} - {v} AS {q}"))
    else:
        panes = panes.groupBy(*keys, "_pane").agg(
            F.count(F.lit(1)).alias("_rows"), *map(F.expr, each("avg({v}) AS {m}")), *map(F.expr, each(f"var_pop({{v}}) * {pane} AS {{q}}"))
        )
        full = panes.where(F.col("_rows") == pane).selectExpr(*group, "_pane", f"_pane div {k} AS _block", *each("{m}"), *each("{q}"))

    # all panes have one size, so the moments of a run of them are plain means and variances
    block = f"PARTITION BY {', '.join([*group, '_block'])}"
    runs = {
        "a": f"OVER ({block} ORDER BY _pane ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        "b": f"OVER ({block} ORDER BY _pane DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    }
    both = full.selectExpr(
        *group,
        "_pane",
        *[f"count(1) {w} AS _{r}" for r, w in runs.items()],
        *[f"avg(`{c}_m`) {w} AS _m{r}{i}" for r, w in runs.items() for i, c in enumerate(cols)],
        *[f"sum(`{c}_q`) {w} + var_pop(`{c}_m`) {w} * count(1) {w} * {pane} AS _q{r}{i}" for r, w in runs.items() for i, c in enumerate(cols)],
    )

    def part(run: str, is_end: bool, index: str) -> str:
        """A run of panes as a part of the window that ends, or begins, with this pane."""
        moments = ", ".join(f"'m{i}', _m{run}{i}, 'q{i}', _q{run}{i}" for i in range(len(cols)))
        return f"named_struct('window_index', {index}, 'is_end', {str(is_end).lower()}, 'n', _{run}, {moments})"

    # a pane ends at most one window and begins at most one; a window that is one block has no
    # second part
    ends = part("a", True, f"CASE WHEN _pane >= {k - 1} AND (_pane - {k - 1}) % {hop} = 0 THEN (_pane - {k - 1}) div {hop} END")
    begins = part("b", False, f"CASE WHEN _pane % {hop} = 0 AND _pane % {k} != 0 THEN _pane div {hop} END")
    parts = both.selectExpr(*group, f"inline(array({ends}, {begins}))").where("window_index IS NOT NULL")
    each_column = range(len(cols))
    merged = parts.groupBy(*keys, "window_index").agg(
        F.expr("sum(n) AS _n"),
        F.expr("max(is_end) AS _ended"),
        *[F.expr(f"sum(m{i} * n) AS _t{i}") for i in each_column],
        *[F.expr(f"sum(q{i}) AS _q{i}") for i in each_column],
        # the parts' means lie apart by their difference, weighted by both parts' panes
        *[F.expr(f"if(count(1) = 2, power(max(m{i}) - min(m{i}), 2) * min(n) * max(n), 0D) AS _d{i}") for i in each_column],
    )
    out = []
    for i, c in enumerate(cols):
        out += [f"_t{i} / _n AS `{c}_mean`", f"sqrt((_q{i} + _d{i} / _n * {pane}) / (_n * {pane})) AS `{c}_std`"]
    return merged.where(f"_ended AND _n = {k}").selectExpr(*group, "window_index", *out)


def collect_windows(
    df: DataFrame,
    cols: Sequence[str] = ("x", "y", "z"),
    keys: Sequence[str] = SERIES_KEYS,
    order_by: Sequence[str] = ("timestamp",),
    size: int = WINDOW_SIZE,
    step: int = WINDOW_STEP,
    max_rows: int | None = None,
    features: str = "features",
    hot: HotGroups | None | str = "auto",
) -> DataFrame:
    """The readings of every full window as an array of ``size`` rows of ``cols``.

    ``max_rows`` keeps only that many first readings of each series. A null or
    NaN reading is a null cell.
    """
    _check(size, step)
    rows = df.select(*dict.fromkeys([*keys, *order_by, *cols]))
    if max_rows is not None:
        numbered = first_n(rows, keys, order_by, max_rows, position="pos", hot=hot)
    else:
        numbered = number_rows(rows, keys, order_by, nulls_last=True, hot=hot)
    cells = F.array(*[nan_to_null(F.col(c).cast("float")) for c in cols])
    entry = F.struct(F.col("pos"), cells.alias("cells"))

    def in_order(entries):
        return F.transform(F.array_sort(entries), lambda e: e.getField("cells"))

    if size % step == 0:
        k = size // step
        windows = (
            numbered.groupBy(*keys, F.expr(f"pos div {step}").alias("_pane"))
            .agg(F.collect_list(entry).alias("_entries"))
            .where(F.size("_entries") == step)
            .select(*keys, "_pane", F.struct("_pane", in_order(F.col("_entries")).alias("cells")).alias("_block"))
            .withColumn("window_index", _explode_panes(k))
            .groupBy(*keys, "window_index")
            .agg(F.collect_list("_block").alias("_blocks"))
            .where(F.size("_blocks") == k)
            .withColumn(features, F.flatten(in_order(F.col("_blocks"))))
        )
    else:
        windows = (
            numbered.withColumn("window_index", _explode_windows(size, step))
            .groupBy(*keys, "window_index")
            .agg(F.collect_list(entry).alias("_entries"))
            .where(F.size("_entries") == size)
            .withColumn(features, in_order(F.col("_entries")))
        )
    return windows.select(*keys, F.col("window_index").cast("int").alias("window_index"), features)


def channel_windows(
    df: DataFrame,
    stream: str,
    channels: Sequence[tuple[object, str]],
    keys: Sequence[str] = SERIES_KEYS,
    order_by: Sequence[str] = ("timestamp",),
    size: int = WINDOW_SIZE,
    step: int = WINDOW_STEP,
    label: str | None = "activity_label",
    class_index: dict | None = None,
    hot: HotGroups | None | str = "auto",
) -> DataFrame:
    """Raw windows of several streams side by side, from one table tagged by ``stream``.

    ``channels`` names a stream and an axis for each channel. A window counts where all of
    their streams have it. Every stream is numbered once, with all its axes; its windows
    then meet in one grouping of at most one row per stream, so the whole takes two
    shuffles and no join. ``label`` is the fixed class index of that column.
    """
    names = list(dict.fromkeys(s for s, _ in channels))
    axes = list(dict.fromkeys(a for _, a in channels))
    rows = df.where(F.col(stream).isin(names)).select(*dict.fromkeys([*keys, stream, *order_by, *axes]))
    windows = collect_windows(rows, axes, [*keys, stream], order_by, size, step, features="_rows", hot=hot)
    met = windows.groupBy(*keys, "window_index").agg(F.map_from_entries(F.collect_list(F.struct(stream, "_rows"))).alias("_streams"))
    met = met.where(F.size("_streams") == len(names))
    arrays = [_axis(F.col("_streams")[F.lit(s)], axes.index(a)) for s, a in channels]
    out = [*keys, "window_index", F.array(*arrays).alias("channels")]
    if label is not None:
        out.append(decode(label, class_index or CLASS_INDEX).alias("label"))
    return met.select(*out)


def tag_streams(streams: dict, axes: Sequence[str] = ("x", "y", "z"), keys: Sequence[str] = SERIES_KEYS, order_by: Sequence[str] = ("timestamp",), stream: str = "stream") -> DataFrame:
    """One table of the readings of several streams, tagged by their names."""
    tagged = [df.select(*dict.fromkeys([*keys, *order_by, *axes]), F.lit(name).alias(stream)) for name, df in streams.items()]
    whole = tagged[0]
    for t in tagged[1:]:
        whole = whole.unionByName(t)
    return whole


def _axis(rows, a: int):
    return F.transform(rows, lambda row: row[a])


def stack_channels(
    frames: Sequence[DataFrame],
    on: Sequence[str] = WINDOW_KEYS,
    features: str = "features",
    axes_per_frame: int = 3,
    label: str | None = "activity_label",
    class_index: dict | None = None,
) -> DataFrame:
    """Join raw windows of several sensors and lay their axes out as channels.

    ``channels`` has one array of readings per axis, in the order of ``frames``;
    ``label`` is the fixed class index of the label column.
    """
    named = [f.select(*on, F.col(features).alias(f"_f{i}")) for i, f in enumerate(frames)]
    joined = named[0]
    for f in named[1:]:
        joined = joined.join(f, list(on), "inner")
    channels = F.array(
        *[
            _axis(F.col(f"_f{i}"), a)
            for i in range(len(frames))
            for a in range(axes_per_frame)
        ]
    )
    out = [*on, channels.alias("channels")]
    if label is not None:
        out.append(decode(label, class_index or CLASS_INDEX).alias("label"))
    return joined.select(*out)
