"""Motion features of each reading, relative to the reading before it."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.functions import guarded_rate, norm, series_label
from strideframe.operators.series import HotGroups, number_rows
from strideframe.schemas import SERIES_KEYS


def engineer_features(
    df: DataFrame,
    triples: Sequence[tuple[str, str, str]],
    keys: Sequence[str] = SERIES_KEYS,
    order_by: Sequence[str] = ("timestamp",),
    time_col: str = "timestamp",
    ticks_per_second: float = 1e9,
    hot: HotGroups | None | str = "auto",
) -> DataFrame:
    """Add ``seq_id`` and eleven features per axis triple.

    For axes x, y, z: the change since the previous reading (``x_dx``), the
    change per second (``x_ax``), the vector length (``x_magnitude``), the
    products of two axes (``x_y``) and the length of the rate vector
    (``x_jerk``). One shuffle and one sort serve all of them.
    """
    triples = [tuple(t) for t in triples]
    all_axes = [a for t in triples for a in t]
    numbered = number_rows(
        df, keys, order_by, position="_pos", lags=[time_col, *all_axes], hot=hot
    )

    seconds = (F.col(time_col) - F.col(f"prev_{time_col}")) / F.lit(float(ticks_per_second))
    changes = {
        a: F.coalesce(F.col(a) - F.col(f"prev_{a}"), F.lit(0.0)) for a in all_axes
    }
    stepped = numbered.withColumns(
        {"_seconds": seconds, **{f"{a}_d{s}": changes[a] for a, s in _with_suffix(triples)}}
    )
    rated = stepped.withColumns(
        {f"{a}_a{s}": guarded_rate(f"{a}_d{s}", "_seconds") for a, s in _with_suffix(triples)}
    )

    out = [F.col(c) for c in df.columns]
    out.append(series_label(*keys, F.col("_pos") + 1).alias("seq_id"))
    for t in triples:
        out += [F.col(f"{a}_d{s}") for a, s in zip(t, "xyz")]
        out += [F.col(f"{a}_a{s}") for a, s in zip(t, "xyz")]
        out.append(norm(*t).alias(f"{t[0]}_magnitude"))
        out += [(F.col(a) * F.col(b)).alias(f"{a}_{b}") for a, b in combinations(t, 2)]
        out.append(norm(*[f"{a}_a{s}" for a, s in zip(t, "xyz")]).alias(f"{t[0]}_jerk"))
    return rated.select(*out)


def _with_suffix(triples):
    return [(a, s) for t in triples for a, s in zip(t, "xyz")]
