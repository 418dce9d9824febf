"""Scalar column expressions. Each one is built from JVM-side functions only."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_terminator(c: str | Column, terminator: str = ";") -> Column:
    """The text without any ``terminator`` and without outer blanks."""
    return F.trim(F.replace(_col(c), F.lit(terminator), F.lit("")))


def parse_reading(c: str | Column, terminator: str = ";") -> Column:
    """A dirty sensor value as float; text that is no number becomes null."""
    return strip_terminator(c, terminator).try_cast("float")


def snap_to_grid(c: str | Column, grid: int = 50) -> Column:
    """The nearest multiple of ``grid``, halves away from zero, in integers.

    A double would lose the grid above 2**53, where nanosecond clocks live.
    """
    value = _col(c).cast("long")
    shifted = F.abs(value) + F.lit(grid // 2)
    snapped = shifted - shifted % F.lit(grid)
    return F.when(value < 0, -snapped).otherwise(snapped)


def norm(*cols: str | Column) -> Column:
    """Euclidean length of the vector of ``cols``; null if any of them is null."""
    return F.sqrt(reduce(lambda a, b: a + b, [F.pow(_col(c), F.lit(2.0)) for c in cols]))


def guarded_rate(change: str | Column, seconds: str | Column) -> Column:
    """``change / seconds``, and 0.0 where no time is known to have passed."""
    dt = _col(seconds)
    return F.when(dt.isNull() | (dt == 0), F.lit(0.0)).otherwise(_col(change) / dt)


def series_label(*parts: str | Column, sep: str = "-") -> Column:
    """The parts as one text key; null parts are left out."""
    return F.concat_ws(sep, *[_col(p).cast("string") for p in parts])


def decode(c: str | Column, mapping: Mapping) -> Column:
    """Look ``c`` up in a small literal map; a missing key gives null."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _col(c))


def argmax(scores: str | Column) -> Column:
    """0-based position of the first largest element of an array."""
    a = _col(scores)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def nan_to_null(c: str | Column) -> Column:
    v = _col(c)
    return F.when(~F.isnan(v), v)


def null_to_nan(c: str | Column) -> Column:
    return F.coalesce(_col(c).cast("double"), F.lit(float("nan")))


def rounded(c: str | Column, digits: int = 6) -> Column:
    """``c`` rounded for display, as double and without a negative zero."""
    return F.round(_col(c).cast("double"), digits) + F.lit(0.0)
