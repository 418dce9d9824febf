import math

import pytest
from pyspark.sql import functions as F

from strideframe.functions import (
    argmax,
    decode,
    guarded_rate,
    nan_to_null,
    norm,
    parse_reading,
    rounded,
    series_label,
    snap_to_grid,
)


def value(spark, column, **cells):
    names = list(cells)
    df = spark.createDataFrame([tuple(cells.values())], ", ".join(f"{n} {t}" for n, t in _types(cells).items()))
    assert names
    return df.select(column.alias("v")).first()["v"]


def _types(cells):
    kind = {int: "bigint", float: "double", str: "string", type(None): "bigint"}
    return {n: kind[type(v)] for n, v in cells.items()}


@pytest.mark.parametrize(
    "ts, aligned",
    [
        (0, 0),
        (24, 0),
        (25, 50),
        (75, 100),
        (-75, -100),
        (-24, 0),
        (252207666810782, 252207666810800),
        # a double has a spacing of 256 here, integers keep the grid
        (1522531232393954025, 1522531232393954050),
        (None, None),
    ],
)
def test_snap_to_grid(spark, ts, aligned):
    assert value(spark, snap_to_grid("t", 50), t=ts) == aligned


@pytest.mark.parametrize(
    "text, parsed",
    [("-2.00;", -2.0), ("-2.50 ;", -2.5), (" 1;5;", 15.0), ("abc;", None), (";", None), ("", None), ("1e2;", 100.0)],
)
def test_parse_reading(spark, text, parsed):
    assert value(spark, parse_reading("z"), z=text) == parsed


def test_guarded_rate(spark):
    rate = guarded_rate("d", "s")
    assert value(spark, rate, d=6.0, s=2.0) == 3.0
    assert value(spark, rate, d=6.0, s=0.0) == 0.0
    df = spark.createDataFrame([(6.0, None)], "d double, s double")
    assert df.select(rate.alias("v")).first()["v"] == 0.0


def test_norm_is_null_when_an_axis_is_null(spark):
    df = spark.createDataFrame([(3.0, 4.0), (3.0, None)], "a double, b double")
    assert [r[0] for r in df.select(norm("a", "b")).collect()] == [5.0, None]


def test_decode_gives_null_for_unknown_keys(spark):
    assert value(spark, decode("c", {"A": "Walking"}), c="A") == "Walking"
    assert value(spark, decode("c", {"A": "Walking"}), c="N") is None


def test_argmax_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.7],)], "s array<double>")
    assert df.select(argmax("s")).first()[0] == 1


def test_series_label_skips_nulls(spark):
    df = spark.createDataFrame([(1600, None)], "s int, a string")
    assert df.select(series_label("s", "a", F.lit(3))).first()[0] == "1600-3"


def test_nan_to_null(spark):
    assert value(spark, nan_to_null("v"), v=math.nan) is None
    assert value(spark, nan_to_null("v"), v=1.5) == 1.5


def test_rounded_has_no_negative_zero(spark):
    assert value(spark, rounded("v", 2), v=1.23456) == 1.23
    assert str(value(spark, rounded("v", 2), v=-0.0001)) == "0.0"
