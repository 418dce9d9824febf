import random

import pytest
from pyspark.sql import functions as F

from strideframe.operators import engineer_features, first_n, hot_groups, number_rows
from strideframe.operators.series import MAX_SERIES_ROWS
from tests.conftest import rows

KEYS = ["s", "a"]


@pytest.fixture(scope="module")
def series(spark):
    """One series holds half of the rows, one has a null key, times are tied."""
    rnd = random.Random(7)
    data = []
    for key, n in (((1, "A"), 2000), ((1, "B"), 700), ((2, None), 900), ((3, "A"), 5), ((4, "A"), 1)):
        data += [(*key, rnd.randrange(n // 3 + 1), i, rnd.random()) for i in range(n)]
    rnd.shuffle(data)
    return spark.createDataFrame(data, "s int, a string, t long, tie int, v double").repartition(5)


def forced(df, keys, max_rows=600, part_rows=150):
    hot = hot_groups(df, keys, max_rows=max_rows, part_rows=part_rows)
    assert hot is not None
    return hot


def test_hot_groups_are_those_above_the_limit(spark, series):
    hot = forced(series, KEYS)
    assert {(r.s, r.a, r._rows) for r in hot.table.collect()} == {(1, "A", 2000), (1, "B", 700), (2, None, 900)}
    assert (hot.groups, hot.rows) == (3, 3600)
    assert hot_groups(series, KEYS, max_rows=5000) is None


def test_one_long_series_is_found_whatever_its_estimated_size(spark):
    """Six million rows of one series have an estimate of a few megabytes."""
    df = spark.range(6_000_000).select(F.lit(1).alias("k"), "id")
    hot = hot_groups(df, ["k"])
    assert (hot.groups, hot.rows) == (1, 6_000_000) and MAX_SERIES_ROWS < 6_000_000


@pytest.mark.parametrize("length", [None, "n"])
def test_split_series_equal_whole_series(spark, series, length):
    args = dict(order_by=["t", "tie"], lags=["t", "v"], length=length)
    whole = number_rows(series, KEYS, hot=None, **args)
    split = number_rows(series, KEYS, hot=forced(series, KEYS), **args)
    assert whole.columns == split.columns
    assert rows(whole) == rows(split)


def test_split_series_really_are_split(spark, series):
    hot = forced(series, KEYS)
    number_rows(series, KEYS, ["t", "tie"], hot=hot)
    members = hot.members(series)
    assert members.count() == 3600
    assert hot.rest(series).count() == series.count() - 3600


def test_weights(spark, series):
    weighted = series.withColumn("w", (F.col("tie") % 5).cast("long"))
    args = dict(order_by=["t", "tie"], weight="w", position="before")
    whole = number_rows(weighted, KEYS, hot=None, **args)
    split = number_rows(weighted, KEYS, hot=forced(weighted, KEYS), **args)
    assert rows(whole) == rows(split)


def test_without_keys_the_table_is_one_series(spark, series):
    whole = number_rows(series, [], ["s", "a", "t", "tie"], length="n", hot=None)
    split = number_rows(series, [], ["s", "a", "t", "tie"], length="n", hot=forced(series, []))
    assert rows(whole) == rows(split)
    assert split.agg(F.max("pos")).first()[0] == series.count() - 1


def test_a_mass_of_equal_rows_is_numbered_once_each(spark):
    copies = spark.range(3000).select(F.lit(1).alias("s"), F.lit("A").alias("a"), F.lit(5).alias("t")).repartition(6)
    numbered = number_rows(copies, KEYS, ["t"], lags=["t"], hot=forced(copies, KEYS))
    got = numbered.agg(F.min("pos"), F.max("pos"), F.count_distinct("pos"), F.count("prev_t")).first()
    assert tuple(got) == (0, 2999, 3000, 2999)


def test_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (1, 3), (1, 2)], "s int, t int")
    last = number_rows(df, ["s"], ["t"], nulls_last=True, hot=None)
    assert {r.t: r.pos for r in last.collect()} == {2: 0, 3: 1, None: 2}
    first = number_rows(df, ["s"], ["t"], hot=None)
    assert {r.t: r.pos for r in first.collect()} == {None: 0, 2: 1, 3: 2}


@pytest.mark.parametrize("n", [0, 1, 137, 5000])
def test_first_n(spark, series, n):
    whole = first_n(series, KEYS, ["t", "tie"], n, position="pos", hot=None)
    split = first_n(series, KEYS, ["t", "tie"], n, position="pos", hot=forced(series, KEYS), share_rows=50)
    assert rows(whole) == rows(split)
    sizes = {(r.s, r.a): r["count"] for r in whole.groupBy(*KEYS).count().collect()}
    if n:
        assert sizes[(1, "A")] == min(n, 2000) and sizes[(4, "A")] == 1


def test_layout_does_not_matter(spark, series):
    results = [
        rows(number_rows(series.repartition(p), KEYS, ["t", "tie"], lags=["v"], hot=None)) for p in (1, 3, 16)
    ]
    assert results[0] == results[1] == results[2]


def test_features_of_split_series(spark, series):
    df = series.select("s", "a", "t", "tie", F.col("v").alias("x"), (F.col("v") * 2).alias("y"), F.col("t").cast("double").alias("z"))
    args = dict(triples=[("x", "y", "z")], keys=KEYS, order_by=["t", "tie"], time_col="t")
    assert rows(engineer_features(df, hot=None, **args)) == rows(engineer_features(df, hot=forced(df, KEYS), **args))
