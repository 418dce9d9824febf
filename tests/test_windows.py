import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strideframe.operators import (
    assign_windows,
    channel_windows,
    collect_windows,
    hot_groups,
    stack_channels,
    summarize_windows,
    tag_streams,
)
from strideframe.operators import series
from strideframe.sources import materialize
from tests.conftest import rows

SIZES = {0: 0, 1: 0, 199: 0, 200: 1, 299: 1, 300: 2, 450: 3}


def make_series(spark, lengths):
    rng = np.random.default_rng(3)
    parts = [
        pd.DataFrame(
            {
                "subject_id": np.full(n, i, "int32"),
                "activity_label": "A",
                "timestamp": np.arange(n, dtype="int64") * 50,
                "x": rng.normal(size=n).astype("float32"),
                "y": (1e5 + rng.normal(size=n)).astype("float32"),
                "z": rng.normal(size=n).astype("float32"),
            }
        )
        for i, n in lengths.items()
    ]
    shuffled = pd.concat(parts).sample(frac=1, random_state=1)
    kinds = "subject_id int, activity_label string, timestamp long, x float, y float, z float"
    return spark.createDataFrame(shuffled, kinds).repartition(4)


@pytest.fixture(scope="module")
def readings(spark):
    return make_series(spark, {n: n for n in SIZES}).cache()


def expected(pdf, cols, size, step):
    """Brute force over each series."""
    out = {}
    for (s, a), g in pdf.groupby(["subject_id", "activity_label"]):
        values = g.sort_values("timestamp")[list(cols)].to_numpy("float64")
        for i, start in enumerate(range(0, len(values) - size + 1, step)):
            out[(s, a, i)] = values[start : start + size]
    return out


@pytest.mark.parametrize(
    "size, step, method",
    [(200, 100, "pane"), (50, 25, "pane"), (50, 20, "pane"), (20, 30, "pane"), (7, 7, "pane"), (1, 1, "pane"), (50, 5, "pane"), (200, 7, "pane"), (30, 50, "pane"), (50, 5, "explode"), (50, 20, "explode")],
)
def test_summaries_match_brute_force(spark, readings, size, step, method):
    got = summarize_windows(readings, ["x", "y"], size=size, step=step, method=method).toPandas()
    want = expected(readings.toPandas(), ["x", "y"], size, step)
    assert {(r.subject_id, r.activity_label, r.window_index) for r in got.itertuples()} == set(want)
    for r in got.itertuples():
        w = want[(r.subject_id, r.activity_label, r.window_index)]
        assert np.allclose([r.x_mean, r.y_mean], w.mean(axis=0), rtol=1e-6, atol=1e-6)
        assert np.allclose([r.x_std, r.y_std], w.std(axis=0), rtol=1e-4, atol=1e-6)


def test_number_of_windows(spark, readings):
    counts = {r.subject_id: r["count"] for r in summarize_windows(readings, ["x"]).groupBy("subject_id").count().collect()}
    assert counts == {n: w for n, w in SIZES.items() if w}


def test_schema_of_a_summary(spark, readings):
    df = summarize_windows(readings, ["x", "y"])
    assert [(c, t) for c, t in df.dtypes] == [
        ("subject_id", "int"), ("activity_label", "string"), ("window_index", "int"),
        ("x_mean", "float"), ("x_std", "float"), ("y_mean", "float"), ("y_std", "float"),
    ]


@pytest.mark.parametrize("method", ["pane", "explode"])
@pytest.mark.parametrize("hole", [None, float("nan")])
def test_a_missing_reading_voids_its_windows(spark, readings, method, hole):
    one = readings.where("subject_id = 300")
    holed = one.withColumn("x", F.when(F.col("timestamp") == 50 * 50, F.lit(hole).cast("float")).otherwise(F.col("x")))
    got = {r.window_index: r for r in summarize_windows(holed, ["x", "y"], method=method).collect()}
    assert got[0].x_mean is None and got[0].x_std is None and got[0].y_mean is not None
    assert got[1].x_mean is not None


def test_wrong_arguments(spark, readings):
    with pytest.raises(ValueError):
        summarize_windows(readings, ["x"], size=0)
    with pytest.raises(ValueError):
        summarize_windows(readings, ["x"], method="other")


def test_more_rows_take_more_tasks(spark, readings, monkeypatch):
    args = {"cols": ["x", "y"], "size": 50, "step": 7}
    want = rows(summarize_windows(readings, **args))
    monkeypatch.setattr(series, "TASK_ROWS", 60)
    got = summarize_windows(readings, **args)
    n = -(-readings.count() // 60)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert n > spark.sparkContext.defaultParallelism and f", {n})" in plan and plan.count("hashpartitioning") == 1, plan[:3000]
    assert rows(got) == want


def test_panes_of_one_row_are_not_grouped(spark, readings):
    plan = summarize_windows(readings, ["x"], size=50, step=7)._jdf.queryExecution().executedPlan().toString()
    assert "_pane" not in "".join(x for x in plan.split("\n") if "Aggregate(" in x)


@pytest.mark.parametrize("size, step", [(200, 7), (50, 20)])
def test_panes_copy_no_row(spark, readings, size, step):
    """Nothing multiplies rows but the two ends of each window, after panes are made."""
    table = materialize(readings, "readings")
    plan = summarize_windows(table, ["x"], size=size, step=step, hot=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate ") == 1 and "sequence(" not in plan
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("size, step", [(200, 100), (50, 20), (20, 30), (60, 10)])
def test_split_series_give_the_same_windows(spark, readings, size, step):
    hot = hot_groups(readings, ["subject_id", "activity_label"], max_rows=250, part_rows=60)
    assert hot.groups == 3
    args = dict(size=size, step=step, out_type="double")
    whole = summarize_windows(readings, ["x"], hot=None, **args).toPandas()
    split = summarize_windows(readings, ["x"], hot=hot, **args).toPandas()
    keys = ["subject_id", "window_index"]
    whole, split = (d.sort_values(keys, ignore_index=True) for d in (whole, split))
    assert whole[keys].equals(split[keys])
    assert np.allclose(whole[["x_mean", "x_std"]], split[["x_mean", "x_std"]], rtol=1e-12)
    same = [rows(collect_windows(readings, ["x"], size=size, step=step, hot=h)) for h in (None, hot)]
    assert same[0] == same[1]


@pytest.mark.parametrize("size, step", [(200, 100), (50, 20), (20, 30)])
def test_assignment_matches_brute_force(spark, readings, size, step):
    got = assign_windows(readings, size=size, step=step).groupBy("subject_id", "window_index").agg(
        F.min("pos"), F.max("pos"), F.count_distinct("pos")
    )
    want = expected(readings.toPandas(), ["x"], size, step)
    assert rows(got) == sorted(
        ((s, i, i * step, i * step + size - 1, size) for s, _, i in want), key=repr
    )


def test_raw_windows_match_a_grouped_pandas_twin(spark, readings):
    def slices(pdf):
        pdf = pdf.sort_values("timestamp")
        values = pdf[["x", "y", "z"]].to_numpy("float32")[:230]
        out = [
            (int(pdf.subject_id.iloc[0]), pdf.activity_label.iloc[0], i, values[s : s + 50].tolist())
            for i, s in enumerate(range(0, len(values) - 49, 25))
        ]
        return pd.DataFrame(out, columns=["subject_id", "activity_label", "window_index", "features"])

    twin = readings.groupBy("subject_id", "activity_label").applyInPandas(
        slices, "subject_id int, activity_label string, window_index int, features array<array<float>>"
    )
    native = collect_windows(readings, size=50, step=25, max_rows=230)
    assert rows(native) == rows(twin)


def test_first_rows_only(spark):
    long = make_series(spark, {1: 3601, 2: 3600})
    windows = collect_windows(long, max_rows=3600)
    assert rows(windows.groupBy("subject_id").count()) == [(1, 35), (2, 35)]


def test_missing_cells_of_raw_windows_are_null(spark):
    df = spark.createDataFrame(
        [(1, "A", t, float("nan") if t == 1 else 1.0, None if t == 2 else 2.0, 3.0) for t in range(4)],
        "subject_id int, activity_label string, timestamp long, x double, y double, z double",
    )
    got = collect_windows(df, size=4, step=4).first()["features"]
    assert got == [[1.0, 2.0, 3.0], [None, 2.0, 3.0], [1.0, None, 3.0], [1.0, 2.0, 3.0]]


def test_channels(spark, readings):
    frames = [collect_windows(readings, cols, size=50, step=25) for cols in (("x", "y", "z"), ("z", "x", "y"))]
    r = stack_channels(frames).where("subject_id = 200 and window_index = 2").first()
    a = frames[0].where("subject_id = 200 and window_index = 2").first()["features"]
    assert len(r.channels) == 6 and {len(c) for c in r.channels} == {50}
    assert r.channels[0] == [row[0] for row in a]
    assert r.channels[4] == r.channels[0] and r.channels[3] == r.channels[2]
    assert r.label == 0


def test_tagged_streams_give_the_same_channels(spark, readings):
    other = readings.where("subject_id <> 300").withColumn("x", F.col("x") * 2)
    frames = [collect_windows(d, size=50, step=25) for d in (readings, other)]
    joined = stack_channels(frames)
    tagged = tag_streams({"wa": readings, "wg": other})
    one = channel_windows(tagged, "stream", [(s, c) for s in ("wa", "wg") for c in "xyz"], size=50, step=25)
    assert rows(one.select(*joined.columns)) == rows(joined)
    written = materialize(tagged, "streams")
    plan = channel_windows(written, "stream", [("wa", "x"), ("wg", "x")], size=50, step=25, hot=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 3 and "Join" not in plan


def test_channels_keep_common_windows_only(spark, readings):
    first = collect_windows(readings, size=50, step=25)
    second = collect_windows(readings.where("subject_id <> 300"), size=50, step=25)
    stacked = stack_channels([first, second])
    assert stacked.where("subject_id = 300").count() == 0
    assert stacked.count() == second.count()
