import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strideframe import operators as ops
from strideframe.operators import summaries
from strideframe.sources import materialize


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(11)
    n = 6000
    df = pd.DataFrame(
        {
            "subject_id": rng.integers(1600, 1605, n),
            "activity_label": rng.choice(["A", "B", "N"], n, p=[0.8, 0.19, 0.01]),
            "x": rng.normal(size=n),
            "y": np.round(rng.exponential(size=n), 1),
            "z": rng.standard_cauchy(n),
        }
    )
    df.loc[df.sample(frac=0.02, random_state=1).index, "x"] = np.nan
    return df


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf).repartition(5).cache()


def brute_box(values):
    v = np.sort(values[~np.isnan(values)])
    q1, q2, q3 = np.percentile(v, [25, 50, 75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    above, below = v[v >= low], v[v <= high]
    return (
        len(v), q1, q2, q3,
        min(above.min(), q1) if len(above) else q1,
        max(below.max(), q3) if len(below) else q3,
        int(((v < low) | (v > high)).sum()),
    )


BRACKETS = [(summaries.BRACKET, summaries.REACH_RANKS), (0.02, 4), (1e-5, 0), (1.0, 0)]


@pytest.mark.parametrize("bracket, reach", BRACKETS)
def test_box_summary_is_exact(spark, df, pdf, bracket, reach):
    """Whatever the first brackets are: too narrow ones are widened until they hold."""
    got = {(r.activity_label, r.column): tuple(r)[2:] for r in ops.box_summary(df, ["x", "y", "z"], bracket=bracket, reach=reach).collect()}
    for label, g in pdf.dropna(subset=["activity_label"]).groupby("activity_label"):
        for c in "xyz":
            want = brute_box(g[c].to_numpy())
            assert got[label, c][0] == want[0] and got[label, c][-1] == want[-1]
            assert np.allclose(got[label, c][1:-1], want[1:-1], rtol=1e-12), (label, c)


def test_a_missed_bracket_is_counted_again(spark, df, pdf, monkeypatch):
    rounds, real = [], summaries._ranked_cells
    monkeypatch.setattr(summaries, "_ranked_cells", lambda *a: rounds.append(1) or real(*a))
    r = ops.box_summary(df, ["z"], bracket=1e-5, reach=0).where("activity_label = 'A'").first()
    assert len(rounds) > 1
    assert np.allclose((r.q1, r.median, r.q3), brute_box(pdf.loc[pdf.activity_label == "A", "z"].to_numpy())[1:4], rtol=1e-12)
    rounds.clear()
    ops.box_summary(df, ["z"]).collect()
    assert len(rounds) == 1


def test_box_summary_over_split_groups(spark, df, pdf, monkeypatch):
    calls = []

    def forced(frame, keys):
        calls.append(keys)
        return ops.hot_groups(frame, keys, max_rows=300, part_rows=100)

    monkeypatch.setattr(summaries, "number_rows", lambda f, keys, *a, hot, **k: ops.number_rows(f, keys, *a, hot=forced(f, keys), **k))
    r = ops.box_summary(df, ["z"], bracket=1.0).where("activity_label = 'A'").first()
    want = brute_box(pdf.loc[pdf.activity_label == "A", "z"].to_numpy())
    assert calls and np.allclose((r.q1, r.median, r.q3), want[1:4], rtol=1e-12)


def test_box_of_few_values(spark):
    df = spark.createDataFrame([("A", 0.0), ("A", 0.0), ("A", 0.0), ("A", 100.0), ("B", 1.0), ("C", None), (None, 1.0)], "activity_label string, v double")
    got = {r.activity_label: r for r in ops.box_summary(df, ["v"]).collect()}
    assert set(got) == {"A", "B"}
    # no value lies between the box and the upper fence, so the whisker ends at the box
    assert (got["A"].q3, got["A"].whisker_high, got["A"].outliers) == (25.0, 25.0, 1)
    assert (got["B"].q1, got["B"].median, got["B"].whisker_low) == (1.0, 1.0, 1.0)


def test_approximate_boxes_are_near(spark, df):
    exact = {(r.activity_label, r.column): r for r in ops.box_summary(df, ["x"]).collect()}
    for r in ops.box_summary(df, ["x"], method="approx").collect():
        assert abs(r.median - exact[(r.activity_label, r.column)].median) < 0.1
    with pytest.raises(ValueError):
        ops.box_summary(df, ["x"], method="other")


def test_correlation_matches_pandas(spark, df, pdf):
    want = pdf[["x", "y", "z"]].corr()
    got = ops.corr_matrix(df, ["x", "y", "z"]).collect()
    assert len(got) == 9
    for r in got:
        assert np.isclose(r.corr, want.loc[r.col_a, r.col_b], atol=1e-12)


def test_describe(spark, df, pdf):
    got = {r.column: r for r in ops.describe_long(df.withColumn("x", F.nanvl("x", F.lit(None))), ["x", "y"]).collect()}
    assert got["x"]["count"] == pdf.x.count()
    assert np.isclose(got["x"].stddev, pdf.x.std()) and np.isclose(got["y"].mean, pdf.y.mean())
    assert (got["y"].min, got["y"].max) == (pdf.y.min(), pdf.y.max())


def test_counts_and_names(spark, df, pdf):
    got = {r.activity_label: (r.rows, r.activity_name) for r in ops.activity_counts(df).collect()}
    want = pdf.activity_label.value_counts()
    assert got == {"A": (want["A"], "Walking"), "B": (want["B"], "Jogging"), "N": (want["N"], "N")}
    assert [r[0] for r in ops.category_names(df).collect()] == ["Jogging", "N", "Walking"]


def test_subject_counts_carry_the_mean(spark, df, pdf):
    got = ops.subject_counts(df).collect()
    assert [r.subject_id for r in got] == sorted(pdf.subject_id.unique())
    assert {r.mean_rows for r in got} == {len(pdf) / pdf.subject_id.nunique()}


def test_overview(spark, df, pdf):
    r = ops.overview(df).first()
    assert (r.rows, r.features, r.columns, r.subjects, r.activities) == (len(pdf), 3, 5, 5, 3)
    assert ops.overview(df, approximate=True).first().subjects == 5


def test_dictionary_in_a_table(spark, df):
    names = spark.createDataFrame([("A", "alpha")], "code string, name string")
    got = ops.with_activity_name(ops.counts_by(df, "activity_label"), "activity_label", names).collect()
    assert {r.activity_label: r.activity_name for r in got} == {"A": "alpha", "B": "B", "N": "N"}


def test_many_correlations_run_as_generated_code(spark):
    names = [f"c{i}" for i in range(18)]
    wide = spark.range(60).select(*[F.when(F.col("id") % 7 != i % 7, F.sin(F.col("id") * (i + 1))).alias(c) for i, c in enumerate(names)])
    matrix = ops.corr_matrix(wide, names)
    got = {(r.col_a, r.col_b): r["corr"] for r in matrix.collect()}
    want = wide.toPandas().corr(min_periods=2)
    assert len(got) == 18 * 18
    assert all(got[a, b] == got[b, a] and np.isclose(got[a, b], want.loc[a, b], atol=1e-9) for a in names for b in names)
    steps = [x for x in matrix._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].split("\n") if "partial_corr" in x]
    assert steps and all("*(" in x for x in steps), steps


def test_correlations_of_no_rows_are_null(spark):
    none = spark.createDataFrame([], "x double, y double")
    assert {tuple(r) for r in ops.corr_matrix(none, ["x", "y"]).collect()} == {(a, b, None) for a in "xy" for b in "xy"}


def test_boxes_judge_one_column_at_a_time(spark):
    rows = spark.range(30).select(F.lit("A").alias("_by"), *[(F.col("id") * (i + 1)).cast("double").alias(f"_v{i}") for i in range(7)])
    bracket = F.struct(F.lit(3.0).alias("lo"), F.lit(9.0).alias("hi"))
    brackets = spark.range(7).select(F.lit("A").alias("_by"), F.col("id").cast("int").alias("_col"), F.lit(30).cast("long").alias("_n"), F.array(bracket, bracket, bracket).alias("_b"))
    plans = []
    kept = summaries.materialize
    try:
        summaries.materialize = lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df
        summaries._ranked_cells(rows, brackets, 7, None)
    finally:
        summaries.materialize = kept
    made = [x for x in plans[0].split("\n") if "inline(" in x]
    assert len(made) == 1 and "CASE WHEN" not in made[0], plans[0][:3000]


def test_boxes_of_a_written_table_are_read_from_it(spark, df, monkeypatch):
    names = []
    monkeypatch.setattr(summaries, "materialize", lambda df, name: names.append(name) or materialize(df, name))
    got, want = (ops.box_summary(df, ["x", "z"], written=w).collect() for w in (True, False))
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) > 0
    assert names.count("box-values") == 1 and names.count("box-ladder") == 2
