"""Every query of the workload against its SQL twin, and the shape of the plans.

The text queries have their own tests beside their operators'.
"""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from strideframe import operators as ops
from workload import adapters as a
from workload import oracles
from workload import queries as q

SF = "/root/testdata/sf0.001"
TABLES = ("lineitem", "events", "embeddings", "supplier")
SLOW = {"stacked_predictions", "stacked_accuracy_by_activity", "feature_importance", "sequence_predictions"}
#: Whole runs, whose last plan is a scan of the manifest or a comparison.
RUNS = {"activity_run", "sequence_run", "model_reload", "sequence_reload"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracles.ALL))
def test_query_matches_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF).toPandas()
    want = duck.execute(contract.oracle_sql()[name]).fetch_df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) > 0
    cols = sorted(got.columns)
    got, want = (d[cols].sort_values(cols, ignore_index=True) for d in (got, want))
    for c in cols:
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        assert same.all(), (c, got[c][~same].head(), want[c][~same].head())


@pytest.mark.parametrize("name", sorted(set(q.ALL) - set(oracles.ALL) - SLOW))
def test_other_queries_run(spark, name):
    assert contract.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 6000 and "x_jerk" in df.columns


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_take_one_shuffle_and_one_sort(spark):
    p = plan(q.motion_features(spark, SF))
    assert p.count("Exchange ") == 1 and p.count("Sort [") == 1 and p.count("Window [") == 1
    assert "l_tax" not in p.split("ReadSchema")[1]


def test_window_summary_adds_no_shuffle_to_the_numbering(spark):
    for query in (q.window_summary, q.window_summary_uneven, q.feature_window_summary):
        assert plan(query(spark, SF)).count("Exchange ") == 1
    p = plan(q.raw_windows(spark, SF))
    assert p.count("Exchange ") == 1


def test_no_query_plans_a_cross_join(spark):
    for name in q.ALL:
        if name not in SLOW | RUNS:
            p = plan(contract.queries()[name](spark, SF))
            assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
            assert "Python" not in p and "InPandas" not in p, name


@pytest.mark.parametrize("name, parses", [("malformed_lines", 2), ("malformed_clean", 2), ("malformed_counts", 0)])
def test_a_line_is_parsed_once_and_its_texts_once(spark, name, parses):
    optimized = contract.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan()
    assert optimized.toString().count("from_csv(") == parses


def test_filters_reach_the_scan(spark):
    p = plan(a.sensor_pair(spark, SF)[0])
    assert "In(event_type, [click,purchase])" in p


def test_the_hot_way_is_taken(spark):
    hot = q._small_hot(a.lineitem_readings(spark, SF))
    assert hot is not None and hot.groups >= 1
    members = hot.members(a.lineitem_readings(spark, SF))
    assert members.agg(F.count_distinct("_series")).first()[0] == hot.groups


def test_windows_do_not_depend_on_the_layout(spark):
    df = a.lineitem_readings(spark, SF)
    args = dict(cols=["x"], order_by=a.LINEITEM_ORDER, size=50, step=25, out_type="double")
    one, many = (
        ops.summarize_windows(df.repartition(p), **args).orderBy("subject_id", "activity_label", "window_index").toPandas()
        for p in (1, 13)
    )
    assert np.allclose(one[["x_mean", "x_std"]], many[["x_mean", "x_std"]], rtol=1e-12)
