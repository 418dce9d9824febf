import math

import pytest

from strideframe.operators import align_time, engineer_features, fuse_sensors, rename_axes
from tests.conftest import rows

SCHEMA = "subject_id int, activity_label string, timestamp long, wa_x float, wa_y float, wa_z float"
TRIPLE = [("wa_x", "wa_y", "wa_z")]


def features(spark, data):
    return engineer_features(spark.createDataFrame(data, SCHEMA), TRIPLE)


def test_columns_and_types(spark):
    df = features(spark, [(1600, "A", 0, 1.0, 2.0, 2.0)])
    assert df.columns == [
        "subject_id", "activity_label", "timestamp", "wa_x", "wa_y", "wa_z", "seq_id",
        "wa_x_dx", "wa_y_dy", "wa_z_dz", "wa_x_ax", "wa_y_ay", "wa_z_az", "wa_x_magnitude",
        "wa_x_wa_y", "wa_x_wa_z", "wa_y_wa_z", "wa_x_jerk",
    ]
    kinds = dict(df.dtypes)
    assert all(kinds[c] == "double" for c in ("wa_x_dx", "wa_y_ay", "wa_x_magnitude", "wa_x_jerk"))
    assert kinds["wa_x_wa_y"] == "float"


def test_changes_and_rates(spark):
    second = 10**9
    got = {
        r.seq_id: r
        for r in features(
            spark,
            [
                (1600, "A", 0, 1.0, 2.0, 2.0),
                (1600, "A", 2 * second, 4.0, 2.0, -2.0),
                (1600, "B", 5 * second, 9.0, 9.0, 9.0),
                (1601, "A", 5 * second, 7.0, 7.0, 7.0),
            ],
        ).collect()
    }
    first, then = got["1600-A-1"], got["1600-A-2"]
    assert (first.wa_x_dx, first.wa_x_ax, first.wa_x_jerk) == (0.0, 0.0, 0.0)
    assert first.wa_x_magnitude == 3.0
    assert (then.wa_x_dx, then.wa_y_dy, then.wa_z_dz) == (3.0, 0.0, -4.0)
    assert (then.wa_x_ax, then.wa_z_az, then.wa_x_jerk) == (1.5, -2.0, 2.5)
    assert (then.wa_x_wa_y, then.wa_x_wa_z, then.wa_y_wa_z) == (8.0, -8.0, -4.0)
    assert got["1600-B-1"].wa_x_dx == 0.0 and got["1601-A-1"].wa_x_dx == 0.0


def test_no_time_passed_gives_no_rate(spark):
    got = features(spark, [(1, "A", 5, 1.0, 1.0, 1.0), (1, "A", 5, 1.0, 1.0, 1.0)]).collect()
    assert {r.wa_x_ax for r in got} == {0.0}


def test_null_axis(spark):
    got = {r.timestamp: r for r in features(spark, [(1, "A", 5, 1.0, 1.0, 1.0), (1, "A", 10**9, None, 3.0, 1.0)]).collect()}
    row = got[10**9]
    assert row.wa_x_dx == 0.0 and row.wa_y_dy == 2.0
    assert row.wa_x_magnitude is None and row.wa_x_wa_y is None
    assert row.wa_y_wa_z == 3.0
    assert row.wa_x_jerk is not None and math.isfinite(row.wa_x_jerk)


def sensor(spark, data):
    return spark.createDataFrame(data, "subject_id int, activity_label string, timestamp long, x float, y float, z float")


@pytest.fixture
def pair(spark):
    accel = sensor(spark, [(1, "A", 98, 1.0, 1.0, 1.0), (1, "A", 151, 2.0, 2.0, 2.0), (2, "A", 100, 3.0, 3.0, 3.0), (None, "A", 100, 0.0, 0.0, 0.0)])
    gyro = sensor(spark, [(1, "B", 110, 5.0, 5.0, 5.0), (1, "B", 121, 4.0, 4.0, 4.0), (1, "B", 300, 6.0, 6.0, 6.0), (None, "B", 100, 0.0, 0.0, 0.0)])
    return align_time(accel), align_time(gyro)


def test_fusion_multiplies_repeated_keys(spark, pair):
    fused = fuse_sensors(*pair, ("wa", "wg"))
    assert fused.columns == ["subject_id", "timestamp", "activity_label", "wa_x", "wa_y", "wa_z", "wg_x", "wg_y", "wg_z"]
    assert [(r[0], r[1], r[2], r[3], r[6]) for r in rows(fused)] == [(1, 100, "A", 1.0, 4.0), (1, 100, "A", 1.0, 5.0)]


def test_fusion_can_keep_the_first(spark, pair):
    fused = fuse_sensors(*pair, ("wa", "wg"), dedupe="first")
    assert [(r[1], r[6]) for r in rows(fused)] == [(100, 4.0)]
    with pytest.raises(ValueError):
        fuse_sensors(*pair, ("wa", "wg"), dedupe="last")


def test_fusion_strategy_is_a_join_hint(spark, pair):
    plan = fuse_sensors(*pair, ("wa", "wg"), strategy="merge")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan


def test_rename_axes(spark, pair):
    assert rename_axes(pair[0], "pa").columns == ["subject_id", "activity_label", "timestamp", "pa_x", "pa_y", "pa_z"]
