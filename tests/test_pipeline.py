import math
import os
import shutil
import time
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strideframe import operators as ops
from strideframe.plans import PipelineConfig, explore_fused, run_pipeline, run_sequence
from strideframe.plans import activity
from strideframe.plans.activity import Run, fused_device
from strideframe.schemas import STREAMS, activity_dimension
from strideframe.sources import materialize, shuffles_removed, table_exists

SUBJECTS = range(1600, 1610)
CODES = "ABD"
READINGS = 130


def line(subject, code, device, sensor, i):
    """Each activity swings at its own pace; watch and phone see it differently."""
    pace = 0.1 + 0.2 * CODES.index(code) + (0.05 if device == "phone" else 0.0)
    start = 10_000 if sensor == "accel" else 10_010
    ts = start + i * 50_000_000 + (subject % 7)
    phase = i * pace + subject
    x, y, z = math.sin(phase), math.cos(phase) * 2, CODES.index(code) + math.sin(i) / 10
    return f"{subject},{code},{ts + 10**12 * CODES.index(code)},{x:.5f},{y:.5f},{z:.5f};"


@pytest.fixture(scope="module")
def cfg(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for device, sensor in STREAMS:
        folder = root / device / sensor
        folder.mkdir(parents=True)
        for s in SUBJECTS:
            lines = [line(s, c, device, sensor, i) for c in CODES for i in range(READINGS)]
            if (device, sensor, s) == ("watch", "accel", 1600):
                lines += [f"{s},A,5,1.0,1.0,broken;", f"{s},A,noon,1.0,1.0,1.0;", f",A,5,1.0,1.0,1.0;"]
            (folder / f"data_{s}_{sensor}_{device}.txt").write_text("\n".join(lines) + "\n")
    return PipelineConfig(
        raw=str(root),
        work=str(tmp_path_factory.mktemp("work")),
        size=40,
        step=20,
        trees=10,
        counts=(6, 2, 2),
        subjects=SUBJECTS,
        candidates=(ops.SequenceCandidate(10, (16,), 40),),
    )


@pytest.fixture(scope="module")
def tables(spark, cfg):
    return run_pipeline(spark, cfg, eda=True)


def test_feature_tables(tables):
    for device in ("watch", "phone"):
        f = tables[f"{device}_features"]
        assert len(f.columns) == 32
        assert f.count() == len(SUBJECTS) * len(CODES) * READINGS
    found = {(r.device, r.sensor, r.broken, r.reasons) for r in tables["rejects"].collect()}
    assert found == {("watch", "accel", c, why) for c, why in (("z", "not a number"), ("timestamp", "not a number"), ("subject_id", "missing"))}


def test_manifest_tells_what_was_written(tables):
    rows = {r.table: r for r in tables["manifest"].collect()}
    assert [r.place for r in sorted(rows.values(), key=lambda r: r.place)] == list(range(len(rows)))
    assert set(rows) == set(tables) - {"manifest"}
    for name in ("watch_features", "phone_windows", "rejects", "predictions", "split", "watch_boxes"):
        assert rows[name].rows == tables[name].count() and rows[name].seconds > 0
    assert (rows["rejects"].step, rows["watch_boxes"].step) == ("features", "reports")


def test_window_tables(tables):
    w = tables["watch_windows"]
    assert len(w.columns) == 59
    per_series = (READINGS - 40) // 20 + 1
    assert w.count() == len(SUBJECTS) * len(CODES) * per_series


def test_scores(tables):
    assert {r.split: r["count"] for r in tables["split"].groupBy("split").count().collect()} == {"train": 6, "val": 2, "test": 2}
    assert tables["stacked_accuracy"].first()["accuracy"] > 0.8
    assert {r.activity for r in tables["stacked_accuracy_by_activity"].collect()} == set(CODES)
    assert "Walking" in {r.activity_name for r in tables["watch_accuracy_by_activity"].collect()}
    assert tables["phone_importance"].count() == 56
    for name in ("watch_accuracy", "phone_accuracy", "stacked_accuracy"):
        r = tables[name].first()
        assert 0 <= r.accuracy <= 1 and r.accuracy == pytest.approx(r.evaluator_accuracy)


def test_exploration(tables):
    assert tables["watch_overview"].first()["features"] == 28
    assert tables["phone_correlation"].count() == 100
    assert tables["watch_boxes"].count() == len(CODES) * 7
    assert tables["watch_describe"].count() == 6
    assert tables["phone_subject_counts"].count() == len(SUBJECTS)


def same_rows(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_run_leaves_no_tables_but_its_own(spark, cfg, tables, tmp_path, monkeypatch):
    """Lines, joins and cuts are removed as soon as they are used up, and series taken a part at a
    time give the same tables."""
    monkeypatch.setattr(activity, "SLICE_ROWS", 900)
    raw = tmp_path / "raw"
    shutil.copytree(cfg.raw, raw)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(os.listdir(shared))
    own = run_pipeline(spark, replace(cfg, raw=str(raw), work=str(tmp_path / "work"), drop_raw=True), eda=True)
    assert set(os.listdir(shared)) == before
    assert not list(raw.rglob("*.txt")) and list(Path(cfg.raw).rglob("*.txt"))
    assert set(own) == set(tables)
    for name in ("watch_features", "phone_features", "watch_windows", "phone_windows", "rejects", "split", "watch_boxes"):
        assert same_rows(own[name], tables[name]), name


def test_features_can_be_skipped(spark, cfg, tables):
    before = tables["watch_features"].inputFiles()
    accuracy = tables["stacked_accuracy"].first()
    again = run_pipeline(spark, cfg, skip_features=True)
    assert again["watch_features"].inputFiles() == before
    assert {r.table for r in again["manifest"].where("rows IS NULL").collect()} == {"watch_features", "phone_features"}
    assert again["stacked_accuracy"].first() == accuracy


def test_a_table_with_parts_to_come_is_not_finished(spark, cfg, tmp_path, monkeypatch):
    monkeypatch.setattr(activity, "SLICE_ROWS", 10)
    run = Run(spark, replace(cfg, work=str(tmp_path / "a folder")))
    keys = [F.col("id").cast("int").alias("subject_id"), F.lit("A").alias("activity_label")]
    rows = materialize(spark.range(40).select(*keys), "rows")
    done = []

    def make(part, fail=True):
        if fail and done:
            assert not table_exists(spark, str(tmp_path / "a folder" / "half"))
            raise RuntimeError("second part")
        done.append(part.count())
        return part

    with pytest.raises(RuntimeError, match="second part"):
        run.put_by_series("step", "half", activity.slices(rows), make)
    assert not table_exists(spark, str(tmp_path / "a folder" / "half"))
    done.clear()
    whole = run.put_by_series("step", "half", activity.slices(rows), lambda part: make(part, fail=False))
    assert table_exists(spark, str(tmp_path / "a folder" / "half")) and same_rows(whole, rows)
    assert len(done) == 4 and max(done) < sum(done) == 40
    assert run.manifest[-1][1:3] == ("half", 40)
    # the next step reads each part from its own files
    parts = run.parts("half")
    assert [p.count() for p in parts] == done and sum(len(p.inputFiles()) for p in parts) == len(whole.inputFiles())


def test_shuffles_go_with_their_query(spark, tmp_path):
    def files():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {name for d in blocks.localDirs() for _, _, names in os.walk(d.getPath()) for name in names if name.startswith("shuffle_")}

    def left(path):
        before = files()
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / path))
        end = time.monotonic() + 10
        while files() - before and time.monotonic() < end:
            time.sleep(0.1)
        return files() - before

    with shuffles_removed(spark):
        assert not left("removed")
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_exploring_fused_sensors(spark, cfg):
    found = explore_fused(fused_device(spark, cfg, "phone"))
    assert found["correlation"].count() == 36
    assert found["boxes"].count() == len(CODES) * 6
    assert [r.rows for r in found["activity_counts"].collect()] == [len(SUBJECTS) * READINGS] * len(CODES)


def test_sequence_pipeline(spark, cfg):
    out = run_sequence(spark, cfg)
    r = out["channels"].first()
    assert len(r.channels) == 12 and len(r.channels[0]) == 40
    assert out["accuracy"].first()["accuracy"] > 0.6
    report = {r["class"] for r in out["report"].collect()}
    assert set(CODES) <= report and "weighted avg" in report
    assert out["confusion"].groupBy().sum("rows").first()[0] == out["predictions"].count()
    assert out["confusion_pct"].count() == out["confusion"].count()


def test_activity_dimension(spark):
    dim = {r.activity_label: (r.activity_name, r.class_index) for r in activity_dimension(spark).collect()}
    assert len(dim) == 18 and "N" not in dim
    assert dim["A"] == ("Walking", 0) and dim["O"] == ("Catch", 13) and dim["S"] == ("Folding", 17)
