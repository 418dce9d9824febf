import pytest
from pyspark.sql import functions as F

from strideframe import sources
from strideframe.operators import clean_readings, mark_malformed, rejected_readings, settle_malformed, split_malformed
from strideframe.operators.cleaning import MARKS

LINES = [
    "1600,A,1000000040,0.50,1.25,-2.00;",
    "1600,A,1000000060,0.75,1.00,-2.50 ;",
    "1600,A,xx,0.75,1.00,-2.50;",
    "1600,A,1000000110,0.75",
    "1600,A,1000000160,0.75,1.00,abc;",
    "1600,A,1000000210,0.75,1.00,;",
    "1600,,1000000260,0.75,1.00,1.00;",
]


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "watch" / "accel"
    folder.mkdir(parents=True)
    (folder / "data_1600_accel_watch.txt").write_text("\n".join(LINES) + "\n")
    other = tmp_path / "phone" / "gyro"
    other.mkdir(parents=True)
    (other / "data_1601_gyro_phone.txt").write_text("1601,B,5,1.0,2.0,3.0;\n")
    return str(tmp_path)


def test_scan_and_clean(spark, raw):
    df = sources.read_stream(spark, raw, "watch", "accel")
    assert df.count() == 7
    clean, rejects = clean_readings(df)
    got = {(r.timestamp, r.y, r.z) for r in clean.collect()}
    assert got == {
        (1000000040, 1.25, -2.0),
        (1000000060, 1.0, -2.5),
        (None, 1.0, -2.5),
        (1000000110, None, None),
    }
    assert clean.schema["z"].dataType.simpleString() == "float"
    assert {r.timestamp for r in rejects.collect()} == {1000000160, 1000000210, 1000000260}
    reasons = {r.timestamp: r.reason for r in rejected_readings(df).collect()}
    assert reasons == {1000000160: "bad number", 1000000210: "bad number", 1000000260: "no label"}


def test_streams_take_their_names_from_the_path(spark, raw):
    got = sources.read_streams(spark, raw).groupBy("device", "sensor", "file_subject").count().collect()
    assert {tuple(r) for r in got} == {("watch", "accel", 1600, 7), ("phone", "gyro", 1601, 1)}


def test_text_round_trip(spark, raw, tmp_path):
    clean, _ = clean_readings(sources.read_stream(spark, raw, "watch", "accel"))
    path = str(tmp_path / "again")
    sources.write_readings(clean, path)
    again, rejects = clean_readings(sources.read_readings(spark, path))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, clean.collect()))
    assert rejects.count() == 0


def test_read_or_compute_skips_a_finished_table(spark, tmp_path):
    path = str(tmp_path / "t")
    calls = []

    def compute(n):
        calls.append(n)
        return spark.range(n)

    assert sources.read_or_compute(spark, path, lambda: compute(3)).count() == 3
    assert sources.read_or_compute(spark, path, lambda: compute(5)).count() == 3
    assert sources.read_or_compute(spark, path, lambda: compute(7), skip_existing=False).count() == 7
    assert calls == [3, 7]


def test_partitioned_table_prunes(spark, tmp_path):
    path = str(tmp_path / "p")
    sources.write_table(spark.range(10).withColumn("k", F.col("id") % 2), path, ["k"])
    df = sources.read_table(spark, path).where("k = 1")
    assert df.count() == 5
    assert len(df.inputFiles()) > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan


def test_intermediate_tables_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert sources.shared_dir(spark) == shared
    files = sources.materialize(spark.range(5)).inputFiles()
    assert files and all(shared in f for f in files)


def test_preview(spark):
    assert sources.preview(spark.range(10), 3).count() == 3


def test_every_broken_line_is_one_reject(spark, tmp_path):
    lines = {
        "1600,A,10,0.5,1.5,2.0;": None,
        "S1,A,10,0.5,1.5,2.0;": ("subject_id", "not a number"),
        ",A,10,0.5,1.5,2.0;": ("subject_id", "missing"),
        "1600,,10,0.5,1.5,2.0;": ("activity_label", "missing"),
        "1600,A,1o,0.5,1.5,2.0;": ("timestamp", "not a number"),
        "1600,A,10,half,1.5,2.0;": ("x", "not a number"),
        "1600,A,10,0.5,1,5,2.0;": ("line", "too many cells"),
        "1600,A,10,0.5,-,2.0;": ("y", "not a number"),
        "1600,A,10,0.5,1.5,two;": ("z", "not a number"),
        "x,,t,?,?,?;": ("subject_id,activity_label,timestamp,x,y,z", "not a number,missing" + ",not a number" * 4),
        "1600,A,10": None,
        "1600,A,10,,,": None,
        "1600,A,10,0.5, 1.5 ,2.0": None,
    }
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n\n   \n")
    clean, rejects = split_malformed(sources.read_marked(spark, str(tmp_path)))
    got = {r.line: (r.broken, r.reasons) for r in rejects.collect()}
    assert got == {k: v for k, v in lines.items() if v}
    assert clean.columns == ["subject_id", "activity_label", "timestamp", "x", "y", "z"]
    assert sorted(((r.x, r.y, r.z) for r in clean.collect()), key=repr) == [(0.5, 1.5, 2.0), (0.5, 1.5, 2.0), (None, None, None), (None, None, None)]
    assert [clean.select("subject_id").count() + rejects.select("broken").count(), clean.schema["z"].dataType.simpleString()] == [len(lines), "float"]


def test_lines_without_a_mark_are_not_searched(spark, tmp_path):
    """Marks are made in one step, and only where a cell is missing or does not parse."""
    lines = ["1,A,5,1,2,3.0;", "1,A,5,1,2,err;", "x,A,5,1,2,3;", "2,,5,1,2,3;", "2, ,5,1,2,3;", "1,A,5,1,2,3,4", "1,A,5,1,2", "1,A,5,1,2,;", ",A,,1,,", "1,A,5,a,b,c"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / "lines"))
    marked = mark_malformed(sources.read_marked(spark, str(tmp_path / "lines")))
    got = {r.line: [tuple(m) for m in r[MARKS]] for r in marked.collect()}
    bad, gone = "not a number", "missing"
    assert got == dict(zip(lines, [
        [], [("z", bad)], [("subject_id", bad)], [("activity_label", gone)], [("activity_label", gone)], [("line", "too many cells")],
        [], [("z", bad)], [("subject_id", gone), ("timestamp", gone)], [("x", bad), ("y", bad), ("z", bad)],
    ], strict=True))
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 2 and "CASE WHEN ((((isnotnull(corrupt_line" in plan, plan


def test_settled_lines_keep_the_text_of_rejects_only(spark, tmp_path):
    lines = ["1,A,5,1,2,3.0;", "1,A,5,1,2,err;", "x,A,5,1,2,3;", "2,,5,1,2,3;", "1,A,5,1,2,3,4", "1,A,5,1,2", "1,A,5,1,2,;", "1,A,5,1e-3,2,0.1;"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / "lines"))
    marked = mark_malformed(sources.read_marked(spark, str(tmp_path / "lines")))
    settled = sources.materialize(settle_malformed(marked), "settled")
    assert settled.columns == ["line", "subject_id", "activity_label", "timestamp", "x", "y", "z", MARKS]
    told = [r.line for r in settled.collect()]
    assert sorted(t for t in told if t) == sorted([*lines[1:5], lines[6]]) and told.count(None) == 3
    for a, b in zip(split_malformed(settled), split_malformed(marked), strict=True):
        assert a.dtypes == b.dtypes and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
