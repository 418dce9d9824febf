"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe import operators as ops
from strideframe import sources
from strideframe.functions import decode, rounded
from strideframe.operators.summaries import SKETCH_LG_K
from strideframe.plans import PipelineConfig, run_pipeline, run_sequence
from strideframe.schemas import READING_SCHEMA, SERIES_KEYS
from strideframe.sources import materialize, read_marked, read_or_compute, read_readings, write_readings
from strideframe.sources.storage import new_table_path
from workload import adapters as a

TIES = ("l_orderkey", "l_linenumber", "l_partkey")
AXES = a.LINEITEM_AXES


def _features(spark: SparkSession, sf_dir: str, hot="auto") -> DataFrame:
    return ops.engineer_features(
        a.lineitem_readings(spark, sf_dir).select(*SERIES_KEYS, "timestamp", *AXES, *TIES),
        [AXES],
        order_by=a.LINEITEM_ORDER,
        ticks_per_second=a.TICKS_PER_SECOND,
        hot=hot,
    )


def _feature_report(df: DataFrame) -> DataFrame:
    derived = ["x_dx", "y_dy", "z_dz", "x_magnitude", "x_y", "x_z", "y_z"]
    rates = ["x_ax", "y_ay", "z_az"]
    return df.select(
        *SERIES_KEYS,
        "timestamp",
        *TIES,
        "seq_id",
        *[rounded(c).alias(c) for c in derived],
        *[(F.col(c) + F.lit(0.0)).alias(c) for c in rates],
        rounded("x_jerk", 12).alias("x_jerk"),
    )


def _small_hot(df: DataFrame) -> ops.HotGroups | None:
    """Treat series above 200 rows as hot, so that the way for hot series is taken."""
    return ops.hot_groups(df, SERIES_KEYS, max_rows=200, part_rows=10_000)


def motion_features(spark, sf_dir):
    return _feature_report(_features(spark, sf_dir))


def motion_features_hot(spark, sf_dir):
    return _feature_report(_features(spark, sf_dir, hot=_small_hot(a.lineitem_readings(spark, sf_dir))))


def series_positions(spark, sf_dir):
    readings = a.lineitem_readings(spark, sf_dir).select(*SERIES_KEYS, "timestamp", "x", *TIES)
    return ops.number_rows(
        readings, SERIES_KEYS, a.LINEITEM_ORDER, lags=["timestamp"], length="series_rows"
    ).select(
        *SERIES_KEYS,
        *TIES,
        "pos",
        F.coalesce("prev_timestamp", F.lit(-1).cast("long")).alias("prev_timestamp"),
        "series_rows",
    )


def first_n_per_series(spark, sf_dir):
    return ops.first_n(
        a.lineitem_readings(spark, sf_dir), SERIES_KEYS, a.LINEITEM_ORDER, 150, position="pos"
    ).select(*SERIES_KEYS, *TIES, "pos", "x")


def first_n_per_series_hot(spark, sf_dir):
    readings = a.lineitem_readings(spark, sf_dir)
    return ops.first_n(
        readings, SERIES_KEYS, a.LINEITEM_ORDER, 150, position="pos", hot=_small_hot(readings)
    ).select(*SERIES_KEYS, *TIES, "pos", "x")


def window_assignment(spark, sf_dir):
    return ops.assign_windows(
        a.lineitem_readings(spark, sf_dir), order_by=a.LINEITEM_ORDER, size=50, step=25
    ).select(*SERIES_KEYS, *TIES, F.col("window_index").cast("long").alias("window_index"), "pos")


def _window_report(df: DataFrame, cols) -> DataFrame:
    # Means of 50 such values often lie exactly between two roundings, where
    # engines differ; a small shift moves them off.
    return df.select(
        *SERIES_KEYS,
        F.col("window_index").cast("long").alias("window_index"),
        *[
            rounded(F.col(f"{c}_{s}") + F.lit(3.14159265e-6), 4).alias(f"{c}_{s}")
            for c in cols
            for s in ("mean", "std")
        ],
    )


def _windows(spark, sf_dir, size, step, method="pane", hot="auto"):
    return _window_report(
        ops.summarize_windows(
            a.lineitem_readings(spark, sf_dir),
            AXES,
            order_by=a.LINEITEM_ORDER,
            size=size,
            step=step,
            method=method,
            out_type="double",
            hot=hot,
        ),
        AXES,
    )


def window_summary(spark, sf_dir):
    return _windows(spark, sf_dir, 50, 25)


def window_summary_default(spark, sf_dir):
    return _windows(spark, sf_dir, 200, 100)


def window_summary_panes(spark, sf_dir):
    return _windows(spark, sf_dir, 50, 25, method="pane")


def window_summary_dense(spark, sf_dir):
    return _windows(spark, sf_dir, 50, 5)


def window_summary_uneven(spark, sf_dir):
    return _windows(spark, sf_dir, 50, 20)


def window_summary_coprime(spark, sf_dir):
    """Size and step without a common divisor: panes of one row."""
    return _windows(spark, sf_dir, 50, 7)


def window_summary_gaps(spark, sf_dir):
    return _windows(spark, sf_dir, 20, 30)


def window_summary_hot(spark, sf_dir):
    return _windows(spark, sf_dir, 50, 25, hot=_small_hot(a.lineitem_readings(spark, sf_dir)))


def feature_window_summary(spark, sf_dir):
    """Windows over the engineered features, the input of the classifiers."""
    cols = ["x_dx", "y_dy", "z_dz", "x_magnitude", "x_y", "x_z", "y_z", "x_ax", "y_ay", "z_az", "x_jerk"]
    return _window_report(
        ops.summarize_windows(
            _features(spark, sf_dir), cols, order_by=a.LINEITEM_ORDER, size=50, step=25, out_type="double"
        ),
        cols,
    )


def raw_windows(spark, sf_dir):
    """Windows over all readings of each series."""
    return _raw_windows(spark, sf_dir)


def raw_windows_first_n(spark, sf_dir):
    """Windows over the first 180 readings of each series."""
    return _raw_windows(spark, sf_dir, max_rows=180)


def _raw_windows(spark, sf_dir, **how):
    windows = ops.collect_windows(
        a.lineitem_readings(spark, sf_dir), AXES, order_by=a.LINEITEM_ORDER, size=50, step=25, **how
    )
    return windows.select(
        *SERIES_KEYS,
        F.col("window_index").cast("long").alias("window_index"),
        F.posexplode("features").alias("place", "row"),
    ).select(
        *SERIES_KEYS,
        "window_index",
        F.col("place").cast("long").alias("place"),
        *[F.col("row")[i].cast("double").alias(c) for i, c in enumerate(AXES)],
    )


def channel_tensor(spark, sf_dir):
    channels = [(s, c) for s in ("O", "F") for c in ("x", "y", "z", "t", "x", "z")]
    stacked = ops.channel_windows(
        a.lineitem_readings(spark, sf_dir), "side", channels, order_by=a.LINEITEM_ORDER, size=80, step=40, class_index={"A": 0, "N": 1, "R": 2}
    )
    return stacked.select(
        *SERIES_KEYS,
        F.col("window_index").cast("long").alias("window_index"),
        F.col("label").cast("long").alias("label"),
        F.posexplode("channels").alias("channel", "values"),
    ).select(
        *SERIES_KEYS,
        "window_index",
        "label",
        F.col("channel").cast("long").alias("channel"),
        F.posexplode("values").alias("place", "value"),
    ).select(
        *SERIES_KEYS,
        "window_index",
        "label",
        "channel",
        F.col("place").cast("long").alias("place"),
        F.col("value").cast("double").alias("value"),
    )


def clean_readings(spark, sf_dir):
    clean, _ = ops.clean_readings(a.dirty_events(spark, sf_dir))
    return clean.select("event_id", "activity_label", F.col("z").cast("double").alias("z"))


def rejected_readings(spark, sf_dir):
    return ops.rejected_readings(a.dirty_events(spark, sf_dir)).select("event_id", "activity_label", "reason")


def _broken(spark, sf_dir) -> DataFrame:
    path = new_table_path(spark, "broken-text")
    a.broken_lines(spark, sf_dir).write.text(path)
    return read_marked(spark, path)


def _marked(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return ops.split_malformed(_broken(spark, sf_dir))


def malformed_lines(spark, sf_dir):
    """Every broken line of written text, with the columns that broke."""
    return _marked(spark, sf_dir)[1]


def malformed_clean(spark, sf_dir):
    """The other lines of the same text, parsed."""
    clean, _ = _marked(spark, sf_dir)
    return clean.select(
        F.col("subject_id").cast("long").alias("subject_id"), "activity_label", "timestamp", *[F.col(c).cast("double").alias(c) for c in ("x", "y", "z")]
    )


def malformed_counts(spark, sf_dir):
    """Lines by the columns that broke; with the clean ones they are all lines."""
    # written, as both kinds of lines are read from it
    clean, rejects = ops.split_malformed(materialize(ops.mark_malformed(_broken(spark, sf_dir)), "marked-lines"))
    return rejects.select("broken").unionByName(clean.select(F.lit("none").alias("broken"))).groupBy("broken").agg(F.count(F.lit(1)).alias("lines"))


def aligned_time(spark, sf_dir):
    return ops.align_time(a.event_readings(spark, sf_dir), grid=50).select("event_id", "timestamp")


def scan_readings(spark, sf_dir):
    """The text round trip: readings written with terminators, scanned and cleaned."""
    readings = a.lineitem_readings(spark, sf_dir).select(
        F.col("subject_id").cast("int").alias("subject_id"),
        "activity_label",
        "timestamp",
        *[F.col(c) for c in AXES],
    )
    path = new_table_path(spark, "readings-text")
    write_readings(readings, path)
    clean, _ = ops.clean_readings(read_readings(spark, path))
    return clean.select(
        F.col("subject_id").cast("long").alias("subject_id"),
        "activity_label",
        "timestamp",
        *[F.col(c).cast("double").alias(c) for c in READING_SCHEMA.names[3:]],
    )


def feature_table(spark, sf_dir):
    """Features written as Parquet by activity, one activity read back."""
    path = new_table_path(spark, "features")
    stored = read_or_compute(
        spark, path, lambda: _features(spark, sf_dir), partition_by=["activity_label"]
    )
    return stored.where("activity_label = 'R'").select(
        "subject_id", "activity_label", *TIES, rounded("x_magnitude").alias("x_magnitude")
    )


def _fused(spark, sf_dir, **how):
    first, second = (ops.align_time(d, a.SIX_HOURS) for d in a.sensor_pair(spark, sf_dir))
    return ops.fuse_sensors(first, second, ("wa", "wg"), **how)


def fuse_sensors(spark, sf_dir):
    return _fused(spark, sf_dir)


def fuse_sensors_merge(spark, sf_dir):
    return _fused(spark, sf_dir, strategy="merge")


def fuse_sensors_first(spark, sf_dir):
    return _fused(spark, sf_dir, dedupe="first")


def fuse_sensors_untimed(spark, sf_dir):
    return _fused(spark, sf_dir).drop("timestamp")


def fused_features(spark, sf_dir):
    """Two sensors fused, features of both."""
    wide = ops.engineer_features(
        materialize(_fused(spark, sf_dir), "fused"),
        [("wa_x", "wa_y", "wa_z"), ("wg_x", "wg_y", "wg_z")],
        order_by=("timestamp", "wa_z", "wg_z"),
        ticks_per_second=a.TICKS_PER_SECOND,
    )
    return wide.select("subject_id", "timestamp", "seq_id", *[rounded(c).alias(c) for c in wide.columns[wide.columns.index("seq_id") + 1 :]])


def overview(spark, sf_dir):
    return ops.overview(a.lineitem_readings(spark, sf_dir).select(*SERIES_KEYS, "timestamp", *AXES))


def activity_counts(spark, sf_dir):
    return ops.activity_counts(a.event_readings(spark, sf_dir), names=a.EVENT_NAMES)


def subject_counts(spark, sf_dir):
    return ops.subject_counts(a.lineitem_readings(spark, sf_dir)).select(
        "subject_id", "rows", rounded("mean_rows").alias("mean_rows")
    )


def category_names(spark, sf_dir):
    return ops.category_names(a.event_readings(spark, sf_dir), names=a.EVENT_NAMES)


def dictionary_lookup(spark, sf_dir):
    names = a.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return ops.with_activity_name(
        ops.counts_by(a.lineitem_readings(spark, sf_dir), "subject_id"), "subject_id", names, "subject_name"
    )


def describe_axes(spark, sf_dir):
    d = ops.describe_long(a.lineitem_readings(spark, sf_dir), AXES)
    return d.select("column", "count", *[rounded(c, 5).alias(c) for c in ("mean", "stddev", "min", "max")])


def correlation_matrix(spark, sf_dir):
    cols = ["x", "y", "z", "x_magnitude", "x_jerk"]
    return ops.corr_matrix(_features(spark, sf_dir), cols).select("col_a", "col_b", rounded("corr").alias("corr"))


def correlation_fused(spark, sf_dir):
    fused = _fused(spark, sf_dir).drop("subject_id", "activity_label", "timestamp")
    return ops.corr_matrix(fused, fused.columns).select("col_a", "col_b", rounded("corr").alias("corr"))


def _box_report(boxes: DataFrame) -> DataFrame:
    return boxes.select(
        "activity_label",
        "column",
        "count",
        *[rounded(c).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
        "outliers",
    )


def box_summary(spark, sf_dir):
    return _box_report(ops.box_summary(a.lineitem_readings(spark, sf_dir), AXES))


def box_summary_magnitude(spark, sf_dir):
    return _box_report(ops.box_summary(_features(spark, sf_dir), ["x_magnitude"]))


def hash_sample(spark, sf_dir):
    return ops.hash_sample(a.event_readings(spark, sf_dir), "event_id", 0.1).select("event_id", "subject_id", "x")


def bernoulli_sample(spark, sf_dir):
    return ops.bernoulli_sample(a.event_readings(spark, sf_dir), 0.05)


def shuffled_readings(spark, sf_dir):
    return ops.shuffled(a.event_readings(spark, sf_dir), key=["event_id"]).select("event_id", "subject_id", "x")


def _split(spark, sf_dir, **how) -> DataFrame:
    return materialize(ops.subject_split(a.lineitem_readings(spark, sf_dir), **how), "split")


def subject_split(spark, sf_dir):
    return ops.subject_split(a.lineitem_readings(spark, sf_dir))


def fixed_split(spark, sf_dir):
    return ops.subject_split(a.lineitem_readings(spark, sf_dir), counts=(40, 6, 5))


def split_rows(spark, sf_dir):
    readings = a.lineitem_readings(spark, sf_dir)
    return ops.split_rows(readings, _split(spark, sf_dir), "val").select("subject_id", *TIES, "x")


def split_sizes(spark, sf_dir):
    return ops.split_sizes(_split(spark, sf_dir))


def accuracy_overall(spark, sf_dir):
    return ops.accuracy(a.scored_vectors(spark, sf_dir)).select(rounded("accuracy").alias("accuracy"), "rows")


def accuracy_by_class(spark, sf_dir):
    return ops.accuracy_by(a.scored_vectors(spark, sf_dir)).select(
        "activity_label", rounded("accuracy").alias("accuracy"), "windows"
    )


def _confusion(spark, sf_dir):
    return ops.confusion_matrix(a.scored_vectors(spark, sf_dir))


def confusion_matrix(spark, sf_dir):
    return _confusion(spark, sf_dir)


def confusion_matrix_all_classes(spark, sf_dir):
    return ops.confusion_matrix(a.scored_vectors(spark, sf_dir), classes=range(12))


def confusion_pct(spark, sf_dir):
    all_classes = ops.confusion_matrix(a.scored_vectors(spark, sf_dir), classes=range(12))
    return ops.confusion_pct(all_classes).select("label", "prediction", rounded("pct").alias("pct"))


def classification_report(spark, sf_dir):
    report = ops.classification_report(_confusion(spark, sf_dir))
    return report.select(
        "class", *[rounded(c).alias(c) for c in ("precision", "recall", "f1_score")], "support"
    )


def label_index(spark, sf_dir):
    return ops.label_index_table(a.event_readings(spark, sf_dir))


def indexed_rows(spark, sf_dir):
    """The fitted index applied to every row."""
    events = a.event_readings(spark, sf_dir)
    return ops.fit_label_index(events).transform(events).select("event_id", "label")


def decoded_labels(spark, sf_dir):
    """Class index back to a name; an index outside the map gives null."""
    scored = a.scored_vectors(spark, sf_dir)
    names = {i: f"name {i}" for i in range(8)}
    return scored.select("vec_id", decode("prediction", names).alias("predicted_name"))


def standardized_axes(spark, sf_dir):
    readings = a.lineitem_readings(spark, sf_dir)
    scaled = Pipeline(stages=ops.vector_stages(AXES, "watch")).fit(readings).transform(readings)
    values = vector_to_array("watch_scaled")
    return scaled.select(*TIES, *[rounded(values[i]).alias(c) for i, c in enumerate(AXES)])


def _stacked(spark, sf_dir, trees=100):
    # written tables: training reads them many times, and their plans start plain
    watch, phone = (materialize(d, "device") for d in a.device_vectors(spark, sf_dir))
    split = materialize(ops.subject_split(watch), "split")
    model = ops.stack_fit(watch, phone, split, trees=trees)
    test = [ops.split_rows(d, split, "test") for d in (watch, phone)]
    return model, model.transform(*test), watch


def stacked_predictions(spark, sf_dir):
    _, scored, _ = _stacked(spark, sf_dir)
    return scored.select("subject_id", "activity_label", "window_index", "label", "prediction", "predicted_activity")


def stacked_accuracy_by_activity(spark, sf_dir):
    _, scored, _ = _stacked(spark, sf_dir)
    return ops.accuracy_by(scored, "activity")


def feature_importance(spark, sf_dir):
    model, _, watch = _stacked(spark, sf_dir)
    return ops.feature_importance(model.watch, watch.columns[3:], k=15)


def sequence_predictions(spark, sf_dir):
    data = a.vector_channels(spark, sf_dir)
    split = materialize(ops.subject_split(data), "split")
    parts = {name: ops.split_rows(data, split, name) for name in ("train", "val", "test")}
    candidates = [ops.SequenceCandidate(40, (32,), 60), ops.SequenceCandidate(20, (16,), 60)]
    best = ops.sequence_fit(parts["train"], parts["val"], 4, candidates)
    return best.transform(parts["test"]).select("vec_id", "label", "prediction")


def labelled_rows(spark, sf_dir):
    """Every event with its class index, joined from the index's own table."""
    events = a.event_readings(spark, sf_dir).select("event_id", "activity_label")
    return ops.with_label_index(events, ops.label_index_table(events)).select("event_id", "label")


def accuracy_cross_check(spark, sf_dir):
    checked = ops.accuracy_cross_check(a.scored_vectors(spark, sf_dir))
    return checked.select(rounded("accuracy").alias("accuracy"), rounded("evaluator_accuracy").alias("evaluator_accuracy"), "rows")


def tree_split(spark, sf_dir):
    """Dear lines by their quantity: what a tree of one split says for each quantity, by
    itself and as a forest of one."""
    lines = a.table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").cast("int").alias("quantity"), (F.col("l_extendedprice") > 25_000).cast("double").alias("label")
    )
    lines = materialize(lines.where("quantity IS NOT NULL AND label IS NOT NULL"), "tree-rows")
    tree, forest = (ops.split_tree(lines, ["quantity"], bins=64, forest=f) for f in (False, True))
    judged = tree.transform(lines).select("split_features", "quantity", F.col("prediction").alias("tree_prediction"))
    judged = forest.stages[-1].transform(judged).select("quantity", "tree_prediction", F.col("prediction").alias("forest_prediction"))
    return judged.groupBy("quantity", "tree_prediction", "forest_prediction").agg(F.count(F.lit(1)).alias("rows"))


def model_reload(spark, sf_dir):
    """Test windows scored by the stacked model and by the same model saved and loaded again:
    how many, and how many of them have equal predictions and probabilities."""
    model, scored, watch = _stacked(spark, sf_dir, trees=10)
    path = new_table_path(spark, "stacked-model")
    model.save(path)
    loaded = ops.StackedModel.load(path)
    split = materialize(ops.subject_split(watch), "split")
    test = [ops.split_rows(materialize(d, "device"), split, "test") for d in a.device_vectors(spark, sf_dir)]
    keys = list(model.on)
    columns = ["prediction", "probability", "predicted_activity"]
    both = scored.select(*keys, F.struct(*columns).alias("one")).join(loaded.transform(*test).select(*keys, F.struct(*columns).alias("two")), keys, "full")
    return _agreement(both)


def _agreement(both: DataFrame) -> DataFrame:
    same = F.coalesce(F.to_json("one") == F.to_json("two"), F.lit(False))
    return both.agg(F.count(F.lit(1)).alias("windows"), F.sum(same.cast("long")).alias("equal"))


def sequence_reload(spark, sf_dir):
    """The same for the sequence model, with the candidates of its stored history."""
    data = materialize(a.vector_channels(spark, sf_dir), "channels")
    split = materialize(ops.subject_split(data), "split")
    parts = {name: ops.split_rows(data, split, name) for name in ("train", "val", "test")}
    path = new_table_path(spark, "sequence-model")
    candidates = [ops.SequenceCandidate(16, (8,), 15), ops.SequenceCandidate(8, (8,), 15)]
    best = ops.sequence_fit(parts["train"], parts["val"], 4, candidates, save_to=path)
    loaded = ops.SequenceModel.load(path)
    if (loaded.history, loaded.candidate, loaded.validation_accuracy) != (best.history, best.candidate, best.validation_accuracy):
        raise AssertionError("the stored history is another")
    one, two = (m.transform(parts["test"]).select("vec_id", F.struct("prediction", "probability").alias(n)) for m, n in ((best, "one"), (loaded, "two")))
    return _agreement(one.join(two, "vec_id", "full")).withColumn("candidates", F.lit(len(loaded.history)).cast("long"))


def distinct_sketches(spark, sf_dir):
    """Distinct suppliers and orders from sketches stored for each line status and united
    later, held against the union of another cut of the same rows and against exact counts."""
    readings = a.lineitem_readings(spark, sf_dir).select("side", "activity_label", "subject_id", "l_orderkey")
    cols = ["subject_id", "l_orderkey"]
    cuts = [materialize(ops.distinct_sketches(readings, cols, by=[by]), "distinct-sketches") for by in ("side", "activity_label")]
    united, whole = (ops.united_distinct(c, cols) for c in cuts)
    exact = readings.agg(*[F.count_distinct(c).alias(c) for c in cols])
    rows = [
        df.select(F.lit(i).alias("at"), F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("n")) for c in cols])))
        for i, df in enumerate((united, whole, exact))
    ]
    told = rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("column").agg(*[F.max(F.when(F.col("at") == i, F.col("n"))).alias(n) for i, n in enumerate(("united", "whole", "exact"))])
    # three standard errors of a sketch of this size
    near = F.abs(F.col("united") - F.col("exact")) <= F.greatest(F.col("exact") * (3 * 0.8 / 2 ** (SKETCH_LG_K / 2)), F.lit(1))
    return told.select("column", F.col("exact").alias("distinct_values"), (F.col("united") == F.col("whole")).alias("unions_agree"), near.alias("within_error"))


def _objects(spark, sf_dir) -> str:
    """Readings as objects of 51 subjects, each a folder of parts, some of them never written."""
    subject = (F.col("l_suppkey") % 51).cast("int")
    device = F.when(F.col("l_linestatus") == "O", "watch").otherwise("phone")
    sensor = F.when(F.col("l_linenumber") % 2 == 1, "accel").otherwise("gyro")
    cells = [subject, F.col("l_returnflag"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.lit("1.0;")]
    rows = a.table(spark, sf_dir, "lineitem").select(
        device.alias("device"),
        sensor.alias("sensor"),
        F.concat_ws("_", F.lit("data"), subject.cast("string"), sensor, F.concat(device, F.lit(".txt"))).alias("object"),
        F.concat_ws(",", *[c.cast("string") for c in cells]).alias("value"),
        (subject * 4 + F.when(device == "watch", 0).otherwise(2) + F.when(sensor == "accel", 0).otherwise(1)).alias("n"),
    )
    path = new_table_path(spark, "objects")
    rows.where("n % 11 != 5").drop("n").repartition("device", "sensor", "object").write.partitionBy("device", "sensor", "object").text(path)
    return path


def object_manifest(spark, sf_dir):
    """Every object that 51 subjects should have, and whether it is there."""
    subjects = a.lineitem_readings(spark, sf_dir).select((F.col("subject_id") % 51).alias("subject_id"))
    found = sources.object_manifest(spark, _objects(spark, sf_dir), subjects, pattern=sources.FOLDER_PATTERN)
    return found.select(F.col("file_subject").cast("long").alias("subject_id"), "device", "sensor", (F.col("files") > 0).alias("present"), "status")


def stream_keys(spark, sf_dir):
    """Readings of each object by the keys in its path, and how many name another subject."""
    rows = sources.read_streams(spark, _objects(spark, sf_dir), pattern=sources.FOLDER_PATTERN)
    wrong = F.sum((~F.col("file_subject").eqNullSafe(F.col("subject_id"))).cast("long"))
    return rows.groupBy(F.col("file_subject").cast("long").alias("subject_id"), "device", "sensor").agg(F.count(F.lit(1)).alias("rows"), wrong.alias("misplaced"))


def _run_config(spark, sf_dir, **how) -> PipelineConfig:
    root = new_table_path(spark, "raw-streams")
    a.write_raw_streams(spark, sf_dir, root)
    return PipelineConfig(raw=root, work=new_table_path(spark, "run"), ticks_per_second=1e3, **how)


def activity_run(spark, sf_dir):
    """The whole feature pipeline over raw text of all lines: rows that each step wrote, by
    its manifest."""
    tables = run_pipeline(spark, _run_config(spark, sf_dir, size=20, step=10, trees=3, drop_raw=True), eda=True)
    told = tables["manifest"].where(F.col("table").rlike("_features$|_windows$|^rejects$|^split$|_boxes$|_correlation$"))
    return told.select("table", "rows")


def sequence_run(spark, sf_dir):
    """The same for the raw-window pipeline."""
    how = {"size": 12, "step": 6, "candidates": (ops.SequenceCandidate(4, (8,), 5),)}
    tables = run_sequence(spark, _run_config(spark, sf_dir, **how))
    return tables["manifest"].where(F.col("table").rlike("_windows$|^rejects$|^split$|^channels$")).select("table", "rows")


Query = Callable[[SparkSession, str], DataFrame]

ALL: dict[str, Query] = {
    f.__name__: f
    for f in (
        motion_features,
        motion_features_hot,
        series_positions,
        first_n_per_series,
        first_n_per_series_hot,
        window_assignment,
        window_summary,
        window_summary_default,
        window_summary_panes,
        window_summary_dense,
        window_summary_uneven,
        window_summary_coprime,
        window_summary_gaps,
        window_summary_hot,
        feature_window_summary,
        raw_windows,
        raw_windows_first_n,
        channel_tensor,
        clean_readings,
        rejected_readings,
        malformed_lines,
        malformed_clean,
        malformed_counts,
        aligned_time,
        scan_readings,
        feature_table,
        fuse_sensors,
        fuse_sensors_merge,
        fuse_sensors_first,
        fuse_sensors_untimed,
        fused_features,
        overview,
        activity_counts,
        subject_counts,
        category_names,
        dictionary_lookup,
        describe_axes,
        correlation_matrix,
        correlation_fused,
        box_summary,
        box_summary_magnitude,
        hash_sample,
        bernoulli_sample,
        shuffled_readings,
        subject_split,
        fixed_split,
        split_rows,
        split_sizes,
        accuracy_overall,
        accuracy_by_class,
        confusion_matrix,
        confusion_matrix_all_classes,
        confusion_pct,
        classification_report,
        label_index,
        indexed_rows,
        decoded_labels,
        standardized_axes,
        stacked_predictions,
        stacked_accuracy_by_activity,
        feature_importance,
        sequence_predictions,
        labelled_rows,
        accuracy_cross_check,
        tree_split,
        model_reload,
        sequence_reload,
        distinct_sketches,
        object_manifest,
        stream_keys,
        activity_run,
        sequence_run,
    )
}
