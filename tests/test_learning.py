import pytest
from pyspark.sql import functions as F

from strideframe import operators as ops
from strideframe.sources import materialize
from workload import adapters as a

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    watch, phone = (materialize(d) for d in a.device_vectors(spark, SF))
    return watch, phone, materialize(ops.subject_split(watch))


@pytest.fixture(scope="module")
def model(data):
    return ops.stack_fit(*data, trees=20)


def part(data, name):
    return [ops.split_rows(d, data[2], name) for d in data[:2]]


def test_index_goes_by_frequency_then_name(spark):
    df = spark.createDataFrame([(x,) for x in "BBCCA"], "activity_label string")
    assert [(r.activity_label, r.label) for r in ops.label_index_table(df).orderBy("label").collect()] == [
        ("B", 0.0), ("C", 1.0), ("A", 2.0),
    ]
    unseen = spark.createDataFrame([("Z",)], "activity_label string")
    assert ops.fit_label_index(df).transform(unseen).first()["label"] == 3.0


def test_probabilities_have_a_place_for_unseen_labels(model, data):
    r = model.base_probabilities(*part(data, "val")).first()
    assert len(r.from_watch) == len(model.labels) + 1 == len(r.from_phone)


def test_stack_beats_its_bases_and_the_majority(model, data):
    test = part(data, "test")
    stacked = ops.accuracy(model.transform(*test)).first()["accuracy"]
    bases = [ops.accuracy(m.transform(d)).first()["accuracy"] for m, d in zip((model.watch, model.phone), test)]
    counts = [r["count"] for r in test[0].groupBy("activity_label").count().collect()]
    assert stacked > max(bases) and stacked > max(counts) / sum(counts)
    assert stacked > 0.8


def test_decoded_names_fit(model, data):
    scored = model.transform(*part(data, "test"))
    assert scored.where("activity <> activity_label").count() == 0
    assert scored.where("(prediction = label) <> (predicted_activity = activity)").count() == 0


def test_same_seed_same_predictions_and_reload(spark, model, data, tmp_path):
    def predictions(m):
        return {r.window_index: r.prediction for r in m.transform(*part(data, "test")).collect()}

    first = predictions(model)
    assert predictions(ops.stack_fit(*data, trees=20)) == first
    model.save(str(tmp_path))
    assert predictions(ops.StackedModel.load(str(tmp_path))) == first


def test_importances_are_sorted_and_cut(model, data):
    names = data[0].columns[3:]
    top = ops.feature_importance(model.watch, names, k=5).collect()
    assert len(top) == 5 and top[0].feature == "w0"
    assert [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)
    assert ops.feature_importance(model.watch, names, k=None).count() == 32


def test_sequence_model_is_the_best_on_validation(spark, tmp_path):
    df = materialize(a.vector_channels(spark, SF))
    split = materialize(ops.subject_split(df))
    train, val, test = (ops.split_rows(df, split, s) for s in ("train", "val", "test"))
    candidates = [ops.SequenceCandidate(2, (4,), 5), ops.SequenceCandidate(40, (32,), 60)]
    best = ops.sequence_fit(train, val, 4, candidates, save_to=str(tmp_path / "m"))
    assert best.validation_accuracy == max(score for _, score in best.history)
    assert len(best.history) == 2
    assert ops.accuracy(best.transform(test)).first()["accuracy"] > 0.35
    from pyspark.ml import PipelineModel

    again = PipelineModel.load(str(tmp_path / "m")).transform(ops.channel_vectors(test))
    assert {(r.vec_id, r.prediction) for r in again.collect()} == {(r.vec_id, r.prediction) for r in best.transform(test).collect()}


def test_windows_with_a_hole_are_left_out_of_the_vectors(spark):
    df = spark.createDataFrame([([[1.0, 2.0]],), ([[None, 2.0]],), ([[float("nan"), 2.0]],)], "channels array<array<float>>")
    assert ops.channel_vectors(df).select(F.size("channels")).count() == 1
