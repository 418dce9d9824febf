import pytest

from strideframe import operators as ops


@pytest.fixture(scope="module")
def scored(spark):
    # class 2 is never predicted, class 3 is never actual
    pairs = [(0, 0)] * 4 + [(0, 1)] + [(1, 1)] * 2 + [(1, 3)] * 2 + [(2, 0)]
    return spark.createDataFrame([(a, float(p), "ABC"[a]) for a, p in pairs], "label int, prediction double, activity_label string")


def test_accuracy(scored):
    r = ops.accuracy(scored).first()
    assert (r.accuracy, r.rows) == (0.6, 10)


def test_accuracy_by_is_best_first(scored):
    got = [(r.activity_label, r.accuracy, r.windows) for r in ops.accuracy_by(scored).collect()]
    assert got == [("A", 0.8, 5), ("B", 0.5, 4), ("C", 0.0, 1)]


def test_confusion_covers_classes_of_either_side(scored):
    got = {(r.label, r.prediction): r.rows for r in ops.confusion_matrix(scored).collect()}
    assert sum(got.values()) == 10 and 0 not in got.values()
    assert (got[0, 0], got[0, 1], got[1, 3], got.get((2, 2)), got.get((3, 3))) == (4, 1, 2, None, None)
    assert ops.confusion_matrix(scored, classes=range(6)).count() == 36


def test_rows_without_a_known_class_are_counted(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, None), ("b", None, 1), ("b", 7, 2)], "activity_label string, label int, prediction int")
    one = ops.accuracy(df).first()
    assert (one.accuracy, one.rows) == (0.25, 4)
    got = {(r.label, r.prediction): r.rows for r in ops.confusion_matrix(df, classes=[1, 2]).collect()}
    assert got == {(1, 1): 1, (1, 2): 0, (2, 1): 0, (2, 2): 0, (1, None): 1, (None, 1): 1, (None, 2): 1}
    got = {(r.label, r.prediction): r.rows for r in ops.confusion_matrix(df).collect()}
    assert got == {(1, 1): 1, (1, None): 1, (None, 1): 1, (7, 2): 1}


def test_percent_of_an_empty_class_is_null(scored):
    got = {(r.label, r.prediction): r.pct for r in ops.confusion_pct(ops.confusion_matrix(scored, classes=range(4))).collect()}
    assert got[0, 0] == 80.0 and got[2, 0] == 100.0 and got[3, 0] is None


def test_report(scored):
    got = {r["class"]: r for r in ops.classification_report(ops.confusion_matrix(scored)).collect()}
    assert (got["0"].precision, got["0"].recall, got["0"].support) == (0.8, 0.8, 5)
    assert got["1"].precision == pytest.approx(2 / 3) and got["1"].recall == 0.5
    assert got["1"].f1_score == pytest.approx(4 / 7)
    assert (got["2"].precision, got["2"].recall, got["2"].f1_score) == (0.0, 0.0, 0.0)
    assert (got["3"].recall, got["3"].support) == (0.0, 0)
    assert (got["accuracy"].precision, got["accuracy"].f1_score, got["accuracy"].support) == (None, 0.6, 10)
    assert got["macro avg"].recall == pytest.approx((0.8 + 0.5) / 4)
    assert got["weighted avg"].recall == pytest.approx(0.6)
