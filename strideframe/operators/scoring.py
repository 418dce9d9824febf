"""Accuracy, confusion and per-class reports over (label, prediction) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _correct(label: str, prediction: str):
    """1 or 0; a null prediction is wrong, and so is any prediction for a null label."""
    return F.coalesce(F.col(prediction) == F.col(label), F.lit(False)).cast("int")


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and rows."""
    return df.agg(F.avg(_correct(label, prediction)).alias("accuracy"), F.count(F.lit(1)).alias("rows"))


def accuracy_cross_check(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``accuracy`` with the library evaluator's own figure beside it; both are shares of the
    rows that have a label and a prediction."""
    whole = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    told = whole.select(F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction"))
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    return accuracy(whole, label, prediction).withColumn("evaluator_accuracy", F.lit(evaluator.evaluate(told)))


def accuracy_by(
    df: DataFrame, by: str = "activity_label", label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Accuracy and number of windows per value of ``by``, best first."""
    return (
        df.groupBy(by)
        .agg(F.avg(_correct(label, prediction)).alias("accuracy"), F.count(F.lit(1)).alias("windows"))
        .orderBy(F.desc("accuracy"), F.asc(by))
    )


def confusion_matrix(
    df: DataFrame,
    classes: Sequence | None = None,
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Rows per (label, prediction). Over given ``classes`` every pair has a row, zeros
    too; without them only pairs that occur have one.

    No row is lost: a null, or a value that is not in ``classes``, is counted under null.
    """
    kind = df.schema[label].dataType
    pairs = df.select(F.col(label).alias("label"), F.col(prediction).cast(kind).alias("prediction"))
    if classes is None:
        counts = pairs.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("rows"))
        return counts.orderBy("label", "prediction")
    known = F.array(*[F.lit(c).cast(kind) for c in classes])
    pairs = pairs.select(*[F.when(F.array_contains(known, F.col(c)), F.col(c)).alias(c) for c in pairs.columns])
    one = df.sparkSession.range(1)
    grid = one.select(F.explode(known).alias("label")).select("label", F.explode(known).alias("prediction"))
    zeros = grid.withColumn("n", F.lit(0).cast("long"))
    cells = pairs.withColumn("n", F.lit(1).cast("long")).unionByName(zeros)
    return cells.groupBy("label", "prediction").agg(F.sum("n").alias("rows")).orderBy("label", "prediction")


def confusion_pct(confusion: DataFrame) -> DataFrame:
    """Percent of the actual class; null for a class that never occurs."""
    total = F.sum("rows").over(W.partitionBy("label"))
    share = F.when(total > 0, F.col("rows") * F.lit(100.0) / total)
    return confusion.select("label", "prediction", share.alias("pct"))


def classification_report(confusion: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and
    weighted averages; a ratio with nothing to divide by is 0."""

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    hit = F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(F.lit(0).cast("long"))
    zero = F.lit(0).cast("long")
    sides = confusion.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("class"), hit.alias("tp"), F.col("rows").alias("actual"), zero.alias("predicted")),
                F.struct(F.col("prediction").alias("class"), zero.alias("tp"), zero.alias("actual"), F.col("rows").alias("predicted")),
            )
        )
    )
    totals = sides.groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("actual").alias("support"), F.sum("predicted").alias("predicted")
    )
    totals = totals.where(F.col("class").isNotNull())
    per_class = totals.select(
        F.col("class").cast("string").alias("class"),
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1_score"),
        "support",
        "tp",
    )
    scores = ("precision", "recall", "f1_score")
    one = per_class.agg(
        F.sum("tp").alias("tp"),
        F.sum("support").alias("n"),
        *[F.avg(s).alias(f"m_{s}") for s in scores],
        *[F.sum(F.col(s) * F.col("support")).alias(f"w_{s}") for s in scores],
    )
    none = F.lit(None).cast("double")
    summary = one.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("accuracy").alias("class"),
                    none.alias("precision"),
                    none.alias("recall"),
                    ratio(F.col("tp"), F.col("n")).alias("f1_score"),
                    F.col("n").alias("support"),
                ),
                F.struct(
                    F.lit("macro avg").alias("class"),
                    *[F.col(f"m_{s}").alias(s) for s in scores],
                    F.col("n").alias("support"),
                ),
                F.struct(
                    F.lit("weighted avg").alias("class"),
                    *[ratio(F.col(f"w_{s}"), F.col("n")).alias(s) for s in scores],
                    F.col("n").alias("support"),
                ),
            )
        )
    )
    return per_class.drop("tp").unionByName(summary)
