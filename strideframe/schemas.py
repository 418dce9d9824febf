"""Schemas, column sets and the activity dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: One reading of one sensor, as it lies in the headerless text files. ``z`` is
#: text because every line ends in a terminator.
READING_SCHEMA = T.StructType(
    [
        T.StructField("subject_id", T.IntegerType()),
        T.StructField("activity_label", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("x", T.FloatType()),
        T.StructField("y", T.FloatType()),
        T.StructField("z", T.StringType()),
    ]
)

SERIES_KEYS = ("subject_id", "activity_label")
WINDOW_KEYS = ("subject_id", "activity_label", "window_index")
META_COLUMNS = frozenset({"subject_id", "activity_label", "seq_id", "timestamp"})
WINDOW_META_COLUMNS = frozenset(WINDOW_KEYS)

#: (device, sensor) of each stream and the prefix of its axes.
STREAMS = {
    ("watch", "accel"): "wa",
    ("watch", "gyro"): "wg",
    ("phone", "accel"): "pa",
    ("phone", "gyro"): "pg",
}

# Activity code -> name, in code order (there is no N).
ACTIVITIES = {
    "A": "Walking",
    "B": "Jogging",
    "C": "Stairs",
    "D": "Sitting",
    "E": "Standing",
    "F": "Typing",
    "G": "Teeth",
    "H": "Soup",
    "I": "Chips",
    "J": "Pasta",
    "K": "Drinking",
    "L": "Sandwich",
    "M": "Kicking",
    "O": "Catch",
    "P": "Dribbling",
    "Q": "Writing",
    "R": "Clapping",
    "S": "Folding",
}

#: Activity code -> class index, in code order.
CLASS_INDEX = {code: i for i, code in enumerate(ACTIVITIES)}


def axes(prefix: str) -> tuple[str, str, str]:
    return (f"{prefix}_x", f"{prefix}_y", f"{prefix}_z")


def activity_dimension(spark: SparkSession) -> DataFrame:
    """18 fixed rows: activity_label, activity_name, class_index."""
    rows = [(code, name, CLASS_INDEX[code]) for code, name in ACTIVITIES.items()]
    return spark.createDataFrame(rows, "activity_label string, activity_name string, class_index int")


def feature_columns(df: DataFrame, meta: frozenset[str] = META_COLUMNS) -> list[str]:
    """Every column that is not a key, in table order."""
    return [c for c in df.columns if c not in meta]
