"""The driver's tables seen as sensor readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.functions import argmax

TICKS_PER_SECOND = 1e6
LINEITEM_ORDER = ("timestamp", "l_orderkey", "l_linenumber", "l_partkey")
LINEITEM_AXES = ("x", "y", "z")
SIX_HOURS = 6 * 3600 * 1_000_000
EVENT_NAMES = {"click": "Clicking", "view": "Viewing", "purchase": "Buying"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(c: str) -> Column:
    """Microseconds since 1970 of a zoneless timestamp, whatever the session zone."""
    return F.unix_micros(F.from_utc_timestamp(F.col(c).cast("timestamp"), F.current_timezone()))


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("subject_id"),
        F.col("l_returnflag").alias("activity_label"),
        micros("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("x"),
        F.col("l_extendedprice").alias("y"),
        F.col("l_discount").alias("z"),
        F.col("l_tax").alias("t"),
        F.col("l_linestatus").alias("side"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("subject_id"),
        F.col("event_type").alias("activity_label"),
        micros("ts").alias("timestamp"),
        F.col("value").alias("x"),
        F.get_json_object("props", "$.k").cast("double").alias("y"),
        F.col("event_id").cast("double").alias("z"),
        "event_id",
    )


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as terminated text; errors carry no number and views no label."""
    text = F.when(F.col("activity_label") == "error", F.lit("err ;")).otherwise(
        F.concat(F.col("x").cast("string"), F.lit(" ;"))
    )
    label = F.when(F.col("activity_label") != "view", F.col("activity_label"))
    return event_readings(spark, sf_dir).select("event_id", label.alias("activity_label"), text.alias("z"))


def sensor_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Clicks and purchases as the first sensor, all other events as the second."""
    events = event_readings(spark, sf_dir)
    first = F.col("activity_label").isin("click", "purchase")
    return events.where(first), events.where(~first)


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading lines of whole numbers, some broken by their order's number modulo 13: a cell
    of each column, two cells, a cell too many, a missing key or cells at the end."""
    kind = F.col("l_orderkey") % 13

    def cell(value: str, broken: dict):
        out = F.col(value).cast("string")
        for k, text in broken.items():
            out = F.when(kind == k, F.lit(text)).otherwise(out)
        return out

    cells = [
        cell("l_suppkey", {0: "S-1", 8: ""}),
        cell("l_returnflag", {1: ""}),
        cell("l_orderkey", {2: "12h"}),
        cell("l_linenumber", {3: "x?", 6: "1.2.3"}),
        cell("l_partkey", {4: "--"}),
    ]
    last = F.when(kind.isin(5, 6), F.lit("err;")).otherwise(F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(";")))
    line = F.concat_ws(",", *cells, last, F.when(kind == 7, F.lit("7")))
    return table(spark, sf_dir, "lineitem").select(F.when(kind == 9, F.concat_ws(",", *cells[:4])).otherwise(line).alias("value"))


def write_raw_streams(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Lines of all orders as raw text of two devices with two sensors each, below ``root``.

    Odd lines are the watch's, even ones the phone's. Both sensors of a device see every
    line of it; in every 17th order the accelerometer's last cell is no number.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("subject"),
        F.translate("l_returnflag", "NR", "BC").alias("code"),
        (F.col("l_orderkey") * 1_000 + F.col("l_linenumber") * 50).alias("time"),
        F.when(F.col("l_linenumber") % 2 == 1, "watch").otherwise("phone").alias("device"),
        (F.col("l_orderkey") % 17 == 3).alias("broken"),
        *[F.col(c).cast("int").cast("string").alias(c) for c in ("l_quantity", "l_linenumber", "l_partkey", "l_orderkey")],
    )
    for device in ("watch", "phone"):
        own = lines.where(F.col("device") == device)
        last = F.when(F.col("broken"), "err;").otherwise(F.concat("l_linenumber", F.lit(";")))
        for sensor, late, cells in (("accel", 0, ["l_quantity", "l_partkey", last]), ("gyro", 7, ["l_partkey", "l_orderkey", F.concat("l_quantity", F.lit(";"))])):
            keys = [F.col("subject").cast("string"), F.col("code"), (F.col("time") + late).cast("string")]
            own.select(F.concat_ws(",", *keys, *cells)).write.mode("overwrite").text(f"{root}/{device}/{sensor}")


def device_vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Embeddings halved into two devices of 32 features each.

    The label says in which half's leading component the vector is positive, so
    each device can see one of its two bits.
    """
    e = F.col("embedding")
    bits = F.when(e[0] > 0, 2).otherwise(0) + F.when(e[32] > 0, 1).otherwise(0)
    keyed = table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") % 51).cast("int").alias("subject_id"),
        F.concat(F.lit("c"), bits.cast("string")).alias("activity_label"),
        F.col("vec_id").alias("window_index"),
        e,
    )
    keys = ["subject_id", "activity_label", "window_index"]
    watch = keyed.select(*keys, *[e[i].alias(f"w{i}") for i in range(32)])
    phone = keyed.select(*keys, *[e[i].alias(f"p{i}") for i in range(32, 64)])
    return watch, phone


def vector_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 2 channels of 32 readings, labelled 0 to 3."""
    e = F.col("embedding")
    bits = F.when(e[0] > 0, 2).otherwise(0) + F.when(e[32] > 0, 1).otherwise(0)
    return table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") % 51).cast("int").alias("subject_id"),
        "vec_id",
        F.array(F.slice(e, 1, 32), F.slice(e, 33, 32)).alias("channels"),
        bits.alias("label"),
    )


def scored_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of the largest of all components, folded to ten classes, as prediction of ``label``."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("label"),
        (argmax(F.col("embedding")) % 10).alias("prediction"),
        F.concat(F.lit("class "), F.col("label").cast("string")).alias("activity_label"),
    )
