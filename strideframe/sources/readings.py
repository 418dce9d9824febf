"""Sensor text files as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.schemas import READING_SCHEMA, STREAMS

#: Hadoop settings for a public bucket, to be given when the session is built.
ANONYMOUS_S3A = {
    "spark.hadoop.fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider",
}

#: Columns of a line's text, and of the text of lines that do not fit their schema.
LINE, CORRUPT_LINE = "line", "corrupt_line"

#: Layout of a raw folder: <root>/<device>/<sensor>/data_<subject>_<sensor>_<device>.txt
FILE_PATTERN = r"/([^/]+)/([^/]+)/data_(\d+)_[^/]*\.txt$"
#: The same where a writer made each object a folder of parts, by partition columns.
FOLDER_PATTERN = r"/device=([^/]+)/sensor=([^/]+)/object=data_(\d+)_[^/]*/[^/]*\.txt$"


def _reader(spark: SparkSession, schema: T.StructType, ignore_missing: bool) -> DataFrameReader:
    options = {"header": False, "mode": "PERMISSIVE", "ignoreMissingFiles": ignore_missing}
    return spark.read.schema(schema).options(**options)


def read_readings(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = READING_SCHEMA,
    ignore_missing: bool = False,
) -> DataFrame:
    """Headerless comma-separated readings under a fixed schema.

    ``path`` is any Hadoop path or glob (local, hdfs, s3a). Cells that do not
    parse, and cells a short line lacks, are null.
    """
    return _reader(spark, schema, ignore_missing).csv(path)


def read_marked(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = READING_SCHEMA,
    ignore_missing: bool = False,
) -> DataFrame:
    """Readings with the text of every line in ``LINE``, and again in ``CORRUPT_LINE`` if it does
    not fit the schema: a typed cell does not parse, or the number of cells is another.

    Cells that do parse keep their values. Lines of blanks only are not read.
    """
    marked = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema.fields, T.StructField(CORRUPT_LINE, T.StringType())])
    lines = spark.read.option("ignoreMissingFiles", ignore_missing).text(path).where("trim(value) != ''")
    cells = F.from_csv("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_LINE})
    # generated, so that no filter or column over the cells makes Spark parse the line again
    return lines.select(F.col("value").alias(LINE), F.inline(F.array(cells)))


def _keys_of(file: Column, pattern: str) -> list[Column]:
    return [
        F.regexp_extract(file, pattern, 1).alias("device"),
        F.regexp_extract(file, pattern, 2).alias("sensor"),
        F.regexp_extract(file, pattern, 3).try_cast("int").alias("file_subject"),
    ]


def read_streams(spark: SparkSession, root: str, ignore_missing: bool = False, pattern: str = FILE_PATTERN) -> DataFrame:
    """All devices and sensors below ``root`` in one scan.

    ``device``, ``sensor`` and ``file_subject`` come from each file's path, by the groups of
    ``pattern``. A file that vanishes between listing and reading is an error, or skipped
    with ``ignore_missing``.
    """
    reader = _reader(spark, READING_SCHEMA, ignore_missing).option("recursiveFileLookup", True)
    rows = reader.option("pathGlobFilter", "*.txt").csv(root)
    return rows.select(*_keys_of(F.col("_metadata.file_path"), pattern), *READING_SCHEMA.names)


def object_manifest(spark: SparkSession, root: str, subjects: DataFrame, subject: str = "subject_id", pattern: str = FILE_PATTERN) -> DataFrame:
    """What should lie below ``root``, and what does: ``file_subject, device, sensor, files,
    bytes, status``.

    Each of ``subjects`` should have an object for every stream. ``status`` is present, missing,
    or unexpected (another subject, or a path that names no stream). Files are listed with
    their sizes and not opened.
    """
    listed = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.txt").load(root)
    found = listed.select(*_keys_of(F.col("path"), pattern), "length").groupBy("file_subject", "device", "sensor")
    found = found.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    streams = F.array(*[F.struct(F.lit(d).alias("device"), F.lit(s).alias("sensor")) for d, s in STREAMS])
    wanted = subjects.select(F.col(subject).cast("int").alias("file_subject")).distinct().select("file_subject", F.inline(streams)).withColumn("_wanted", F.lit(True))
    keys = ["file_subject", "device", "sensor"]
    met = wanted.join(found, keys, "full")
    status = F.when(F.col("files").isNull(), "missing").when(F.col("_wanted").isNull(), "unexpected").otherwise("present")
    zero = F.lit(0).cast("long")
    return met.select(*keys, F.coalesce("files", zero).alias("files"), F.coalesce("bytes", zero).alias("bytes"), status.alias("status"))


def read_stream(
    spark: SparkSession, root: str, device: str, sensor: str, ignore_missing: bool = False
) -> DataFrame:
    """The readings of one device's sensor below ``root``."""
    reader = _reader(spark, READING_SCHEMA, ignore_missing).option("pathGlobFilter", "*.txt")
    return reader.csv(f"{root.rstrip('/')}/{device}/{sensor}")


def write_readings(df: DataFrame, path: str, terminator: str = ";") -> None:
    """Write readings back in the text form that ``read_readings`` reads.

    A null is an empty cell, without a terminator, and comes back as null.
    """
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in READING_SCHEMA.names[:-1]]
    last = F.col(READING_SCHEMA.names[-1]).cast("string")
    line = F.concat_ws(",", *cells, F.coalesce(F.concat(last, F.lit(terminator)), F.lit("")))
    df.select(line.alias("value")).write.mode("overwrite").text(path)
