"""Where intermediate tables go, and how they are cut, kept or skipped."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Tables that the innermost ``scratch`` will remove.
_SCRATCH: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("scratch", default=None)
#: Whether the files of a query's shuffles are removed as soon as it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Marks a finished table by a ``_SUCCESS`` file.
FINISHED = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir`` or set as checkpoint folder, which
    every executor can read. There is no other: a folder of one machine is lost with it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named


def new_table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "cut", **options: str) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written table.

    What is read back no longer depends on how often or in which order a task
    ran, and a lost executor costs a re-read instead of a recomputation. It stays until
    it is removed, or until the end of the ``scratch`` it is written in.
    """
    spark = df.sparkSession
    path = new_table_path(spark, name)
    if (scratched := _SCRATCH.get()) is not None:
        scratched.append((spark, path))
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch() -> Iterator[None]:
    """Tables that ``materialize`` writes inside serve only what is done inside: they are removed
    at its end. Those of a failed step stay."""
    tables: list[tuple[SparkSession, str]] = []
    token = _SCRATCH.set(tables)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
    for spark, path in tables:
        drop_table(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The files of each query's shuffles go when it ends, not when the driver happens to collect
    its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def _located(spark: SparkSession, path: str, *child: str):
    """The file system of ``path`` and Hadoop's path in it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, *child)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove the folder at ``path``, if it is there."""
    files, place = _located(spark, path)
    files.delete(place, True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a finished table (with its ``_SUCCESS`` mark) lies at ``path``."""
    files, mark = _located(spark, path, "_SUCCESS")
    return files.exists(mark)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table at ``path``; under ``schema``, partition columns keep their type, which
    is guessed from folder names otherwise."""
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", **options: str) -> None:
    """Overwrite ``path`` with ``df`` as Parquet, or append to it by ``mode``."""
    writer = df.write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def rows_written(spark: SparkSession, path: str) -> int:
    """The rows of a table, from the footers of its files; no column is read.

    An observation of the write would tell the same, but a session that ever made one can
    no longer ship fitted binary forests to its tasks: their summaries hold the session.
    """
    return spark.read.parquet(path).count()


def read_or_compute(
    spark: SparkSession,
    path: str,
    compute: Callable[[], DataFrame],
    skip_existing: bool = True,
    partition_by: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """The table at ``path``, computed and written first unless it is there to skip.

    A table that is there is read under ``schema``, where one is given.
    """
    if skip_existing and table_exists(spark, path):
        return read_table(spark, path, schema)
    table = compute()
    write_table(table, path, partition_by)
    return read_table(spark, path, T.StructType([table.schema[c] for c in _written(table.columns, partition_by)]))


def _written(columns: Sequence[str], partition_by: Sequence[str]) -> list[str]:
    """The order in which a written table has its columns."""
    return [*(c for c in columns if c not in partition_by), *partition_by]


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows as a DataFrame (``.show()`` prints them)."""
    return df.limit(n)
