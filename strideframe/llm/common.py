"""What the text operators share: word rules, cuts, and bounded slices of batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.sources.storage import materialize, new_table_path

#: Text bytes that a Python task works on at a time.
SLICE_BYTES = 8 * 1024 * 1024

__all__ = [
    "ALNUM",
    "SLICE_BYTES",
    "arrow_rows",
    "bounded_sample",
    "cut",
    "free_name",
    "lower_ascii",
    "materialize",
    "new_table_path",
    "slices",
    "table",
    "without",
]

#: A-Z to a-z; digits, a-z and bytes above 0x7F stay; all else becomes a space.
ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table."""
    return materialize(df, name)


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    ascii_only = F.char_length(c) == F.octet_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(F.translate(c, _UPPER, _UPPER.lower()))


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, or a name made from it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"{stem}_{uuid.uuid4().hex[:6]}"
    return stem


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that are about to be written, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def bounded_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` of ``rows``, those with the least hashes of ``key``; all where there are no more.

    The table's size gives a hash below which hardly more than ``n`` rows lie, so that no
    partition sends more than its share of them to the last sort. Give it a written table;
    rows of equal keys should be equal.
    """
    total, scale = rows.count(), 1 << 30
    place = F.pmod(F.xxhash64(key), F.lit(scale))
    if total > n:
        rows = rows.where(place < int(scale * min(1.0, (n + 8 * n**0.5 + 64) / total)))
    return rows.orderBy(place, key).limit(n)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = batch.column(column)
        total, begin = 0, 0
        for i, n in enumerate(pc.binary_length(sizes).to_pylist()):
            if total and total + (n or 0) > limit:
                yield batch.slice(begin, i - begin)
                total, begin = 0, i
            total += n or 0
        yield batch.slice(begin)


def arrow_rows(schema: T.StructType, columns: Sequence) -> pa.RecordBatch:
    """A batch of ``schema`` from one sequence for each column."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, target, strict=True)],
        schema=target,
    )
