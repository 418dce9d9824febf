"""Cleaning and time alignment of readings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.functions import parse_reading, snap_to_grid
from strideframe.schemas import READING_SCHEMA
from strideframe.sources.readings import CORRUPT_LINE, LINE

#: Column of what is wrong with a line: ``column, reason`` of each fault.
MARKS = "_marks"


def clean_readings(
    df: DataFrame, col: str = "z", label: str = "activity_label", terminator: str = ";"
) -> tuple[DataFrame, DataFrame]:
    """Parse the dirty column; returns (clean rows, rejected rows).

    Rejected are rows whose text is no number and rows without a label. A cell
    that was null in the file stays a null reading.
    """
    parsed = parse_reading(col, terminator)
    bad = _is_bad(parsed, col, label)
    return df.where(~bad).withColumn(col, parsed), df.where(bad)


def rejected_readings(
    df: DataFrame, col: str = "z", label: str = "activity_label", terminator: str = ";"
) -> DataFrame:
    """The rejects of ``clean_readings`` with the reason of each."""
    parsed = parse_reading(col, terminator)
    reason = F.when(F.col(label).isNull(), F.lit("no label")).otherwise(F.lit("bad number"))
    return df.where(_is_bad(parsed, col, label)).withColumn("reason", reason)


def mark_malformed(
    marked: DataFrame,
    schema: T.StructType = READING_SCHEMA,
    terminated: str = "z",
    required: Sequence[str] = ("subject_id", "activity_label", "timestamp"),
    terminator: str = ";",
) -> DataFrame:
    """The lines of ``read_marked`` with what is wrong with each, by column, in ``MARKS``.

    Write it down where both sides of ``split_malformed`` are read, or each judges all lines.
    """
    names = schema.names
    parsed = parse_reading(terminated, terminator)
    absent = {n: F.col(n).isNull() | (F.trim(F.col(n).cast("string")) == "") for n in names if n in required}

    def unread(written: Column, value: Column) -> Column:
        return F.when(F.coalesce(F.length(written), F.lit(0)) > 0, value.isNull())

    def marks(texts: Column) -> Column:
        found = []
        for i, n in enumerate(names):
            cell = F.when(F.col(CORRUPT_LINE).isNotNull(), F.trim(texts[f"_{i}"]))
            wrong = unread(F.col(n), parsed) if n == terminated else unread(cell, F.col(n))
            reason = F.when(wrong, "not a number")
            if n in required:
                reason = reason.when(absent[n], "missing")
            found.append(F.struct(F.lit(n).alias("column"), reason.alias("reason")))
        extra = F.when(texts[f"_{len(names)}"].isNotNull(), "too many cells")
        found.append(F.struct(F.lit("line").alias("column"), extra.alias("reason")))
        return F.filter(F.array(*found), lambda m: m["reason"].isNotNull())

    # What any mark comes with: nearly all lines are without it, and their cells are not looked at.
    suspect = reduce(Column.__or__, absent.values(), F.col(CORRUPT_LINE).isNotNull())
    if terminated in names:
        suspect |= F.coalesce(unread(F.col(terminated), parsed), F.lit(False))
    # the text of the cells, of lines that the reader marked, once for all marks
    parts = F.from_csv(CORRUPT_LINE, ", ".join(f"_{i} string" for i in range(len(names) + 1)))
    none = F.array().cast("array<struct<column:string,reason:string>>")
    found = F.when(suspect, F.transform(F.array(parts), marks)[0]).otherwise(none)
    # generated, so that the marks are not evaluated again for each place that names them
    return marked.select("*", F.explode(F.array(found)).alias(MARKS))


def settle_malformed(
    found: DataFrame, schema: T.StructType = READING_SCHEMA, terminated: str = "z", terminator: str = ";"
) -> DataFrame:
    """``mark_malformed`` as it is to be written: with the terminated cell parsed, and with the
    text of those lines only that are rejects. ``split_malformed`` takes it too."""
    parsed = parse_reading(terminated, terminator).alias(terminated)
    cells = [parsed if n == terminated else F.col(n) for n in schema.names]
    return found.select(F.when(F.size(MARKS) > 0, F.col(LINE)).alias(LINE), *cells, MARKS)


def split_malformed(
    marked: DataFrame,
    schema: T.StructType = READING_SCHEMA,
    terminated: str = "z",
    required: Sequence[str] = ("subject_id", "activity_label", "timestamp"),
    terminator: str = ";",
) -> tuple[DataFrame, DataFrame]:
    """Clean rows and rejects of ``read_marked``, or of ``mark_malformed`` by the same rules,
    settled or not; together they are all lines read.

    A line is a reject if a cell with text does not parse, a required cell is missing, or
    there are more cells than columns. Each reject has the line's text, the columns that
    broke, in order, and their reasons: ``line, broken, reasons``. Cells that a short line
    lacks, and empty cells that are not required, are null readings and no rejects.
    """
    found = marked if MARKS in marked.columns else mark_malformed(marked, schema, terminated, required, terminator)
    rejects = found.where(F.size(MARKS) > 0).select(
        LINE,
        F.array_join(F.col(f"{MARKS}.column"), ",").alias("broken"),
        F.array_join(F.col(f"{MARKS}.reason"), ",").alias("reasons"),
    )
    clean = found.where(F.size(MARKS) == 0)
    if clean.schema[terminated].dataType != T.FloatType():  # settled lines have it parsed
        clean = clean.withColumn(terminated, parse_reading(terminated, terminator))
    clean = clean.select(*schema.names)
    return clean, rejects


def _is_bad(parsed: Column, col: str, label: str) -> Column:
    return (F.col(col).isNotNull() & parsed.isNull()) | F.col(label).isNull()


def align_time(df: DataFrame, grid: int = 50, col: str = "timestamp") -> DataFrame:
    """Move ``col`` to the nearest multiple of ``grid``."""
    return df.withColumn(col, snap_to_grid(col, grid))
