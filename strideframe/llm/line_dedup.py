"""Line dedup: which lines of each document stay, as run-length bitmaps.

Every long line becomes a row (hash of its key, document, position). Rows are
range-partitioned by hash and sorted by document within it, largest id first, so that the
document that keeps a key streams past first and decides for the rest; no text is
shuffled for that. What comes back is one compressed bitmap for each document.

A key that a third of all lines share would fill one range. A bounded heavy-hitters
sketch names such keys beforehand; they are summed up before the shuffle and decided
by a join with a table of at most ``HEAVY_KEYS`` rows. Both ways are exact, so the
sketch moves work and never changes a result.

All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strideframe.llm.common import cut, free_name, lower_ascii, without

MIN_LENGTH = 40
MIN_DOCS = 5
#: Keys that the sketch may name, and what it keeps track of to find them.
HEAVY_KEYS = 1_000
SKETCH_ITEMS = 20_000
#: ASCII white space, x09 to x0D and blank.
BLANKS = "\t\n\x0b\f\r "


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def occurrences(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """One row for each line of ``docs`` (``id, text_hash, text``) whose key has
    ``min_length`` code points: ``id, text_hash, pos`` and the key's 128-bit hash ``h1, h2``."""
    lines = docs.select("id", "text_hash", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    long = lines.where(F.char_length("line") >= min_length)
    keyed = long.select("id", "text_hash", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_length)
    return keyed.select("id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))


def heavy_keys(lines: DataFrame) -> DataFrame:
    """``h1`` of at most ``HEAVY_KEYS`` keys, the most frequent by a bounded sketch."""
    top = lines.agg(F.expr(f"approx_top_k(h1, {HEAVY_KEYS}, {SKETCH_ITEMS})").alias("top"))
    return top.select(F.explode("top").alias("t")).where("t.count > 1").select(F.col("t.item").alias("h1"))


def dropped_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``id, text_hash, pos`` of the lines to drop: those whose key is in at least
    ``min_docs`` documents, but for the largest id that holds it.

    Rows of one id are one document; a null id is one document, smaller than all others.
    """
    heavy = cut(heavy_keys(lines), "heavy-keys")
    # at most HEAVY_KEYS rows of eight bytes
    side = F.broadcast(heavy)

    # by id alone: lines of one document share a rank
    order = W.partitionBy("h1", "h2").orderBy(F.col("id").desc_nulls_last())
    rest = lines.join(side, "h1", "left_anti").repartitionByRange("h1", "h2")
    ranked = rest.withColumn("doc_rank", F.dense_rank().over(order))
    ranked = ranked.withColumn("n_docs", F.max("doc_rank").over(W.partitionBy("h1", "h2")))
    light = ranked.where((F.col("n_docs") >= min_docs) & (F.col("doc_rank") > 1))

    hot = lines.join(side, "h1", "left_semi")
    # one row for each key and document, then one for each key
    by_doc = hot.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
    stats = by_doc.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("last"))
    stats = cut(stats.where(F.col("n_docs") >= min_docs), "heavy-lines")
    # a hash can hold few keys, so these are about HEAVY_KEYS rows; the planner sees their size
    hot = hot.join(stats, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("last")))
    return light.select("id", "text_hash", "pos").unionByName(hot.select("id", "text_hash", "pos"))


def keep_bitmaps(docs: DataFrame, id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row for each document that loses lines: ``id, text_hash, n_dropped, dropped``.

    ``dropped`` is the keep bitmap, run-length coded: ascending ``(start, length)`` of
    the runs of lines that go. ``text_hash`` tells rows of one id apart; equal rows
    share one bitmap. Documents without a row here keep every line.
    """
    lines = cut(occurrences(_base(docs, id, text), min_length), "line-hashes")
    gone = dropped_lines(lines, min_docs).distinct()
    in_doc = W.partitionBy("id", "text_hash").orderBy("pos")
    islands = gone.withColumn("island", F.col("pos") - F.row_number().over(in_doc))
    runs = islands.groupBy("id", "text_hash", "island").agg(F.min("pos").alias("start"), F.count(F.lit(1)).cast("int").alias("length"))
    return runs.groupBy("id", "text_hash").agg(
        F.sum("length").alias("n_dropped"), F.array_sort(F.collect_list(F.struct("start", "length"))).alias("dropped")
    )


def _base(docs: DataFrame, id: str, text: str) -> DataFrame:
    base = docs.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return base.select("id", F.xxhash64("text").alias("text_hash"), "text")


def kept_text(lines: Column, dropped: Column) -> Column:
    """The lines outside the runs of ``dropped``, joined by line feeds."""
    last = F.size(dropped)

    def piece(i: Column) -> Column:
        before = F.element_at(dropped, F.greatest(i, F.lit(1)))
        begin = F.when(i == 0, 0).otherwise(before["start"] + before["length"])
        end = F.when(i == last, F.size(lines)).otherwise(F.element_at(dropped, F.least(i + 1, last))["start"])
        return F.slice(lines, begin + 1, end - begin)

    return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), last), piece)), "\n")


def apply_bitmaps(docs: DataFrame, id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS) -> DataFrame:
    """Every row of ``docs`` with its bitmap applied: all columns, ``text`` replaced by
    what is kept, and ``n_lines``, ``n_dropped`` (written over columns of those names).

    A null or empty text is one empty line; a null text that loses nothing stays null.
    """
    bitmaps = keep_bitmaps(docs, id, text, min_length, min_docs)
    own_id, own_hash, n, dropped = (free_name(docs, stem) for stem in ("bitmap_id", "bitmap_hash", "bitmap_n", "bitmap_runs"))
    bitmaps = bitmaps.select(F.col("id").alias(own_id), F.col("text_hash").alias(own_hash), F.col("n_dropped").alias(n), F.col("dropped").alias(dropped))
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    counts = [c for c in ("n_lines", "n_dropped") if c not in (id, text)]
    base = without(docs, *counts)
    same = F.col(f"`{id}`").eqNullSafe(F.col(own_id)) & (F.xxhash64(whole) == F.col(own_hash))
    lines = F.split(whole, "\n")
    left = F.when(F.col(dropped).isNull(), F.col(f"`{text}`")).otherwise(kept_text(lines, F.col(dropped)))
    values = {"n_lines": F.size(lines).cast("long"), "n_dropped": F.coalesce(F.col(n), F.lit(0)).cast("long")}
    return base.join(bitmaps, same, "left").select(
        *[left.alias(c) if c == text else F.col(f"`{c}`") for c in base.columns], *[values[c].alias(c) for c in counts]
    )


def without_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", length: str = "n_chars", min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``text`` replaced by what is kept; every other column stays as it is,
    but for ``length``: where there is such a column, it follows a text that loses lines.

    Nulls and empty texts as in ``apply_bitmaps``; repeated rows stay repeated.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    left = apply_bitmaps(docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), row), "id", "text", min_length, min_docs)
    shorter = F.when(F.col("n_dropped") > 0, F.char_length("text"))
    kinds = dict(docs.dtypes)
    columns = [
        F.col("text").alias(c) if c == text
        else F.coalesce(shorter.cast(kinds[c]), F.col(f"row.`{c}`")).alias(c) if c == length
        else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ]
    return left.select(*columns)
