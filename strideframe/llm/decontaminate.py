"""Benchmark decontamination with a generalised suffix automaton.

All test items of a block go into one automaton over normalised words. Documents are
streamed through it; at each word it knows the longest run of words ending there that
occurs in some item. A run as long as a window marks its words as hit.

The items are a query set: they are cut into blocks of bounded size, and each block's
automaton is built once, broadcast, and applied to every document in a map. Nothing
is shuffled, and no item or document is left out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm.common import ALNUM, without

WINDOW = 13
#: Share of hit words from which a document is contaminated, as a fraction of integers.
MAX_COVERAGE = (1, 20)
#: Item text in one automaton; its broadcast is some fifty times as large at most.
BLOCK_BYTES = 2 * 1024 * 1024

_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def normal_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of anything above 0x7F; A-Z lower-cased."""
    return (text or "").encode().translate(ALNUM).split()


class SuffixAutomaton:
    """Every run of words of some items, and which windows of which items end where."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        #: items by the state that their windows of full size end in
        self.items: dict[int, list] = {}
        #: (length, item) of items shorter than a window, by state
        self.short: dict[int, list] = {}
        self.shortest = window

    def _copy(self, of: int, length: int) -> int:
        self.step.append(dict(self.step[of]))
        self.link.append(self.link[of])
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state for the runs of ``q`` that extend those of ``p``."""
        if self.length[q] == self.length[p] + 1:
            return q
        twin = self._copy(q, self.length[p] + 1)
        self.link[q] = twin
        while p != -1 and self.step[p].get(word) == q:
            self.step[p][word] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, word: bytes) -> int:
        known = self.step[last].get(word)
        if known is not None:
            return self._split(last, word, known)
        self.step.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        new, p = len(self.length) - 1, last
        while p != -1 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p != -1:
            self.link[new] = self._split(p, word, self.step[p][word])
        return new

    def add(self, words: list[bytes]) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def label(self, item: str | None, words: list[bytes]) -> None:
        """Note where the windows of an added item end; call it after the last ``add``."""
        size = min(self.window, len(words))
        if not size:
            return
        v = 0
        for i, w in enumerate(words):
            v = self.step[v][w]
            if i + 1 >= size:
                u = v
                while self.length[self.link[u]] >= size:
                    u = self.link[u]
                if size == self.window:
                    ids = self.items.setdefault(u, [])
                    if item not in ids:
                        ids.append(item)
                else:
                    self.short.setdefault(u, []).append((size, item))
        self.shortest = min(self.shortest, size)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """``(start, length)`` of the hit runs of ``words``, and the items they are from."""
        step, link, length, window = self.step, self.link, self.length, self.window
        runs: list[list[int]] = []
        found: set = set()
        v = matched = 0
        shortest, short = self.shortest, self.short
        for p, w in enumerate(words):
            to = step[v].get(w)
            while to is None and v:
                v = link[v]
                matched = length[v]
                to = step[v].get(w)
            if to is None:
                matched = 0
                continue
            v = to
            matched += 1
            if matched < shortest:
                continue
            size, u = 0, v
            if matched >= window:
                size = window
                while length[link[u]] >= window:
                    u = link[u]
                found.update(self.items.get(u, ()))
            if short:
                u = v
                while u > 0:
                    for n, item in short.get(u, ()):
                        if n <= matched:
                            size = max(size, n)
                            found.add(item)
                    u = link[u]
            if size:
                begin = p + 1 - size
                while runs and begin <= runs[-1][1]:
                    begin = min(begin, runs.pop()[0])
                runs.append([begin, p + 1])
        return [(a, b - a) for a, b in runs], found


def build(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> SuffixAutomaton:
    automaton = SuffixAutomaton(window)
    split = [(i, normal_words(t)) for i, t in items]
    for _, words in split:
        automaton.add(words)
    for i, words in split:
        automaton.label(i, words)
    return automaton


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, length in sorted(runs):
        if out and start <= out[-1][0] + out[-1][1]:
            out[-1][1] = max(out[-1][1], start + length - out[-1][0])
        else:
            out.append([start, length])
    return [(a, n) for a, n in out]


def without_words(text: str, runs: list[tuple[int, int]]) -> str:
    """``text`` less everything from the first to the last word of each run."""
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw)]
    out, at = [], 0
    for start, length in runs:
        out.append(raw[at : places[start][0]])
        at = places[start + length - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_coverage: tuple[int, int] = MAX_COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every row and column of ``docs`` with ``n_words, n_hit, hit_runs, items,
    contaminated`` and ``clean_text`` (written over columns of those names).

    ``hit_runs`` are (start, length) in words; ``items`` the ids, as strings and
    sorted, of items with a window there. A row is contaminated if it is hit and the
    hit words are at least ``max_coverage`` of all; ``clean_text`` is its text
    without any hit run. A null text has no words and stays null. An item of fewer
    words than a window is one window, one without words none; items without an id
    hit, but are not listed.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{item_text}`").alias("t")).distinct()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    out = without(docs, "n_words", "n_hit", "hit_runs", "items", "contaminated", "clean_text")
    added = [T.StructField("n_words", T.LongType()), T.StructField("hit_runs", _SPAN), T.StructField("items", T.ArrayType(T.StringType()))]
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()  # about block_bytes
        automaton = spark.sparkContext.broadcast(build([(r["i"], r["t"]) for r in block], window))
        first = b == 0
        schema = T.StructType([*out.schema.fields, *added]) if first else out.schema
        out = out.mapInArrow(_scanner(automaton, text, first), schema)
    hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda n, r: n + r["length"])
    out = out.withColumn("n_hit", hit)
    out = out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * max_coverage[1] >= F.col("n_words") * max_coverage[0]))

    @F.pandas_udf("string")
    def clean(texts, runs):
        return texts.combine(runs, lambda t, r: without_words(t, [(x["start"], x["length"]) for x in r]) if t is not None and len(r) else t)

    return out.withColumn("clean_text", F.when(F.col("n_hit") > 0, clean(F.col(f"`{text}`"), F.col("hit_runs"))).otherwise(F.col(f"`{text}`")))


def _scanner(automaton, text: str, first: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            old = None if first else list(zip(batch.column(names.index("hit_runs")).to_pylist(), batch.column(names.index("items")).to_pylist(), strict=True))
            counts, runs, items = [], [], []
            for i, t in enumerate(batch.column(names.index(text))):
                words = normal_words(t.as_py())
                hit, found = automaton.value.scan(words)
                found.discard(None)
                if old:
                    hit = _merged([(r["start"], r["length"]) for r in old[i][0]] + hit)
                    found |= set(old[i][1])
                counts.append(len(words))
                runs.append([{"start": a, "length": n} for a, n in hit])
                items.append(sorted(found))
            new = [
                pa.array(counts, pa.int64()),
                pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                pa.array(items, pa.list_(pa.string())),
            ]
            kept = len(names) - (0 if first else 3)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *new], names=[*names[:kept], "n_words", "hit_runs", "items"])

    return scan


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **rule) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    columns = [f"`{c}`" for c in docs.columns]
    whole = F.struct(*[F.col(c) for c in columns]).alias("row")
    marked = contamination(docs.select(whole, F.col(f"`{text}`").alias("text")), benchmark, "text", **rule)
    return marked.where(~F.col("contaminated")).select("row.*")
