"""SimHash near-duplicates with pigeonring filtering.

Fingerprints are cut into five segments on a ring. If two of them differ in at most
four bits, there is a segment from which every chain of l consecutive segments differs
in at most floor(4 l / 5) bits: 0, 1, 2, 3, 4. The first two steps of such a chain
become a key (equal segment, next segment within one bit), so that fingerprints meet
only where a chain can start; the longer chains prune what met, before the full
distance is taken.

Only distinct fingerprints are compared, so copies cost one row each. Within a key,
members are visited breadth first and only the links of a spanning forest come out,
never all pairs; a dense group is used up after a few visits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strideframe.llm.common import cut, free_name, without
from strideframe.llm.graph import connected_components

SEED = 42
SHINGLE = 4
MAX_DISTANCE = 4
#: Bits of each segment, from bit 0 up.
SEGMENTS = (13, 13, 13, 13, 12)
OFFSETS = tuple(sum(SEGMENTS[:i]) for i in range(len(SEGMENTS)))


def budgets(distance: int = MAX_DISTANCE, segments: int = len(SEGMENTS)) -> list[int]:
    """Most differing bits of a chain of 1, 2, ... segments."""
    return [distance * length // segments for length in range(1, segments + 1)]


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of word shingles, as a signed integer; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return _signed(xxhash.xxh64_intdigest(b" ".join(words), seed))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([digest(line[a:b], seed) for a, b in spans], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def with_fingerprint(docs: DataFrame, text: str = "text", fingerprint: str = "fingerprint", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Add the SimHash of ``text`` as a signed 64-bit column, written over one of that name.

    Null and empty texts have fingerprint 0.
    """

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle, seed) for t in texts], dtype="int64")

    value = prints(F.col(f"`{text}`"))
    return without(docs, fingerprint).select("*", value.alias(fingerprint)) if fingerprint != text else docs.withColumn(text, value)


def _segment(i: int):
    mask = (1 << SEGMENTS[i]) - 1
    return F.shiftrightunsigned("fp", OFFSETS[i]).bitwiseAND(F.lit(mask))


def chain_keys(prints: DataFrame) -> DataFrame:
    """``key, fp``: where chains of ``fp`` may start.

    Two segments one bit apart have different parity, so only the even one is put
    under the keys of its neighbours; equal segments meet under their own key.
    """
    keys = []
    for i in range(len(SEGMENTS)):
        j = (i + 1) % len(SEGMENTS)
        head = F.lit(i << 26).cast("long") + F.shiftleft(_segment(i), 13)
        after = _segment(j)
        even = F.bit_count(after) % 2 == 0
        keys.append(head + after)
        keys += [F.when(even, head + after.bitwiseXOR(F.lit(1 << b))) for b in range(SEGMENTS[j])]
    return prints.select("fp", F.explode(F.array(*keys)).alias("key")).where("key IS NOT NULL")


def _chain_masks() -> list[list[np.uint64]]:
    whole = [((1 << w) - 1) << o for w, o in zip(SEGMENTS, OFFSETS, strict=True)]
    n = len(SEGMENTS)
    return [[np.uint64(sum(whole[(i + k) % n] for k in range(length))) for length in range(2, n + 1)] for i in range(n)]


_MASKS = _chain_masks()
_BUDGETS = budgets()


def linked(x: np.ndarray, start) -> np.ndarray:
    """Which differences ``x`` keep within every chain budget from segment ``start`` on."""
    ok = np.ones(len(x), dtype=bool)
    for mask, most in zip(_MASKS[start], _BUDGETS[1:], strict=True):
        ok &= np.bitwise_count(x & mask) <= most
    return ok


def _forest(members: np.ndarray, start: int, out: list) -> None:
    """Links of a spanning forest of ``members`` under :func:`linked`."""
    left = members
    while len(left) > 1:
        waiting, left = [left[0]], left[1:]
        while waiting and len(left):
            x = waiting.pop()
            near = linked(left ^ x, start)
            if near.any():
                found = left[near]
                out.append((np.full(len(found), x), found))
                waiting.extend(found)
                left = left[~near]


def _links(keys: np.ndarray, prints: np.ndarray) -> list:
    """Links within the groups of equal neighbours in ``keys``."""
    edges = np.flatnonzero(np.diff(keys)) + 1
    begins, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(keys)]))
    sizes = ends - begins
    out: list = []
    two = begins[sizes == 2]
    for i in range(len(SEGMENTS)):
        at = two[keys[two] >> 26 == i]
        near = at[linked(prints[at] ^ prints[at + 1], i)]
        out.append((prints[near], prints[near + 1]))
    for b, e in zip(begins[sizes > 2].tolist(), ends[sizes > 2].tolist(), strict=True):
        _forest(prints[b:e], int(keys[b] >> 26), out)
    return out


def _link_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each key; rows come sorted by key, and a key may span batches."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def closed(parts):
        keys, prints = (np.concatenate(x) for x in zip(*parts, strict=True))
        a, b = (np.concatenate(x).astype(np.int64) for x in zip(*_links(keys, prints), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_numpy()
        prints = batch.column("fp").to_numpy().view(np.uint64)
        if keys[0] == keys[-1]:
            if held and held[-1][0][-1] != keys[0]:
                yield closed(held)
                held = []
            held.append((keys, prints))
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        yield closed([*held, (keys[:last], prints[:last])])
        held = [(keys[last:], prints[last:])]
    if held:
        yield closed(held)


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """``u, v``: links that connect all fingerprints ``fp`` (distinct) reachable from
    each other in steps of at most four bits."""
    keys = chain_keys(prints)
    sorted_keys = keys.repartition("key").sortWithinPartitions("key")
    return sorted_keys.mapInArrow(_link_sorted, "u long, v long").distinct()


def _with_component(docs: DataFrame, id: str, text: str, *more: Column) -> DataFrame:
    """``id, fp, root_fp, component_id`` of each row, and ``more`` of its columns."""
    marked = with_fingerprint(docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), *more), "text", "fp")
    marked = cut(marked.drop("text"), "fingerprints")
    prints = cut(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    roots = cut(connected_components(fingerprint_links(prints.select("fp"))), "fingerprint-roots")
    least = roots.join(prints, roots["node"] == prints["fp"]).groupBy("root").agg(F.min("least").alias("component"))
    moved = roots.join(least, "root").select(F.col("node").alias("fp"), "root", "component")
    component = prints.join(moved, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root_fp"), F.coalesce("component", "least").alias("component_id"))
    return marked.join(component, "fp")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: ``id, fingerprint`` (16 hex digits) and ``component_id``,
    the smallest id reachable over fingerprints at most four bits apart.

    Texts without words, null ones too, have fingerprint zero and are linked like any
    other. Repeated rows give repeated rows. A null id takes part, but is never the
    smallest unless its component has no other.
    """
    return _with_component(docs, id, text).select(
        F.col("id").alias(id),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without near-duplicates: of each component one row stays, that with the
    smallest id, and of several rows under that id the one whose text's hash sorts first.

    All columns stay. Of equal rows one stays. An id may stand for several unlike texts, and
    each is kept or dropped by its own component. Rows whose id is null cannot be told
    apart by it and all stay.
    """
    place, hashed = free_name(docs, "row_of_text"), free_name(docs, "hash_of_text")
    text_hash = F.xxhash64(F.col(f"`{text}`"))
    rows = _with_component(docs, id, text, text_hash.alias("text_hash")).where("id IS NOT NULL")
    # a component is named by a fingerprint: two may have the same least id
    first = rows.groupBy("root_fp").agg(F.min(F.struct("id", "text_hash")).alias("first")).select(F.col("first.id").alias(id), F.col("first.text_hash").alias(hashed))
    named = docs.where(F.col(f"`{id}`").isNotNull()).withColumn(hashed, text_hash)
    named = named.join(first, [id, hashed], "left_semi")
    order = W.partitionBy(f"`{id}`", hashed).orderBy(hashed)
    named = named.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return named.select(*[f"`{c}`" for c in docs.columns]).unionByName(docs.where(F.col(f"`{id}`").isNull()))
