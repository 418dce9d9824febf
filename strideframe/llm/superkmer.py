"""Substring dedup by super-k-mers: repeated windows of consecutive words.

A window of ``size`` words is filed under its minimiser, the least hash among its
runs of ``MINIMISER_WORDS`` words. Consecutive windows with one minimiser travel
together as one packed string of word codes, so a bucket gets a run of windows for
little more than the cost of one, and equal windows always meet in one bucket. There
the windows are sorted, and each but its earliest occurrence is reported.

Against skew: a window that occurs again within a task is settled there, and only its
earliest occurrence travels; a minimiser that is frequent everywhere is given up, and
its windows travel one by one under their own hash. Both keep equal windows together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm.common import arrow_rows, cut, slices

WINDOW = 20
MINIMISER_WORDS = 2
#: A minimiser with more than this share of a task's windows is reported as frequent there.
HOT_SHARE = 1 / 2_000
#: Of those, the ones that hold this share of all windows are split; at most 1 / share of them.
SPLIT_SHARE = 1 / 4_000
#: Text bytes that a task looks at together, and whose windows meet in one bucket.
SLICE_BYTES = 8 * 1024 * 1024
BUCKET_BYTES = 8 * 1024 * 1024
#: Buckets in one partition; they are worked on one after the other.
BUCKETS_TOGETHER = 2
LEVEL = 6
#: Words that are hashed at a time, and the bytes up to which they are hashed together.
HASH_WORDS = 1 << 16
SHORT_WORD = 64
#: Bits of the filter that tells which documents lose words, whatever their number.
FILTER_BITS = 1 << 26

_PACKET = T.StructType(
    [
        T.StructField("bucket", T.LongType()),
        T.StructField("packed", T.BinaryType()),
    ]
)
_RUNS = "id long, text_hash long, start long, length long"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _rolling(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive entries, by doubling."""
    done, out, at, have = 0, None, h, 1
    left = size
    while left:
        if left & 1:
            if out is None:
                out, done = at, have
            else:
                n = len(h) - done - have + 1
                out = _mix(out[:n] * _ODD + at[done : done + n])
                done += have
        left >>= 1
        if left:
            n = len(at) - have
            at = _mix(at[:n] * _ODD + at[have : have + n])
            have *= 2
    return out


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    at, have = x, 1
    while have * 2 <= size:
        at = np.minimum(at[: len(at) - have], at[have:])
        have *= 2
    rest = size - have
    return np.minimum(at[: len(at) - rest], at[rest:]) if rest else at


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of binary words, and where each begins and the last one ends."""
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    return np.frombuffer(words.buffers()[2], dtype=np.uint8), ends


def _word_hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word: the sum of one for each byte at its place; long words by xxhash."""
    data, ends = _bytes_of(words)
    out = np.zeros(len(words), dtype=np.uint64)
    for at in range(0, len(words), HASH_WORDS):
        begin, n = ends[at : at + HASH_WORDS + 1][:-1], np.diff(ends[at : at + HASH_WORDS + 1])
        short = np.flatnonzero((n > 0) & (n <= SHORT_WORD))
        if len(short):
            size = n[short]
            place = _gather(np.zeros(len(size), np.int64), size)
            own = _mix((place << 8 | data[_gather(begin[short], size)]).astype(np.uint64) * _ODD)
            out[at + short] = _mix(np.add.reduceat(own, np.cumsum(size) - size) * _ODD + size.astype(np.uint64))
        for i in np.flatnonzero(n > SHORT_WORD).tolist():
            out[at + i] = xxhash.xxh64_intdigest(data[begin[i] : begin[i] + n[i]].tobytes())
    return out


class Words:
    """The words of some documents: exact codes, and a hash for each place."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        flat = lists.flatten()
        real = pc.not_equal(flat, "")
        upto = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        self.ends = upto[ends] if len(ends) else ends
        self.counts = np.diff(self.ends, prepend=0)
        coded = flat.filter(real).dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        self.vocabulary = coded.dictionary.cast(pa.binary())
        self._hash()

    def _hash(self) -> None:
        self.hashes = _word_hashes(self.vocabulary)[self.codes] if len(self.codes) else np.zeros(0, np.uint64)


def _spaced(words: pa.Array) -> pa.Array:
    """Each word with a space behind it."""
    return pc.binary_join_element_wise(words, b"", b" ")


def _joined_words(spaced: pa.Array) -> np.ndarray:
    """The bytes of spaced words, one after the other."""
    data, ends = _bytes_of(spaced)
    return data[ends[0] : ends[-1]]


def _split_words(joined: np.ndarray) -> pa.Array:
    """The spaced words again, without a copy."""
    ends = np.append(0, np.flatnonzero(joined == 32) + 1).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(joined)])


def _windows(words: Words, size: int) -> np.ndarray:
    """Places in the joined documents where a window of ``size`` words begins."""
    n = int(words.ends[-1]) if len(words.ends) else 0
    ok = np.ones(max(n - size + 1, 0), dtype=bool)
    for end in words.ends[:-1].tolist():
        ok[max(end - size + 1, 0) : end] = False
    return np.flatnonzero(ok)


def _minimisers(words: Words, size: int) -> np.ndarray:
    return _sliding_min(_rolling(words.hashes, MINIMISER_WORDS), size - MINIMISER_WORDS + 1)


def _may_repeat(hashes: np.ndarray) -> np.ndarray:
    """Places of hashes that may occur twice: their leading bits are those of one that does."""
    ordered = np.sort(hashes)
    bits = max(len(hashes), 1).bit_length() + 3
    shift = np.uint64(64 - bits)
    marks = np.zeros(1 << bits, dtype=bool)
    marks[ordered[1:][ordered[1:] == ordered[:-1]] >> shift] = True
    return np.flatnonzero(marks[hashes >> shift])


def _repeats(hashes: np.ndarray, places: np.ndarray, codes: np.ndarray, size: int) -> np.ndarray:
    """Which of the windows at ``places`` of ``codes`` equal an earlier one in the list.

    Sorted by hash, equal windows are neighbours; their words are compared, and where
    two windows only share a hash, that group is told apart by the words themselves.
    """
    some = _may_repeat(hashes)
    order = some[np.argsort(hashes[some], kind="stable")]
    ordered = hashes[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    out = np.zeros(len(hashes), dtype=bool)
    later, earlier = order[~new], first[~new]
    same = np.ones(len(later), dtype=bool)
    for k in range(size):
        same &= codes[places[later] + k] == codes[places[earlier] + k]
    out[later] = True
    for h in set(hashes[later[~same]].tolist()):
        seen: set[bytes] = set()
        for i in np.flatnonzero(hashes == np.uint64(h)).tolist():
            window = codes[places[i] : places[i] + size].tobytes()
            out[i] = window in seen
            seen.add(window)
    return out


#: What a packet holds: ids, hashes and null marks of its documents; document, start,
#: windows and whether it travels, of each run; the codes' bytes; the words.
_KINDS = ("<i8", "<i8", "u1", "u1", "u1", "u1", "u1", "u1")


def _planes(numbers: np.ndarray) -> np.ndarray:
    """Four-byte numbers as planes of their first, second, ... bytes."""
    return numbers.reshape(-1).view(np.uint8).reshape(-1, 4).ravel(order="F")


def _from_planes(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").reshape(-1)


def _pack(arrays: list[np.ndarray]) -> bytes:
    arrays = [np.ascontiguousarray(a, dtype=k) for a, k in zip(arrays, _KINDS, strict=True)]
    sizes = np.array([len(a) for a in arrays], dtype="<i8")
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join([sizes.tobytes(), *(a.tobytes() for a in arrays)]))


def _unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    at, out = 8 * len(_KINDS), []
    for n, kind in zip(np.frombuffer(raw, "<i8", len(_KINDS)).tolist(), _KINDS, strict=True):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each span, one span after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


def _joined(at: np.ndarray, doc: np.ndarray, *same: np.ndarray) -> np.ndarray:
    """Where a new run begins: not one place after the one before, or a change in ``same``."""
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
    for x in same:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _by_order(batch: pa.RecordBatch) -> pa.RecordBatch:
    keys = [("id", "ascending", "at_end"), ("text_hash", "ascending", "at_end")]
    return batch.take(pc.sort_indices(batch.select(["id", "text_hash"]), sort_keys=[k[:2] for k in keys], null_placement="at_end"))


def _new(*columns: np.ndarray) -> np.ndarray:
    """Which entries of sorted columns differ from the one before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in columns])
    return new


def _documents(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows by order, equal ones once: they are one document."""
    batch = _by_order(batch)
    ids = batch.column("id")
    keys = (ids.is_null(), ids.fill_null(0), batch.column("text_hash"))
    return batch.filter(pa.array(_new(*(k.to_numpy(zero_copy_only=False) for k in keys))))


def _frequent(size: int, batch: pa.RecordBatch) -> pa.RecordBatch:
    words = Words(batch.column("text"))
    places = _windows(words, size)
    if not len(places):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([0], pa.int64())[:0]], names=["minimiser", "windows", "total"])
    values, counts = np.unique(_minimisers(words, size)[places], return_counts=True)
    hot = counts > max(HOT_SHARE * len(places), 2 * size)
    values = np.append(values[hot].view(np.int64), 0)
    counts = np.append(counts[hot], 0)
    total = np.zeros(len(values), dtype=np.int64)
    total[-1] = len(places)
    return pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64)), pa.array(total)], names=["minimiser", "windows", "total"])


def _send(batch: pa.RecordBatch, size: int, hot: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Packets of the windows that are first in this batch; the others are settled."""
    batch = _documents(batch)
    words = Words(batch.column("text"))
    places = _windows(words, size)
    out: list[tuple[int, bytes]] = []
    if len(places):
        ids = batch.column("id")
        null_id = ids.is_null().to_numpy(zero_copy_only=False)
        id_values = ids.fill_null(0).to_numpy(zero_copy_only=False)
        text_hash = batch.column("text_hash").to_numpy(zero_copy_only=False)
        doc = np.searchsorted(words.ends, places, side="right")
        start = places - (words.ends - words.counts)[doc]
        hashes = _rolling(words.hashes, size)[places]
        again = _repeats(hashes, places, words.codes, size)
        least = _minimisers(words, size)[places]
        alone = np.isin(least, hot)
        home = np.where(alone, hashes, least)
        bucket = (_mix(home) % np.uint64(buckets)).astype(np.int64)

        def spans(pick: np.ndarray, key: np.ndarray):
            begins = _joined(places[pick], doc[pick], key)
            return pick[begins], np.diff(np.append(begins, len(pick)))

        settled, settled_len = spans(np.flatnonzero(again), np.zeros(int(again.sum()), np.int64))
        first = np.flatnonzero(~again)
        moved, moved_len = spans(first, home[first])
        # settled runs ride along in a bucket that their document's text names
        ride = (_mix(text_hash[doc[settled]].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        where = np.concatenate((ride, bucket[moved]))
        kind = np.concatenate((np.zeros(len(settled), bool), np.ones(len(moved), bool)))
        all_at, all_len = np.concatenate((settled, moved)), np.concatenate((settled_len, moved_len))
        spaced = _spaced(words.vocabulary)
        order = np.argsort(where, kind="stable")
        edges = np.flatnonzero(np.diff(where[order], prepend=-1))
        for b, e in zip(edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True):
            own = order[b:e]
            at, n, travels = all_at[own], all_len[own], kind[own]
            span = _gather(places[at[travels]], n[travels] + size - 1)
            codes = words.codes[span]
            # frequent words get small codes, whose high parts compress to nothing
            used, local, often = np.unique(codes, return_inverse=True, return_counts=True)
            rank = np.argsort(-often, kind="stable")
            local = np.argsort(rank)[local]
            docs, d = np.unique(doc[at], return_inverse=True)
            packed = _pack(
                [
                    id_values[docs],
                    text_hash[docs],
                    null_id[docs],
                    _planes(np.stack((d, start[at], n, travels)).astype("<i4")),
                    local & 255,
                    local >> 8 & 255,
                    local >> 16,
                    _joined_words(spaced.take(pa.array(used[rank]))),
                ]
            )
            out.append((int(where[own[0]]), packed))
    return arrow_rows(_PACKET, [[r[0] for r in out], [r[1] for r in out]])


class _Bucket:
    """The packets of one bucket, told apart by exact words."""

    def __init__(self, size: int):
        self.size, self.parts, self.words = size, [], []

    def add(self, data: bytes) -> None:
        ids, hashes, nulls, table, low, middle, high, words = _unpack(data)
        codes = low + 256 * (middle + 256 * high.astype(np.int32))
        self.words.append(_split_words(words))
        self.parts.append((ids, hashes, nulls, _from_planes(table).reshape(4, -1), codes))

    def _common(self) -> tuple[list[np.ndarray], pa.Array]:
        """The codes of each packet as codes of the bucket's words, and those words."""
        coded = pa.concat_arrays(self.words).dictionary_encode()
        common = coded.indices.to_numpy(zero_copy_only=False)
        begin = np.cumsum([0, *map(len, self.words)])
        return [common[codes + at] for (*_, codes), at in zip(self.parts, begin.tolist(), strict=False)], coded.dictionary

    def runs(self) -> pa.RecordBatch:
        """Runs of windows that are not the earliest of their kind."""
        size = self.size
        cols: dict[str, list[np.ndarray]] = {k: [] for k in ("id", "hash", "null", "start", "n", "codes")}
        done: list[tuple] = []
        known, vocabulary = self._common()
        for (ids, hashes, nulls, (d, start, n, travels), _), codes in zip(self.parts, known, strict=True):
            go = travels == 1
            done.append((ids[d[~go]], hashes[d[~go]], nulls[d[~go]], start[~go], n[~go]))
            for k, v in zip(cols, (ids[d[go]], hashes[d[go]], nulls[d[go]], start[go], n[go], codes), strict=True):
                cols[k].append(v)
        c = {k: np.concatenate(v) for k, v in cols.items()}
        if len(c["n"]):
            known = _word_hashes(vocabulary)
            length = c["n"].astype(np.int64) + size - 1
            begin = np.cumsum(length) - length
            codes = c["codes"]
            places = _gather(begin, c["n"].astype(np.int64))
            hashes = _rolling(known[codes], size)[places]
            # windows that stand alone need no order
            some = _may_repeat(hashes)
            hashes, places = hashes[some], places[some]
            span = np.repeat(np.arange(len(begin)), c["n"])[some]
            start = c["start"][span] + (places - begin[span])
            keys = (start, c["hash"][span], c["id"][span], c["null"][span])
            order = np.lexsort(keys)
            # equal rows of other slices are the same document, not an earlier one
            order = order[_new(*(k[order] for k in keys))]
            again = order[_repeats(hashes[order], places[order], codes, size)]
            again.sort()
            cuts = _joined(places[again], span[again])
            at, n = again[cuts], np.diff(np.append(cuts, len(again)))
            s = span[at]
            done.append((c["id"][s], c["hash"][s], c["null"][s], start[at], n))
        ids, hashes, nulls, start, n = (np.concatenate(x) for x in zip(*done, strict=True))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids.astype(np.int64), mask=nulls.astype(bool)),
                pa.array(hashes.astype(np.int64)),
                pa.array(start.astype(np.int64)),
                pa.array(n.astype(np.int64)),
            ],
            names=["id", "text_hash", "start", "length"],
        )


def repeated_windows(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """``id, text_hash, start, length``: runs of windows (by their first word) whose
    words also start earlier: under a smaller id, or earlier in the same document.

    Null ids come last; rows of one id are ordered by the hash of their text, and
    equal rows are one document. ``id`` must be an integer column.
    """
    base = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    base = base.select("id", F.xxhash64("text").alias("text_hash"), "text")

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE_BYTES):
            yield _frequent(size, part)

    seen = cut(base.select("text").mapInArrow(frequent, "minimiser long, windows long, total long"), "frequent-minimisers")
    total = seen.agg(F.sum("total")).first()[0] or 0
    # each counted minimiser has more than the share, so there are at most 1 / share of them
    often = seen.where("windows > 0").groupBy("minimiser").agg(F.sum("windows").alias("n")).where(F.col("n") > SPLIT_SHARE * total)
    hot = np.array([r[0] for r in often.select("minimiser").collect()], dtype=np.int64).view(np.uint64)
    text_bytes = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, math.ceil(text_bytes / BUCKET_BYTES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE_BYTES):
            yield _send(part, size, hot, buckets)
            pa.default_memory_pool().release_unused()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bucket = None, _Bucket(size)
        for batch in batches:
            for number, data in zip(*batch.columns, strict=True):
                if number.as_py() != now and bucket.parts:
                    yield bucket.runs()
                    bucket = _Bucket(size)
                now = number.as_py()
                bucket.add(data.as_py())
        if bucket.parts:
            yield bucket.runs()

    packets = base.mapInArrow(send, _PACKET)
    # every partition gets as many buckets as any other, but for one
    tasks = math.ceil(buckets / BUCKETS_TOGETHER)
    dealt = packets.repartitionById(tasks, F.expr(f"cast(bucket % {tasks} AS int)"))
    return dealt.sortWithinPartitions("bucket").mapInArrow(meet, _RUNS)


def covered(runs: list[tuple[int, int]], n_words: int, size: int = WINDOW) -> np.ndarray:
    """Which words lie in a window of ``runs`` (start, length)."""
    delta = np.zeros(n_words + 1, dtype=np.int64)
    for start, length in runs:
        delta[start] += 1
        delta[min(start + length + size - 1, n_words)] -= 1
    return np.cumsum(delta[:-1]) > 0


class _Filter:
    """Which documents may have runs: a Bloom filter of fixed size. Where it errs, a text
    travels for nothing; a document with runs is never missed."""

    def __init__(self, runs: DataFrame):
        places = [F.pmod(F.xxhash64("id", "text_hash", F.lit(k)), F.lit(FILTER_BITS)).alias("place") for k in range(2)]
        bits = runs.select(F.explode(F.array(*places)).alias("place"))
        words = bits.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 AS int))")).alias("bits"))
        rows = words.toArrow()  # FILTER_BITS / 64 rows at most
        self.bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
        self.bits[rows["word"].to_numpy()] = rows["bits"].to_numpy()

    def may_hold(self, *places: np.ndarray) -> np.ndarray:
        out = np.ones(len(places[0]), dtype=bool)
        for p in places:
            out &= self.bits[p >> 6] >> (p & 63) & 1 == 1
        return out


def _placed(base: DataFrame) -> DataFrame:
    places = [F.pmod(F.xxhash64("id", "text_hash", F.lit(k)), F.lit(FILTER_BITS)).alias(f"place{k}") for k in range(2)]
    return base.select("id", "text_hash", "text", *places)


_LEFT = "id long, n_words long, n_removed long, text string"


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """``id, n_words, n_removed, text`` for each row: what is left of its words, joined by
    one space, after every word in a repeated window is gone.

    Null and empty texts have no words; texts under ``size`` words lose none. Repeated
    rows give repeated rows.
    """
    runs = repeated_windows(docs, id, text, size).groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "length")).alias("runs"))
    runs = cut(runs, "repeated-windows")
    filtered = docs.sparkSession.sparkContext.broadcast(_Filter(runs))  # FILTER_BITS
    base = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    base = _placed(base.select("id", F.xxhash64("text").alias("text_hash"), "text"))

    def may(batch: pa.RecordBatch) -> np.ndarray:
        return filtered.value.may_hold(*(batch.column(f"place{k}").to_numpy() for k in range(2)))

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch.filter(pa.array(~may(batch)))]):
                yield _strip(part.column("id"), part.column("text"), [None] * part.num_rows, size)

    def travelling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may(batch))).select(["id", "text_hash", "text"])

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield _strip(part.column("id"), part.column("text"), part.column("runs").to_pylist(), size)

    gone = runs.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), "runs")
    moved = base.mapInArrow(travelling, "id long, text_hash long, text string")
    joined = moved.join(gone, moved["id"].eqNullSafe(gone["_id"]) & (moved["text_hash"] == gone["_hash"]), "left")
    left = joined.select("id", "text", "runs").mapInArrow(strip, _LEFT)
    return base.mapInArrow(untouched, _LEFT).unionByName(left).withColumnRenamed("id", id)


def _strip(ids: pa.Array, texts: pa.Array, runs: list, size: int) -> pa.RecordBatch:
    words = [t.encode().split() for t in texts.to_pylist()]
    lost, left = [], []
    for own, doc_runs in zip(words, runs, strict=True):
        if doc_runs:
            gone = covered([(r["start"], r["length"]) for r in doc_runs], len(own), size)
            lost.append(int(gone.sum()))
            own = [w for w, g in zip(own, gone.tolist(), strict=True) if not g]
        else:
            lost.append(0)
        left.append(b" ".join(own).decode())
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([len(w) for w in words], pa.int64()), pa.array(lost, pa.int64()), pa.array(left, pa.string())],
        names=["id", "n_words", "n_removed", "text"],
    )
