"""Sum-of-squares online packing of tokenised documents into fixed windows.

Each task packs its own documents as they come. Full windows are cut off a document
first; the rest goes whole into one of the open windows or a new one: into the fill
level for which the sum of the squared counts of open windows at each level becomes
least. The counts are a level array of one entry for each possible fill.

When a task's documents are through, the windows still open are emptied into each
other, emptiest first, with cuts where a piece does not fit, so that a task leaves at
most one window that needs padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm.common import slices
from strideframe.llm.tokens import ENCODED_BYTES, ByWord, encoder

WINDOW = 4096
END_ID = 2
#: Sequence ids of one task; a task's number is in the bits above.
TASK_BITS = 36

#: doc place, start in the document, length
Piece = tuple[int, int, int]


class SumOfSquares:
    """Open windows by fill level."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(window)]

    def level(self, size: int) -> int:
        """The fill level to put ``size`` tokens on; 0 opens a window.

        Moving a window from level h to h + size changes the sum of squares by
        2 (N[h + size] - N[h]) + 2; opening one, by 2 N[size] + 1; filling one up,
        by 1 - 2 N[h]. Of equal changes the fullest level wins.
        """
        n, top = self.counts, self.window - size
        change = 2 * (n[size : self.window + 1] - n[: top + 1]) + 2
        change[top] = 1 - 2 * n[top]
        change[1:][n[1 : top + 1] == 0] = np.iinfo(np.int64).max
        change[0] = 2 * n[size] + 1 if size < self.window else 0
        return top - int(np.argmin(change[::-1]))

    def add(self, piece: Piece) -> list[Piece] | None:
        """Place a piece; the window comes back when it is full."""
        size = piece[2]
        if size >= self.window:
            return [piece]
        h = self.level(size)
        own = self.open[h].pop() if h else []
        if h:
            self.counts[h] -= 1
        own.append(piece)
        if h + size == self.window:
            return own
        self.open[h + size].append(own)
        self.counts[h + size] += 1
        return None

    def close(self) -> Iterator[list[Piece]]:
        """Empty the open windows into each other, emptiest into fullest."""
        left = [(h, own) for h in range(self.window - 1, 0, -1) for own in self.open[h]]
        self.open = [[] for _ in range(self.window)]
        self.counts[:] = 0
        while left:
            fill, own = left.pop(0)
            while fill < self.window and left:
                h, other = left[-1]
                doc, start, n = other.pop()
                take = min(n, self.window - fill)
                own.append((doc, start, take))
                fill += take
                if take < n:
                    other.append((doc, start + take, n - take))
                h -= take
                if h:
                    left[-1] = (h, other)
                else:
                    left.pop()
            yield own


def padding(used: int, window: int = WINDOW) -> int:
    """Tokens of padding in a sequence of ``used`` tokens; none at a power of two."""
    return 0 if used & (used - 1) == 0 else window - used


_PIECES = "id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, rule: type = ByWord) -> DataFrame:
    """One row for each piece: ``id, start, length, ids`` (little-endian unsigned 32
    bits), ``doc_tokens, sequence_id, offset``.

    ``tokenizer`` is a path that every executor can read. Each row of ``docs`` is a
    document: its ids and ``end_id``; null and empty texts have that one only. Rows with
    equal or null ids are documents of their own. A sequence holds documents of one
    task, so a task that runs again makes whole sequences again.
    """
    kind = dict(docs.dtypes)[id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, rule).encode
        levels = SumOfSquares(window)
        waiting: dict[int, tuple[object, np.ndarray, int]] = {}
        sequence = TaskContext.get().partitionId() << TASK_BITS
        done: list[list[Piece]] = []
        seen = 0

        def rows(ids_type: pa.DataType) -> pa.RecordBatch:
            nonlocal sequence
            cols: list[list] = [[] for _ in range(7)]
            for own in done:
                at = 0
                for doc, start, n in own:
                    name, ids, open_tokens = waiting[doc]
                    for c, v in zip(cols, (name, start, n, ids[start : start + n].tobytes(), len(ids), sequence, at), strict=True):
                        c.append(v)
                    at += n
                    if open_tokens == n:
                        del waiting[doc]
                    else:
                        waiting[doc] = (name, ids, open_tokens - n)
                sequence += 1
            done.clear()
            kinds = [ids_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=_NAMES)

        ids_type = None
        for batch in slices(batches, limit=ENCODED_BYTES):
            ids_type = batch.column("id").type
            flat, counts = encode(batch.column("text"))
            ends = np.cumsum(counts)
            for name, b, e in zip(batch.column("id").to_pylist(), (ends - counts).tolist(), ends.tolist(), strict=True):
                ids = np.append(flat[b:e], np.uint32(end_id)).astype("<u4")
                waiting[seen] = (name, ids, len(ids))
                whole = len(ids) // window * window
                done += [[(seen, at, window)] for at in range(0, whole, window)]
                if len(ids) > whole and (full := levels.add((seen, whole, len(ids) - whole))):
                    done.append(full)
                seen += 1
            yield rows(ids_type)
        if ids_type is not None:
            done += levels.close()
            yield rows(ids_type)

    named = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return named.mapInArrow(run, _PIECES.format(id=kind)).withColumnRenamed("id", id)


_NAMES = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def crc32_of(ids: bytes) -> int:
    return zlib.crc32(ids)
