"""Token files in bit planes.

Ids are written in document order. A shard is a row of a table that Spark writes (so
it commits whole or not at all): some whole documents, their ids in blocks of
``BLOCK_IDS``. A block is transposed into planes, the first plane holding every id's
lowest byte (or bit), and each plane is compressed by itself with zstandard. The shard
keeps an index of its chunks: the first id of each block and the place of each plane.

Shards are read on their own, without a shuffle; where a shard begins in the whole
token stream follows from the totals of the shards before.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strideframe.llm.common import cut, slices
from strideframe.llm.tokens import ENCODED_BYTES, BySpace, encoder

BLOCK_IDS = 65_536
#: A shard ends with the document that brings it to so many ids.
SHARD_IDS = 1 << 20
END_ID = 2
LEVEL = 3

_SHARD = (
    "part int, shard int, n_ids long, doc_ids array<{id}>, doc_tokens array<long>, "
    "planes int, block_starts array<long>, chunk_offsets array<long>, chunks binary"
)


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Byte planes (4) or bit planes (32) of a block of unsigned 32-bit ids."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        raw = np.unpackbits(raw, axis=1, bitorder="little")
        return [np.packbits(raw[:, k], bitorder="little").tobytes() for k in range(32)]
    return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    if len(planes) == 4:
        return np.column_stack([np.frombuffer(p, np.uint8, n) for p in planes]).reshape(-1).view("<u4")
    bits = [np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes]
    return np.packbits(np.column_stack(bits), axis=1, bitorder="little").reshape(-1).view("<u4")


def encode_shard(ids: np.ndarray, block: int = BLOCK_IDS, bits: bool = False) -> tuple[int, list[int], list[int], bytes]:
    """Number of planes, first id of each block, offsets of all chunks, and the chunks."""
    zip_ = zstandard.ZstdCompressor(level=LEVEL)
    starts = list(range(0, len(ids), block))
    chunks = [zip_.compress(p) for s in starts for p in to_planes(ids[s : s + block], bits)]
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in chunks])]).astype(np.int64).tolist()
    return 32 if bits else 4, starts, offsets, b"".join(chunks)


def read_block(k: int, n_ids: int, planes: int, starts: list[int], offsets: list[int], chunks: bytes) -> np.ndarray:
    """Block ``k`` of a shard, found by its index alone."""
    end = starts[k + 1] if k + 1 < len(starts) else n_ids
    unzip = zstandard.ZstdDecompressor()
    own = offsets[k * planes : (k + 1) * planes + 1]
    return from_planes([unzip.decompress(chunks[a:b]) for a, b in pairwise(own)], end - starts[k])


def decode_shard(n_ids: int, planes: int, starts: list[int], offsets: list[int], chunks: bytes) -> np.ndarray:
    blocks = [read_block(k, n_ids, planes, starts, offsets, chunks) for k in range(len(starts))]
    return np.concatenate(blocks) if blocks else np.zeros(0, "<u4")


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    rule: type = BySpace,
    block: int = BLOCK_IDS,
    shard_ids: int = SHARD_IDS,
    bits: bool = False,
) -> None:
    """Write the token file of ``docs`` at ``path`` in ascending ``id`` order.

    Null ids come first; rows with equal ids are ordered by the hash of their text.
    Null and empty texts have the end id only. An empty table writes no shard.
    """
    kind = dict(docs.dtypes)[id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer, rule).encode
        names: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        held_ids = 0

        def row(id_type: pa.DataType) -> pa.RecordBatch:
            planes, starts, offsets, chunks = encode_shard(np.concatenate(held), block, bits)
            values = (part, shard, held_ids, names, sizes, planes, starts, offsets, chunks)
            longs = pa.list_(pa.int64())
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(id_type), longs, pa.int32(), longs, longs, pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=_COLUMNS)

        for batch in slices(batches, limit=ENCODED_BYTES):
            id_type = batch.column("id").type
            flat, counts = encode(batch.column("text"))
            ends = np.cumsum(counts)
            ids = np.insert(flat, ends, np.uint32(end_id))
            counts, ends = counts + 1, ends + np.arange(1, len(ends) + 1)
            all_names, begin = batch.column("id").to_pylist(), 0
            while begin < len(ends):
                before = int(ends[begin] - counts[begin])
                # up to and with the document that fills the shard
                full = int(np.searchsorted(ends, before + shard_ids - held_ids)) + 1
                upto = min(full, len(ends))
                held.append(ids[before : ends[upto - 1]])
                held_ids += len(held[-1])
                names += all_names[begin:upto]
                sizes += counts[begin:upto].tolist()
                begin = upto
                if held_ids >= shard_ids:
                    yield row(id_type)
                    names, sizes, held, held_ids, shard = [], [], [], 0, shard + 1
        if held:
            yield row(id_type)

    named = docs.select(F.col(f"`{id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"), F.col(f"`{text}`").alias("text"))
    # texts travel, once; their ids go from the tokenizer straight into the file
    ranged = named.repartitionByRange("id", "text_hash").sortWithinPartitions("id", "text_hash")
    ranged.select("id", "text").mapInArrow(run, _SHARD.format(id=kind)).write.option("compression", "uncompressed").parquet(path)


_COLUMNS = ["part", "shard", "n_ids", "doc_ids", "doc_tokens", "planes", "block_starts", "chunk_offsets", "chunks"]


def shard_offsets(shards: DataFrame) -> DataFrame:
    """``part, shard, first``: ids before each shard. The first window is over one row
    for each part, the second within a part."""
    sizes = shards.select("part", "shard", "n_ids")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = W.partitionBy("part").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    inside = sizes.select("part", "shard", F.coalesce(F.sum("n_ids").over(own), F.lit(0)).alias("inside"))
    return inside.join(parts, "part").select("part", "shard", (F.col("base") + F.col("inside")).alias("first"))


def read_tokens(spark, path: str, id: str = "doc_id") -> DataFrame:
    """``id, start, n_tokens, ids`` of each document in a token file: its place in the
    whole stream, and its ids as little-endian unsigned 32 bits."""
    shards = spark.read.parquet(path)
    kind = dict(shards.dtypes)["doc_ids"][len("array<") : -1]
    placed = shards.join(cut(shard_offsets(shards), "shard-offsets"), ["part", "shard"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r].as_py() for n in batch.schema.names if n != "doc_ids"}
                ids = decode_shard(row["n_ids"], row["planes"], row["block_starts"], row["chunk_offsets"], row["chunks"])
                n = np.array(row["doc_tokens"], dtype=np.int64)
                ends = np.cumsum(n)
                raw = ids.astype("<u4").tobytes()
                own = [raw[4 * a : 4 * b] for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
                names = batch.column(batch.schema.names.index("doc_ids"))[r].values
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(row["first"] + ends - n), pa.array(n), pa.array(own, pa.binary())], names=["id", "start", "n_tokens", "ids"]
                )

    return placed.mapInArrow(run, f"id {kind}, start long, n_tokens long, ids binary").withColumnRenamed("id", id)
