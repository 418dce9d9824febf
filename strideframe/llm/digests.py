"""SHA-256 over the ordered rows of a group, for groups of any size."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of consecutive rows that are joined into one piece before they travel to the hash.
PIECE_BYTES = 1024 * 1024


def ordered_sha256(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, separator: str, out: str = "sha256", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``keys, out``: the lowercase SHA-256 of each group's ``value`` strings, in ``order``,
    joined by ``separator``. Null values count as empty; null keys are a group of their own.

    A group may hold a third of all rows. Rows are range-partitioned by key and order, which
    cuts such a group into many parts. A group that begins and ends within a part is hashed
    there; only a part's first and last groups may go on elsewhere, and their rows are joined
    into pieces of at most ``piece_bytes`` (or one longer row). The hash itself is sequential by
    its definition: one task reads such a group's pieces in order and holds one piece at a time.
    Tied rows of a group come in any order, so ``order`` should leave none that differ. What is
    behind ``rows`` runs once more for the range bounds; end it in a shuffle or a written table.
    """
    keys, order = list(keys), list(order)
    told = rows.select(*keys, *order, F.coalesce(F.col(value), F.lit("")).cast("binary").alias("_piece"))
    sep, at = separator.encode(), [*keys, *order]
    names = [*at, "_piece", "_whole"]
    layout = T.StructType([*(T.StructField(f.name, f.dataType) for f in told.schema), T.StructField("_whole", T.StringType())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, parts, size, state, shape = None, None, [], 0, None, None
        done: list[tuple] = []
        for batch in batches:
            shape = batch.schema
            for *place, piece in zip(*(batch.column(n).to_pylist() for n in names[:-1]), strict=True):
                if place[: len(keys)] != key:
                    if state is not None:  # neither the first group nor the last
                        done.append((*first, None, state.hexdigest()))
                    elif parts:
                        done.append((*first, sep.join(parts), None))
                    # the last group is told from the others at the end only: it keeps its
                    # pieces until it outgrows one, and goes on in pieces from there
                    state = hashlib.sha256() if key is not None else None
                    key, first, parts, size = place[: len(keys)], place, [], 0
                elif size + len(piece) > piece_bytes:
                    done.append((*first, sep.join(parts), None))
                    first, parts, size, state = place, [], 0, None
                if state is not None:
                    state.update(sep + piece if parts else piece)
                parts.append(piece)
                size += len(piece) + len(sep)
            if done:
                yield _batch(done, names, shape)
                done = []
        if parts:
            yield _batch([(*first, sep.join(parts), None)], names, shape)

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, shape = None, None, None
        for batch in batches:
            shape, done = batch.schema, []
            for *own, piece, whole in zip(*(batch.column(n).to_pylist() for n in [*keys, "_piece", "_whole"]), strict=True):
                if whole is not None:
                    done.append((*own, whole))
                    continue
                if state is not None and own == key:
                    state.update(sep)
                else:
                    if state is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256()
                state.update(piece)
            if done:
                yield _hashes(done, keys, shape, out)
        if state is not None:
            yield _hashes([(*key, state.hexdigest())], keys, shape, out)

    pieces = told.repartitionByRange(*at).sortWithinPartitions(*at).mapInArrow(join, layout)
    joined = pieces.repartition(*keys).sortWithinPartitions(*at)
    return joined.mapInArrow(hash_all, T.StructType([*(layout[k] for k in keys), T.StructField(out, T.StringType())]))


def _batch(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=pa.string() if n == "_whole" else pa.binary() if n == "_piece" else schema.field(n).type) for n, c in zip(names, columns, strict=True)],
        names=names,
    )


def _hashes(rows: list[tuple], keys: list[str], schema: pa.Schema, out: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    types = [*(schema.field(k).type for k in keys), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=[*keys, out])
