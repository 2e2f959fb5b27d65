"""Documents as token pieces: rows that no sequence length cuts again."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clusterprep.llm.arrays import slabs
from clusterprep.llm.rows import map_arrow, picked
from clusterprep.llm.tokens import word_encoder

END_ID = 0  # follows each document

# Text bytes encoded together: different words are merged once for all of them.
TOGETHER = 1 << 21


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; all but the last are full."""
    return [(s, min(capacity, length - s)) for s in range(0, length, capacity)]


def _texts(slab: pa.RecordBatch) -> Iterator[str]:
    """The texts, of which few are strings at a time."""
    for few in slabs([slab], "text"):
        for text in few.column("text").to_pylist():
            yield text or ""


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: key, doc_id, piece, start, length, ids_crc32 (and ids).

    `key` is unique within a run over the same partitions; write the rows
    before using it twice. `ids` are little-endian unsigned 32-bit integers. A
    null text is empty and has the end id only; longer documents are cut
    without loss.
    """
    rows = picked(docs, doc_id=id_col, text=text_col)
    names = ["key", "doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        key = TaskContext.get().partitionId() << 40
        for slab in slabs(batches, "text", TOGETHER):
            encoded = word_encoder(vocabulary).encode(_texts(slab))
            of, piece, start, length, crc, raw = [], [], [], [], [], []
            for n, ids in enumerate(encoded):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for k, (at, size) in enumerate(cut(len(ids), capacity)):
                    own = ids[at : at + size].tobytes()
                    of.append(n)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(own))
                    if with_ids:
                        raw.append(own)
            columns = [
                pa.array(range(key, key + len(of)), pa.int64()),
                slab.column("doc_id").take(pa.array(of, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ] + ([pa.array(raw, pa.binary())] if with_ids else [])
            key += len(of)
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = [
        T.StructField("key", T.LongType()),
        rows.schema["doc_id"],
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ] + ([T.StructField("ids", T.BinaryType())] if with_ids else [])
    return map_arrow(rows, run, T.StructType(fields))
