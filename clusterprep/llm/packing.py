"""Packed id matrices by best-fit-decreasing with a segment tree over capacities.

Each partition is packed as it streams by, without a shuffle: texts become
token ids with an end id, longer ones are cut without loss, and whenever about
`BUFFER` tokens have gathered the pieces are placed, longest first, each into
the open sequence with the least room that holds it. That room is found by
descending a segment tree whose leaves count the open sequences of each room.
Then all sequences but the `OPEN` emptiest are written; the rest stay open for
the pieces to come, so a partition ends with a few partly filled sequences
only. A task holds one buffer, whatever the partition's size.

A row of the result is one row of the id matrix with its borders: ids padded
to the full width, cumulative lengths of the segments, and positions that
start again with each segment. Binary columns are little-endian unsigned
integers, of 16 bits where ids and positions fit.

A null or empty text is a single end id. Repeated rows are packed like other
rows. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterprep.llm.arrays import slabs
from clusterprep.llm.rows import map_arrow, picked
from clusterprep.llm.token_pieces import cut
from clusterprep.llm.tokens import byte_encoder

WIDTH = 2048
BUFFER = 1 << 20
OPEN = 64


class CapacityTree:
    """How many sequences have each room, with a search for the least room that is enough."""

    def __init__(self, most: int):
        self._leaves = 1 << most.bit_length()
        self._count = [0] * (2 * self._leaves)

    def add(self, room: int, change: int = 1) -> None:
        node = self._leaves + room
        while node:
            self._count[node] += change
            node >>= 1

    def at_least(self, need: int) -> int | None:
        """The least room of any sequence that is `need` or more."""
        count, node = self._count, self._leaves + need
        # Up to the first ancestor with something in or right of the leaf, then down to its left.
        while not count[node]:
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self._leaves:
            node *= 2
            node += not count[node]
        return node - self._leaves


class Packer:
    """Sequences of one partition that are still open."""

    def __init__(self, width: int):
        self.width = width
        self.tree = CapacityTree(width)
        self.by_room: dict[int, list[list]] = {}

    def place(self, piece: tuple) -> None:
        """Add a piece, whose last field is its ids, to the best open sequence or a new one."""
        need = len(piece[-1])
        room = self.tree.at_least(need)
        if room is None:
            sequence: list = []
            room = self.width
        else:
            sequence = self.by_room[room].pop()
            self.tree.add(room, -1)
        sequence.append(piece)
        self.by_room.setdefault(room - need, []).append(sequence)
        self.tree.add(room - need)

    def take(self, keep: int) -> list[list]:
        """Remove all sequences but the `keep` emptiest, fullest first."""
        total = sum(map(len, self.by_room.values()))
        taken: list[list] = []
        for room in sorted(self.by_room):
            while self.by_room[room] and (len(taken) < total - keep or not room):
                taken.append(self.by_room[room].pop())
                self.tree.add(room, -1)
        return taken


def _unsigned(values: int) -> str:
    return "<u2" if values <= 1 << 16 else "<u4"


def pack(
    docs: DataFrame,
    vocabulary: str,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per sequence; `vocabulary` is the path of a file of byte-level ranks.

    sequence_id, n_tokens, ids and position_ids (binary, `width` values),
    cu_seqlens (0, then the end of each segment), and for each segment its
    document, the number of the piece and the piece's first token there.
    """
    rows = picked(docs, doc_id=id_col, text=text_col)
    id_type = rows.schema["doc_id"].dataType

    def run(batches):
        encoder = byte_encoder(vocabulary)
        kind, place_kind = _unsigned(encoder.free_id + 1), _unsigned(width)
        number = TaskContext.get().partitionId() << 40
        packer, waiting, gathered, doc_kind = Packer(width), [], 0, None

        def flush(keep):
            nonlocal number
            waiting.sort(key=lambda piece: -len(piece[-1]))
            for piece in waiting:
                packer.place(piece)
            waiting.clear()
            full = packer.take(keep)
            for start in range(0, len(full), 256):
                some = full[start : start + 256]
                yield _matrix(some, number, width, encoder.free_id, kind, place_kind, doc_kind)
                number += len(some)

        for slab in slabs(batches, "text"):
            doc_kind = slab.column("doc_id").type
            for doc, text in zip(slab.column("doc_id").to_pylist(), slab.column("text").to_pylist()):
                ids = np.append(encoder.encode(text or ""), encoder.free_id).astype(kind)
                gathered += len(ids)
                waiting += [(doc, n, s, ids[s : s + z]) for n, (s, z) in enumerate(cut(len(ids), width))]
            if gathered >= BUFFER:
                yield from flush(OPEN)
                gathered = 0
        if doc_kind is not None:
            yield from flush(0)

    schema = T.StructType(
        [
            T.StructField("sequence_id", T.LongType()),
            T.StructField("n_tokens", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("position_ids", T.BinaryType()),
            T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
            T.StructField("doc_ids", T.ArrayType(id_type)),
            T.StructField("pieces", T.ArrayType(T.IntegerType())),
            T.StructField("starts", T.ArrayType(T.LongType())),
        ]
    )
    return map_arrow(rows, run, schema)


def _matrix(some, number, width, pad, kind, place_kind, doc_kind) -> pa.RecordBatch:
    ids, places, borders = [], [], []
    for sequence in some:
        row = np.full(width, pad, kind)
        place = np.zeros(width, place_kind)
        at, ends = 0, [0]
        for *_, own in sequence:
            row[at : at + len(own)] = own
            place[at : at + len(own)] = np.arange(len(own))
            at += len(own)
            ends.append(at)
        ids.append(row.tobytes())
        places.append(place.tobytes())
        borders.append(ends)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(range(number, number + len(some)), pa.int64()),
            pa.array([ends[-1] for ends in borders], pa.int32()),
            pa.array(ids, pa.binary()),
            pa.array(places, pa.binary()),
            pa.array(borders, pa.list_(pa.int32())),
            pa.array([[piece[0] for piece in s] for s in some], pa.list_(doc_kind)),
            pa.array([[piece[1] for piece in s] for s in some], pa.list_(pa.int32())),
            pa.array([[piece[2] for piece in s] for s in some], pa.list_(pa.int64())),
        ],
        ["sequence_id", "n_tokens", "ids", "position_ids", "cu_seqlens", "doc_ids", "pieces", "starts"],
    )


def write_matrices(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet files that hold the binary rows unchanged."""
    packed.write.mode("overwrite").option("compression", "zstd").parquet(path)


def matrix(binary_rows: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Binary rows as one matrix of unsigned integers, sequences x width."""
    if not binary_rows:
        return np.zeros((0, width), "<u2")
    return np.stack([np.frombuffer(row, f"<u{len(row) // width}") for row in binary_rows])


def unpacked(packed: DataFrame, id_bytes: int = 2) -> DataFrame:
    """The pieces of packed rows again: doc_id, piece, start and ids (binary)."""
    segments = F.arrays_zip(
        "doc_ids",
        "pieces",
        "starts",
        F.slice("cu_seqlens", 1, F.size("doc_ids")).alias("first"),
        F.slice("cu_seqlens", 2, F.size("doc_ids")).alias("end"),
    )
    rows = packed.select("ids", F.explode(segments).alias("s"))
    size = (F.col("s.end") - F.col("s.first")) * id_bytes
    return rows.select(
        F.col("s.doc_ids").alias("doc_id"),
        F.col("s.pieces").alias("piece"),
        F.col("s.starts").alias("start"),
        F.substring("ids", F.col("s.first") * id_bytes + 1, size).alias("ids"),
    )
