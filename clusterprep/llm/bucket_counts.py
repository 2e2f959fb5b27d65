"""Counts of hash values over a whole corpus, by a fixed number of buckets."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clusterprep.llm.arrays import slabs
from clusterprep.llm.rows import map_arrow

_BLOCK = 1 << 10


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash; their number is a power of two."""
    return (values & np.uint64(buckets - 1)).astype(np.int64)


def bucket_counts(
    rows: DataFrame, values: Callable[[pa.RecordBatch], np.ndarray], buckets: int
) -> np.ndarray:
    """How often the texts of `rows` have a value of each bucket (at most 2^31 - 1).

    `values` gives the hashes of a slab's texts (column `text`). Tasks send the blocks of the table
    that they filled; these are added up as they stream by, in partitions of
    whole blocks, so no task holds more than its share of the table.
    """

    def count(batches):
        counts = np.zeros(buckets, np.int64)
        for slab in slabs(batches, "text"):
            np.add.at(counts, bucket_of(values(slab), buckets), 1)
        parts = counts.reshape(-1, _BLOCK)
        filled = np.flatnonzero(parts.any(axis=1))
        yield sent(filled, [parts[n] for n in filled])

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column("block").to_pylist(), batch.column("counts")):
                totals[block] = totals.get(block, 0) + np.frombuffer(part.as_buffer(), np.int64)
        yield sent(list(totals), list(totals.values()))

    def sent(blocks, parts):
        columns = [pa.array(blocks, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["block", "counts"])

    schema = "block long, counts binary"
    parts = map_arrow(rows.select("text"), count, schema).repartition("block")
    sums = map_arrow(parts, add, schema).toArrow()
    counts = np.zeros((buckets // _BLOCK, _BLOCK), np.int64)
    for block, part in zip(sums["block"].to_pylist(), sums["counts"].to_pylist()):
        counts[block] = np.frombuffer(part, np.int64)
    return np.minimum(counts.ravel(), 2**31 - 1).astype(np.int32)
