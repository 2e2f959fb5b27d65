"""Row identity, held-out rows, and removal of chosen rows."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterprep.functions.columns import column
from clusterprep.session import cut_lineage

# Rows of keys (8 to 40 bytes each) that may be broadcast; a larger side is shuffled.
BROADCAST_ROWS = 500_000

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_BYTES_DEFAULT = "67108864b"
_WORKER_MEMORY = {
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(32 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(64 << 20),
}


def unused(df: DataFrame, name: str) -> str:
    """`name`, with underscores added until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows, written once with a number for each, and the number's column.

    Ids may be missing or repeated; the written number is neither, and stays
    the same when a lost task runs again.
    """
    name = unused(docs, "_row")
    return cut_lineage(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def small(df: DataFrame) -> DataFrame:
    """Mark a frame of keys for broadcast if its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def without(docs: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """`docs` without the rows whose number is in `dropped`, and without that column."""
    return docs.join(small(dropped.select(row)), row, "left_anti").drop(row)


def in_held_out(doc_id: Column) -> Column:
    """Held-out rows: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def picked(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the given new names."""
    return docs.select(*[column(old).alias(new) for new, old in columns.items()])




def map_arrow(
    df: DataFrame,
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """`mapInArrow`, with this library on the Python path of the workers.

    That helps where workers see the same folders as the driver; elsewhere the
    library has to be sent with `--py-files`. Rows hold whole texts, so batches
    are limited by bytes, and workers give large arrays back when done.
    """
    session = df.sparkSession
    if session.conf.get(_BATCH_BYTES) == _BATCH_BYTES_DEFAULT:
        session.conf.set(_BATCH_BYTES, "8m")
    environment = session.sparkContext.environment
    for name, value in _WORKER_MEMORY.items():
        environment.setdefault(name, value)
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    here = str(Path(__file__).resolve().parents[2])
    if here not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([here, *paths])
    if not any("." in name for name in df.columns):
        return df.mapInArrow(run, schema)
    # mapInArrow takes a dot for a field of a structure.
    plain = df.toDF(*map(plain_name, df.columns))
    if isinstance(schema, str):
        return plain.mapInArrow(run, schema)
    fields = [T.StructField(plain_name(f.name), f.dataType, f.nullable) for f in schema.fields]
    return plain.mapInArrow(run, T.StructType(fields)).toDF(*schema.names)


def plain_name(name: str) -> str:
    """The name by which the function of `map_arrow` sees a column."""
    return name.replace(".", "\u00b7")
