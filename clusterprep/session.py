"""Shared working folder, lineage cuts and cleaning up."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType


_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_FEW = 8


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors can reach: `spark.checkpoint.dir`.

    Where the session does not name one, a cluster uses its warehouse folder
    and a local master a temporary folder; the choice is stored in the session.
    A warehouse on the local disk is no shared folder: every executor would
    write to its own, and a read would miss rows, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = getattr(spark, "_clusterprep_folder", None)
    if not folder:
        if is_local(spark.conf.get("spark.master", "")):
            folder = tempfile.mkdtemp(prefix="clusterprep-")
        else:
            warehouse = spark.conf.get("spark.sql.warehouse.dir")
            if warehouse.startswith("file:") or warehouse.startswith("/"):
                raise ValueError(
                    "set spark.checkpoint.dir to a folder that all executors share; "
                    f"the warehouse {warehouse} is on a local disk"
                )
            folder = warehouse.rstrip("/") + "/_clusterprep"
        spark._clusterprep_folder = folder
    return folder.rstrip("/")


def is_local(master: str) -> bool:
    """Whether the driver's own process runs the tasks."""
    return master == "local" or master.startswith("local[")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for written in getattr(spark, "_clusterprep_scratch", ()):
        written.append(path)
    return path


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame to the shared folder once and read it back.

    Later passes read a columnar table instead of repeating the plan, and a
    lost executor costs a re-read of some files only. The rows come back in
    partitions packed by file size: use `checkpointed` where order matters.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return read_written(df.sparkSession, path, df.schema)


def read_written(
    spark: SparkSession, path: str, schema: StructType, part: tuple[str, int] | None = None
) -> DataFrame:
    """A table below a path of `fresh_path`, which `discard` may delete.

    Of a table written by a partition column, `part` reads one value only,
    without that column; it may have no rows and then no folder.
    """
    if part is None:
        written = spark.read.schema(schema).parquet(path)
    else:
        name, value = part
        both = StructType([*schema.fields, StructField(name, IntegerType())])
        whole = spark.read.schema(both).parquet(path)
        written = whole.filter(whole[name] == value).drop(name)
        path = f"{path}/{name}={value}"
    written._clusterprep_path = path
    return written


def write_parts(df: DataFrame, path: str, column: str) -> None:
    """Write a table by a column of few values, to several files at a time instead of sorting by it."""
    conf = df.sparkSession.conf
    before = conf.get(_WRITERS)
    conf.set(_WRITERS, str(max(_FEW, int(before))))
    try:
        df.write.partitionBy(column).parquet(path)
    finally:
        conf.set(_WRITERS, before)


def discard(*frames: DataFrame) -> None:
    """Delete what `cut_lineage` wrote for these frames, which nothing may read any more."""
    for df in frames:
        _delete(df.sparkSession, df._clusterprep_path)
    for df in frames[:1]:
        release_shuffles(df.sparkSession)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that no one holds any more.

    It does so when the driver's garbage is collected, which is asked for here.
    """
    gc.collect()
    spark._jvm.System.gc()


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame as a checkpoint in the shared folder: same partitions, same order."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


@contextmanager
def held(df: DataFrame) -> Iterator[None]:
    """Keep a frame's columns, compressed, on the workers' disks while this block passes over it.

    A pass then reads columns instead of deserialising rows, in the same
    partitions and order; the heap stays free for what the passes keep there.
    """
    df.persist(StorageLevel.DISK_ONLY)
    try:
        yield
    finally:
        df.unpersist()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the tables that this block wrote to the shared folder.

    Only paths handed out by `fresh_path` inside the block are deleted, through
    Hadoop's file system. Frames that read them can't be used afterwards.
    Checkpoints are Spark's to delete (`spark.cleaner.referenceTracking.cleanCheckpoints`).
    """
    written: list[str] = []
    blocks = getattr(spark, "_clusterprep_scratch", [])
    spark._clusterprep_scratch = [*blocks, written]
    try:
        yield
    finally:
        spark._clusterprep_scratch = blocks
        for path in written:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
