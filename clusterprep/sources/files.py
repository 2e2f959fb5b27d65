"""Parquet, JSON-lines and text scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table; the schema comes from the files."""
    return spark.read.parquet(path)


def read_jsonl(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """JSON-lines table.

    Give a schema: without one Spark reads all files twice to infer it, sorts
    the columns by name and leaves out those that are null in every row.
    Malformed lines are an error unless another mode is given.
    """
    reader = spark.read.option("mode", mode)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files as one `value` row per line."""
    return spark.read.text(path)
