"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterprep.functions.columns import column


def write_parquet(df: DataFrame, path: str, files: int | None = None) -> None:
    """Replace a Parquet folder; `files` spreads the rows evenly over so many files."""
    out = df if files is None else df.repartition(files)
    out.write.mode("overwrite").parquet(path)


def rows_to_json(df: DataFrame) -> DataFrame:
    """One `json` text per row; null fields are left out."""
    return df.select(F.to_json(F.struct(*[column(name) for name in df.columns])).alias("json"))


def write_jsonl(df: DataFrame, path: str) -> None:
    """Replace a folder of JSON-lines files."""
    df.write.mode("overwrite").json(path)
