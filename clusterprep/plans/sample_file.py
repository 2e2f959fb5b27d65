"""Write a small copy of a table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from clusterprep.operators.sampling import first_rows
from clusterprep.sinks.files import write_parquet
from clusterprep.sources.files import read_parquet

# Fixed value: default size of the copy.
SAMPLE_ROWS = 20_000


def write_sample(
    spark: SparkSession,
    source: str,
    destination: str,
    n: int = SAMPLE_ROWS,
    files: int = 1,
) -> None:
    """Replace `destination` by any n rows of the table, in so many files."""
    write_parquet(first_rows(read_parquet(spark, source), n), destination, files)
