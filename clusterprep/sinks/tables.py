"""Write result tables. Every writer replaces what was there, on the executors."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterprep.functions.columns import as_text, quoted
from clusterprep.sources.jdbc import read_jdbc

# Names of the stored tables.
INPUT_TABLE = "food_input"
PREDICTIONS_TABLE = "food_predictions"
METRICS_TABLE = "food_metrics"


class Target(Protocol):
    """Place that holds named tables."""

    def write(self, df: DataFrame, table: str) -> None: ...

    def read(self, spark: SparkSession, table: str) -> DataFrame: ...


@dataclass(frozen=True)
class ParquetTarget:
    """One Parquet folder per table below `folder`."""

    folder: str

    def write(self, df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/{table}")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/{table}")


@dataclass(frozen=True)
class CatalogTarget:
    """Tables of a catalog database, which is created if it is missing."""

    database: str
    location: str | None = None

    def write(self, df: DataFrame, table: str) -> None:
        ensure_database(df.sparkSession, self.database, self.location)
        df.write.mode("overwrite").saveAsTable(f"{quoted(self.database)}.{quoted(table)}")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(f"{quoted(self.database)}.{quoted(table)}")

    def tables(self, spark: SparkSession) -> list[str]:
        return sorted(t.name for t in spark.catalog.listTables(self.database) if not t.isTemporary)

    def drop(self, spark: SparkSession) -> None:
        """Delete the database with its tables."""
        spark.sql(f"DROP DATABASE IF EXISTS {quoted(self.database)} CASCADE")


@dataclass(frozen=True)
class JdbcTarget:
    """Tables of a database reached over JDBC; `properties` hold driver and login.

    `connections` bounds how many tasks write, or read, at the same time. Tables
    are read by ranges of `partition_column`, or else of the first column of
    their primary key, if it is numeric, a date or a timestamp; all others are
    read by one task. Text columns get the database's own unlimited type.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    connections: int = 8
    batch_size: int = 10_000
    partition_column: str | None = None

    def write(self, df: DataFrame, table: str) -> None:
        writer = (
            df.write.mode("overwrite")
            .option("numPartitions", self.connections)
            .option("batchsize", self.batch_size)
        )
        writer.jdbc(self.url, table, properties=dict(self.properties))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return read_jdbc(
            spark, self.url, table, dict(self.properties), self.partition_column, self.connections
        )


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a catalog database unless it exists."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{place}")


def text_columns(df: DataFrame) -> DataFrame:
    """The frame with every column as text (see `as_text`)."""
    return df.select([as_text(f) for f in df.schema.fields])


def replace_table(df: DataFrame, target: Target, table: str, as_strings: bool = False) -> bool:
    """Replace a table by the frame, typed or as text; an empty frame changes nothing.

    Returns whether the table was written.
    """
    if not df.columns or df.isEmpty():
        return False
    target.write(text_columns(df) if as_strings else df, table)
    return True


def save_results(
    predictions: DataFrame, metrics: DataFrame, target: Target, as_strings: bool = False
) -> None:
    """Replace the predictions table, then the metrics table.

    Without predictions neither is touched, so the two always belong together.
    """
    if replace_table(predictions, target, PREDICTIONS_TABLE, as_strings):
        replace_table(metrics, target, METRICS_TABLE, as_strings)


def save_input(df: DataFrame, target: Target) -> DataFrame:
    """Replace the input table by the source rows and read it back.

    An empty frame changes nothing and is returned itself: what the table holds
    are older rows.
    """
    if not replace_table(df, target, INPUT_TABLE):
        return df
    return target.read(df.sparkSession, INPUT_TABLE)


def results_summary(spark: SparkSession, target: Target) -> DataFrame:
    """Check of stored results: each metric beside the number of predictions."""
    predictions = target.read(spark, PREDICTIONS_TABLE).agg(F.count(F.lit(1)).alias("predictions"))
    total = F.lit(predictions.first()["predictions"]).cast("long")
    metrics = target.read(spark, METRICS_TABLE)
    return metrics.select("metric", "value", total.alias("predictions"))
