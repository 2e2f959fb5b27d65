"""Read a database table back."""

from __future__ import annotations

from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_RANGES = (T.NumericType, T.DateType, T.TimestampType)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    partitions: int = 8,
) -> DataFrame:
    """Database table over JDBC, read by the executors in ranges of a column.

    The column is `partition_column`, or the first column of the table's primary
    key; the range ends are asked from the database. It has to be numeric, a date
    or a timestamp. A table without such a column, or without values in it, is
    read by one task.
    """
    options = {"url": url, **(properties or {})}
    whole = spark.read.format("jdbc").options(**options).option("dbtable", table).load()
    if partition_column is None:
        partition_column = next(iter(key_columns(spark, url, table, properties)), None)
    types = {f.name.lower(): f.dataType for f in whole.schema.fields}
    if partition_column is None or not isinstance(types.get(partition_column.lower()), _RANGES):
        return whole
    ends = f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}) ends"
    row = spark.read.format("jdbc").options(**options).option("dbtable", ends).load().first()
    if row[0] is None:
        return whole
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", _bound(row[0]))
        .option("upperBound", _bound(row[1]))
        .option("numPartitions", str(partitions))
        .load()
    )


def key_columns(
    spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None
) -> list[str]:
    """Columns of a table's primary key in their order, from the database's metadata.

    The table's name may have a schema in front. Names are looked up as given,
    then in upper and lower case, as databases differ in how they store them. A
    driver without such metadata counts as a table without a key.
    """
    jvm = spark._jvm
    login = jvm.java.util.Properties()
    for name, value in (properties or {}).items():
        login.setProperty(name, str(value))
    if properties and "driver" in properties:
        # Drivers that were added to the session are known to Spark's registry only.
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    try:
        connection = jvm.java.sql.DriverManager.getConnection(url, login)
    except Py4JJavaError:
        return []
    try:
        metadata = connection.getMetaData()
        for spelled in dict.fromkeys((table, table.upper(), table.lower())):
            *schema, name = spelled.replace('"', "").split(".")
            rows = metadata.getPrimaryKeys(None, schema[-1] if schema else None, name)
            found = {}
            while rows.next():
                found[rows.getShort("KEY_SEQ")] = rows.getString("COLUMN_NAME")
            if found:
                return [found[n] for n in sorted(found)]
    except Py4JJavaError:
        pass
    finally:
        connection.close()
    return []


def _bound(value) -> str:
    """Text of a range end as Spark parses it: dates and timestamps, or whole numbers."""
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    return str(int(value))
