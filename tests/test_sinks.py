"""Result tables. JDBC calls are recorded, as no database may be started here."""

import math
import random
import struct
import uuid
from datetime import date, datetime
from decimal import Decimal
from unittest.mock import MagicMock, call

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clusterprep.operators.evaluate import metrics_table
from clusterprep.session import fresh_path
from clusterprep.sinks.tables import (
    INPUT_TABLE,
    METRICS_TABLE,
    PREDICTIONS_TABLE,
    CatalogTarget,
    JdbcTarget,
    ParquetTarget,
    ensure_database,
    replace_table,
    results_summary,
    save_input,
    save_results,
    text_columns,
)
from clusterprep.sources.jdbc import key_columns, read_jdbc


def catalog(spark):
    name = "results_" + uuid.uuid4().hex[:8]
    return CatalogTarget(name, fresh_path(spark, name))


@pytest.fixture(params=["parquet", "catalog"])
def target(spark, request):
    return catalog(spark) if request.param == "catalog" else ParquetTarget(fresh_path(spark, "t"))


def predictions(spark):
    return spark.createDataFrame(
        [(1.5, None, 0), (2.0, 7.25, 1)], "`a.b` double, c double, prediction int"
    )


def test_save_results_typed(spark, target):
    save_results(predictions(spark), metrics_table(spark, {"silhouette": 0.25}), target)
    back = target.read(spark, PREDICTIONS_TABLE)
    assert back.dtypes == predictions(spark).dtypes
    assert back.exceptAll(predictions(spark)).count() == 0 and back.count() == 2
    assert [tuple(r) for r in results_summary(spark, target).collect()] == [("silhouette", 0.25, 2)]


def test_save_results_as_text(spark, target):
    save_results(predictions(spark), metrics_table(spark, {"m": 0.5}), target, as_strings=True)
    rows = {tuple(r) for r in target.read(spark, PREDICTIONS_TABLE).collect()}
    assert rows == {("1.5", "", "0"), ("2.0", "7.25", "1")}
    assert tuple(target.read(spark, METRICS_TABLE).first()) == ("m", "0.5")


def test_text_rule(spark):
    df = spark.createDataFrame(
        [(True, "x", 5, Decimal("1.50"), [1, 2], (3, None), {"k": 1}), (None,) * 7],
        "b boolean, s string, l bigint, d decimal(5,2), a array<int>, "
        "st struct<p:int,q:string>, m map<string,int>",
    )
    rows = [tuple(r) for r in text_columns(df).collect()]
    assert rows == [("true", "x", "5", "1.50", "[1,2]", '{"p":3}', '{"k":1}'), ("",) * 7]


def test_empty_result_leaves_the_table(spark, target):
    assert replace_table(predictions(spark), target, "t")
    assert not replace_table(predictions(spark).limit(0), target, "t")
    assert target.read(spark, "t").count() == 2


def test_replaced_table_may_have_other_columns(spark, target):
    replace_table(predictions(spark), target, "t")
    replace_table(spark.range(3), target, "t")
    spark.catalog.clearCache()
    assert target.read(spark, "t").columns == ["id"] and target.read(spark, "t").count() == 3


def test_database_is_created_once_and_lists_its_tables(spark):
    place = catalog(spark)
    ensure_database(spark, place.database, place.location)
    save_results(predictions(spark), metrics_table(spark, {"m": 1.0}), place)
    ensure_database(spark, place.database, place.location)
    assert place.tables(spark) == sorted([METRICS_TABLE, PREDICTIONS_TABLE])


def test_source_rows_are_read_back(spark, target):
    back = save_input(predictions(spark), target)
    assert back.exceptAll(predictions(spark)).count() == 0 and back.count() == 2
    assert target.read(spark, INPUT_TABLE).count() == 2


def recorded(df):
    """The frame with its writer replaced by one that records calls."""
    writer = MagicMock()
    writer.mode.return_value = writer.option.return_value = writer
    frame = MagicMock(schema=df.schema, columns=df.columns, write=writer)
    return frame, writer


def test_jdbc_write(spark):
    frame, writer = recorded(text_columns(predictions(spark)))
    JdbcTarget("jdbc:x", {"user": "u"}, connections=3).write(frame, "t")
    writer.mode.assert_called_once_with("overwrite")
    assert writer.option.mock_calls == [call("numPartitions", 3), call("batchsize", 10_000)]
    writer.jdbc.assert_called_once_with("jdbc:x", "t", properties={"user": "u"})


def reader(ends, keys=()):
    """A session whose reader records options; the first row of any table is `ends`.

    The table t has a primary key of the columns `keys`.
    """
    spark = MagicMock()
    metadata = spark._jvm.java.sql.DriverManager.getConnection.return_value.getMetaData.return_value

    def primary_keys(_, schema, table):
        own = list(enumerate(keys, 1)) if table == "t" else []
        rows = MagicMock()
        rows.next.side_effect = [True] * len(own) + [False]
        # Rows come in the order of the names, not of the key.
        own.sort(key=lambda row: row[1])
        rows.getShort.side_effect = [number for number, _ in own]
        rows.getString.side_effect = [name for _, name in own]
        return rows

    metadata.getPrimaryKeys.side_effect = primary_keys
    jdbc = spark.read.format.return_value
    jdbc.options.return_value = jdbc.option.return_value = jdbc
    jdbc.load.return_value.first.return_value = ends
    jdbc.load.return_value.schema = StructType.fromDDL("id long, day date, name string")
    return spark, jdbc


def options(jdbc):
    return [c.args for c in jdbc.option.mock_calls]


@pytest.mark.parametrize(
    "ends,low,high",
    [
        ((5, 90), "5", "90"),
        ((Decimal("5"), Decimal("90")), "5", "90"),
        ((date(2024, 1, 2), date(2024, 3, 4)), "2024-01-02", "2024-03-04"),
        (
            (datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 3, 4)),
            "2024-01-02 03:04:05",
            "2024-03-04 00:00:00",
        ),
    ],
)
def test_jdbc_read_in_parallel(ends, low, high):
    spark, jdbc = reader(ends)
    read_jdbc(spark, "jdbc:x", "t", {"user": "u"}, partition_column="day", partitions=4)
    jdbc.options.assert_called_with(url="jdbc:x", user="u")
    assert options(jdbc)[-5:] == [
        ("dbtable", "t"),
        ("partitionColumn", "day"),
        ("lowerBound", low),
        ("upperBound", high),
        ("numPartitions", "4"),
    ]


@pytest.mark.parametrize("column", ["id", "other", "name", None])
def test_jdbc_read_that_cannot_be_split(column):
    spark, jdbc = reader((None, None))
    assert read_jdbc(spark, "jdbc:x", "t", partition_column=column) is jdbc.load.return_value
    assert ("dbtable", "t") in options(jdbc)
    assert not any(name == "partitionColumn" for name, _ in options(jdbc))


@pytest.mark.parametrize("keys,column", [(["id"], "id"), (["day", "a"], "day"), (["id", "a", "b"], "id")])
def test_jdbc_read_by_ranges_of_the_key(keys, column):
    spark, jdbc = reader((3, 8), keys)
    read_jdbc(spark, "jdbc:x", "s.T", {"user": "u", "driver": "d.D"}, partitions=4)
    assert ("partitionColumn", column) in options(jdbc) and ("lowerBound", "3") in options(jdbc)
    registry = spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry
    registry.register.assert_called_once_with("d.D")
    manager = spark._jvm.java.sql.DriverManager.getConnection
    manager.assert_called_once()
    manager.return_value.close.assert_called_once_with()
    asked = [c.args for c in manager.return_value.getMetaData.return_value.getPrimaryKeys.mock_calls]
    assert asked == [(None, "s", "T"), (None, "S", "T"), (None, "s", "t")]


@pytest.mark.parametrize("keys", [[], ["name"]])
def test_jdbc_read_of_a_table_without_a_usable_key(keys):
    spark, jdbc = reader((3, 8), keys)
    assert read_jdbc(spark, "jdbc:x", "t") is jdbc.load.return_value


def test_key_of_a_database_that_cannot_be_asked(spark):
    assert key_columns(spark, "jdbc:nothing:x", "t", {"user": "u"}) == []


def test_jdbc_target_reads_by_its_partition_column():
    spark, jdbc = reader((1, 2))
    JdbcTarget("jdbc:x", {}, connections=5, partition_column="id").read(spark, "t")
    assert options(jdbc)[-1] == ("numPartitions", "5")


def test_empty_input_is_not_answered_with_old_rows(spark, target):
    replace_table(predictions(spark), target, INPUT_TABLE)
    empty = spark.createDataFrame([], "b int")
    assert save_input(empty, target).columns == ["b"] and save_input(empty, target).count() == 0


def test_results_without_predictions_leave_both_tables(spark, target):
    save_results(predictions(spark), metrics_table(spark, {"m": 1.0}), target)
    save_results(predictions(spark).limit(0), metrics_table(spark, {"m": 2.0}), target)
    assert [tuple(r) for r in results_summary(spark, target).collect()] == [("m", 1.0, 2)]


def test_numbers_are_plain_decimals(spark):
    values = [1e7, -1.25e7, 5e-4, -1.5e-10, 123456789.125, 1e22, 1.0, 0.0, 0.001, 9999999.5, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], ["x"])
    texts = [r[0] for r in text_columns(df).collect()]
    assert texts[:10] == [
        "10000000.0", "-12500000.0", "0.0005", "-0.00000000015", "123456789.125",
        "10000000000000000000000.0", "1.0", "0.0", "0.001", "9999999.5",
    ]
    assert texts[10] == "Infinity"
    assert [float(t) for t in texts[:10]] == values[:10]


@pytest.mark.parametrize("kind", ["double", "float"])
def test_plain_decimals_of_all_sizes(spark, kind):
    rng = random.Random(4)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-12, 22) for _ in range(2000)]
    values += [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(500)]
    values += [9999999.999999998, 1e19, 9.999999999999999e18, 9.999999999999999e-4, 1e-6, 9.99e-7, -0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(F.col("x").cast(kind))
    df = df.filter("NOT isnan(x)")
    rows = df.select("x", F.col("x").cast("string").alias("short")).collect()
    for row, (text,) in zip(rows, text_columns(df).collect()):
        expected = format(Decimal(row["short"]), "f") if row["x"] not in (math.inf, -math.inf) else row["short"]
        if "." not in expected and "n" not in expected:
            expected += ".0"
        if "E" in row["short"] and "." in expected:
            whole, _, behind = expected.partition(".")
            expected = f"{whole}.{behind.rstrip('0') or '0'}"
        assert text == expected


def test_dropped_database(spark):
    target = catalog(spark)
    target.write(spark.range(3), "b")
    target.write(spark.range(3), "a")
    assert target.tables(spark) == ["a", "b"]
    target.drop(spark)
    assert not spark.catalog.databaseExists(target.database)
    target.drop(spark)
