import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clusterprep.functions.columns import numeric_columns
from clusterprep.operators import profile
from clusterprep.operators.profile import (
    drop_constant_columns,
    keep_filled_columns,
    table_profile,
)


def profile_of(spark, values, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"a {kind}")
    return table_profile(df).first()


def test_numeric_columns_are_top_level_numbers_in_schema_order(spark):
    df = spark.createDataFrame(
        [],
        "z double, s string, b boolean, y tinyint, sm smallint, i int, l bigint, f float, "
        "dec decimal(10,2), d date, ts timestamp, bin binary, arr array<int>, "
        "m map<string,int>, st struct<n:int>, a int",
    )
    assert numeric_columns(df) == ["z", "y", "sm", "i", "l", "f", "dec", "a"]
    assert numeric_columns(df, exclude=["l", "a"]) == ["z", "y", "sm", "i", "f", "dec"]


def test_statistics(spark):
    row = profile_of(spark, [1.0, 2.0, 4.0, None])
    assert (row.total_rows, row.non_null, row.fill_ratio) == (4, 3, 0.75)
    assert row.stddev == pytest.approx(math.sqrt(7 / 3))
    assert (row.min_value, row.max_value, row.varies) == (1.0, 4.0, True)


def test_decimal_column(spark):
    row = profile_of(spark, [Decimal("1.10"), Decimal("2.20")], "decimal(10,2)")
    assert (row.min_value, row.max_value, row.varies) == (1.1, 2.2, True)


def test_nan_is_filled_but_does_not_vary(spark):
    row = profile_of(spark, [math.nan, 1.0, 2.0])
    assert row.non_null == 3 and not row.varies


@pytest.mark.parametrize("extreme", [math.inf, -math.inf])
def test_infinity_does_not_vary(spark, extreme):
    assert not profile_of(spark, [extreme, 1.0, 2.0]).varies


@pytest.mark.parametrize("values", [[1.0, None, None], [None, None]])
def test_fewer_than_two_values_do_not_vary(spark, values):
    row = profile_of(spark, values)
    assert row.stddev is None and row.varies is False


def test_constant_with_rounding_noise_does_not_vary(spark):
    df = spark.range(0, 10_007, 1, 8).select(F.lit(3.7).alias("a"))
    assert not table_profile(df).first().varies


def test_longs_that_meet_as_doubles_do_not_vary(spark):
    assert not profile_of(spark, [2**53, 2**53 + 1], "bigint").varies


def test_ratio_is_inclusive(spark):
    df = spark.createDataFrame([(1.0 if i else None, i) for i in range(10)], "a double, b int")
    assert keep_filled_columns(df, 0.9) == ["a", "b"]
    assert keep_filled_columns(df, 0.91) == ["b"]


def test_drop_constant_columns_keeps_schema_order(spark):
    df = spark.createDataFrame([(1, 5, 2.0), (2, 5, 3.0)], "z int, c int, a double")
    assert drop_constant_columns(df) == ["z", "a"]


def test_dots_and_backquotes_in_names(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], ["a.b", "c`d"])
    assert drop_constant_columns(df) == ["a.b", "c`d"]


def test_wide_table_is_one_row_per_column(spark):
    df = spark.range(0, 100, 1, 4).select([(F.col("id") * i).alias(f"c{i}") for i in range(150)])
    rows = {row.column_name: row for row in table_profile(df).collect()}
    assert len(rows) == 150
    assert rows["c149"].max_value == 149 * 99.0 and not rows["c0"].varies


def test_both_forms_agree(spark, monkeypatch):
    df = spark.createDataFrame(
        [(1.0, None, 5, math.nan), (2.5, None, 5, 1.0), (None, None, 5, 2.0)],
        "a double, `b.c` double, i int, n double",
    )
    forms = []
    for columns_in_flat_form in (0, 16):
        monkeypatch.setattr(profile, "_FLAT_COLUMNS", columns_in_flat_form)
        rows = table_profile(df).collect()
        forms.append(({str(row) for row in rows}, table_profile(df).dtypes))
        assert table_profile(df.limit(0)).count() == 0
    assert forms[0] == forms[1] and len(forms[0][0]) == 4


def test_layout_does_not_matter(spark):
    df = spark.range(0, 1000, 1, 1).select((F.col("id") % 7).alias("a"))
    one, many = (table_profile(d).first() for d in (df, df.repartition(13)))
    assert one.stddev == pytest.approx(many.stddev)
    assert one.asDict().keys() == many.asDict().keys()


def test_only_numeric_columns_are_scanned(spark, sf_dir):
    plan = table_profile(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_tax"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_tax:double>" in text
    assert "partial_stddev_samp" in text


def test_no_numeric_column(spark):
    with pytest.raises(ValueError, match="no numeric columns"):
        table_profile(spark.createDataFrame([("a",)], "s string"))
