import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clusterprep.operators import order_statistics
from clusterprep.operators.order_statistics import count_values, kth_smallest


def check(spark, values, k, **options):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` double").repartition(4)
    sizes = count_values(df, ["a.b"])
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    assert sizes == {"a.b": len(known)}
    assert kth_smallest(df, {"a.b": k}, sizes, **options)["a.b"] == known[k - 1]


@pytest.mark.parametrize("k", [1, 2, 500, 999, 1000])
@pytest.mark.parametrize("direct_rows", [0, 50, 10_000])
def test_narrowing_is_exact(spark, k, direct_rows):
    values = [float(i) for i in range(1000)] + [None, math.nan]
    random.Random(1).shuffle(values)
    check(spark, values, k, direct_rows=direct_rows, relative_error=0.05)


@pytest.mark.parametrize("k", [1, 300, 301, 450, 650, 651, 900])
def test_value_that_fills_a_third(spark, k):
    values = [0.5 + i / 1000 for i in range(300)] + [5.0] * 350 + [9.0 + i for i in range(250)]
    check(spark, values, k, direct_rows=20, relative_error=0.02)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.integers(-20, 20).map(float), min_size=1, max_size=200),
    share=st.floats(0, 0.999),
)
def test_any_values(spark, values, share):
    check(spark, values, 1 + int(share * len(values)), direct_rows=5, relative_error=0.1)


def test_several_columns_at_once(spark):
    df = spark.createDataFrame([(float(i), float(-i)) for i in range(100)], ["a", "b"])
    sizes = count_values(df, ["a", "b"])
    found = kth_smallest(df, {"a": 10, "b": 90}, sizes, direct_rows=10, relative_error=0.05)
    assert found == {"a": 9.0, "b": -10.0}


def test_position_out_of_range(spark):
    df = spark.createDataFrame([(1.0,)], ["a"])
    with pytest.raises(ValueError, match="out of range"):
        kth_smallest(df, {"a": 2}, {"a": 1})


def test_medians_of_many_columns(spark):
    """The work and what reaches the driver grow with the columns, not their square."""
    columns = [f"c{i}" for i in range(300)]
    df = spark.range(0, 400, 1, 2).select(*[(F.col("id") * (i + 1) % 401).cast("double").alias(c) for i, c in enumerate(columns)])
    sizes = dict.fromkeys(columns, 400)
    found = kth_smallest(df, dict.fromkeys(columns, 200), sizes, direct_rows=100)
    for i in (0, 7, 299):
        assert found[f"c{i}"] == sorted(n * (i + 1) % 401 for n in range(400))[199]


@pytest.mark.parametrize("flat", [0, 16])
def test_both_forms_of_counting(spark, monkeypatch, flat):
    monkeypatch.setattr(order_statistics, "_FLAT_COLUMNS", flat)
    df = spark.createDataFrame(
        [(1.0, None, None), (math.nan, 2, None), (None, 3, None)], "`a.b` double, c int, d double"
    )
    assert count_values(df, ["a.b", "c", "d"]) == {"a.b": 1, "c": 2, "d": 0}
