import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clusterprep.operators.features import assemble, cast_features, distinct_rows, standard_scale
from clusterprep.operators.impute import impute


def filled(spark, values, strategy, **options):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` double")
    return [row["a.b_imp"] for row in impute(df, ["a.b"], strategy, **options).collect()]


def test_exact_median_is_the_lower_one(spark):
    assert filled(spark, [4.0, 1.0, None, 3.0, 2.0], "median", relative_error=0.0) == [4, 1, 2, 3, 2]


def test_nan_is_missing(spark):
    assert filled(spark, [math.nan, 5.0, 5.0], "median", relative_error=0.0) == [5, 5, 5]
    assert filled(spark, [math.nan, 5.0, 7.0], "mean") == [6, 5, 7]


def test_mode_tie_goes_to_the_smallest(spark):
    assert filled(spark, [5.0, 5.0, 2.0, 2.0, 9.0, None], "mode")[-1] == 2.0


def test_approximate_median_is_close(spark):
    df = spark.range(0, 10_001, 1, 4).select(F.when(F.col("id") > 0, F.col("id")).alias("a"))
    row = impute(df, ["a"]).where("a IS NULL").first()
    assert abs(row.a_imp - 5000) <= 0.001 * 10_000 + 1


def test_exact_median_for_any_layout(spark):
    df = spark.range(0, 9_999, 1, 4).select(((F.col("id") * 7919) % 9_999).cast("double").alias("a"))
    holes = df.select(F.when(F.col("a") % 10 != 0, F.col("a")).alias("a"))
    medians = {
        impute(d, ["a"], relative_error=0.0).where("a IS NULL").first().a_imp
        for d in (holes, holes.coalesce(1), holes.repartition(11))
    }
    assert len(medians) == 1


def test_original_columns_stay(spark):
    df = spark.createDataFrame([("k", 1, None), ("l", 2, 4.0)], "k string, i int, v double")
    rows = impute(df, ["i", "v"], "mean")
    assert rows.columns == ["k", "i", "v", "i_imp", "v_imp"]
    assert [tuple(r) for r in rows.orderBy("k").collect()] == [("k", 1, None, 1.0, 4.0), ("l", 2, 4.0, 2.0, 4.0)]


@pytest.mark.parametrize("strategy", ["mean", "median", "mode"])
@pytest.mark.parametrize("relative_error", [0.0, 0.001])
def test_column_without_values(spark, strategy, relative_error):
    with pytest.raises(ValueError, match="no value at all in .*a.b"):
        filled(spark, [None, math.nan], strategy, relative_error=relative_error)


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="unknown imputation strategy"):
        filled(spark, [1.0], "max")


def test_cast_and_distinct(spark):
    df = spark.createDataFrame(
        [(0.0, None, 2**53), (-0.0, None, 2**53 + 1), (math.nan, 1, 1), (math.nan, 1, 1)],
        "`a.b` double, i int, l bigint",
    )
    rows = cast_features(df, ["a.b", "i", "l"])
    assert {kind for _, kind in rows.dtypes} == {"double"}
    assert distinct_rows(rows).count() == 2


def test_copies_are_merged_before_the_shuffle(spark):
    rows = distinct_rows(cast_features(spark.range(10), ["id"]))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1


def test_scale(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0)], "`a.b` double, c double")
    rows = standard_scale(assemble(df, ["a.b", "c"]))
    values = sorted(tuple(r[0]) for r in rows.select(vector_to_array("features")).collect())
    assert values == [(-1.0, 0.0), (0.0, 0.0), (1.0, 0.0)]
    assert rows.columns == ["a.b", "c", "features_raw", "features"]


def test_assemble_refuses_null(spark):
    df = spark.createDataFrame([(None,), (1.0,)], "a double")
    with pytest.raises(Exception, match="(?i)null"):
        assemble(df, ["a"]).collect()


@pytest.mark.parametrize("error", [0.0, 0.001])
def test_infinite_median(spark, error):
    df = spark.createDataFrame([(math.inf,), (math.inf,), (1.0,), (None,)], "a double")
    rows = impute(df, ["a"], "median", error)
    assert [r["a_imp"] for r in rows.where("a IS NULL").collect()] == [math.inf]
