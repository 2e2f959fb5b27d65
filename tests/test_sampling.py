import pytest
from pyspark.sql import functions as F

from clusterprep.functions.columns import md5_rank, row_rank
from clusterprep.operators.sampling import (
    first_rows,
    sample_bernoulli,
    sample_fraction,
    sample_lowest,
)
from clusterprep.plans.sample_file import write_sample
from clusterprep.session import fresh_path


def rows_of(df):
    return sorted(tuple(row) for row in df.collect())


def brute_force(df, n, rank):
    rows = df.distinct().withColumn("r", rank).collect()
    return sorted(tuple(row)[:-1] for row in sorted(rows, key=lambda r: (r["r"], tuple(r)))[:n])


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(0, 5000, 1, 4).select("id", (F.col("id") * 1.5).alias("x")).cache()


@pytest.mark.parametrize("n", [1, 10, 1000, 4999])
def test_exact_size_and_the_lowest_ranks(numbers, n):
    rank = row_rank(["id", "x"], 42)
    assert rows_of(sample_lowest(numbers, n, rank)) == brute_force(numbers, n, rank)


@pytest.mark.parametrize("n", [5000, 6000])
def test_no_more_rows_than_wanted(numbers, n):
    assert sample_lowest(numbers, n, row_rank(["id"], 1)).count() == 5000


def test_layout_does_not_matter(numbers):
    rank = row_rank(["id", "x"], 7)
    samples = [sample_lowest(df, 500, rank) for df in (numbers, numbers.repartition(9), numbers.coalesce(1))]
    assert len({tuple(rows_of(s)) for s in samples}) == 1


def test_seeds_differ(numbers):
    first, second = (rows_of(sample_lowest(numbers, 500, row_rank(["id"], s))) for s in (1, 2))
    assert 20 < len(set(first) & set(second)) < 100


def test_distinct_sample_with_one_row_copied_to_a_third(spark):
    single = spark.range(0, 4000, 1, 4).select((F.col("id") % 2500).cast("double").alias("a"))
    copies = spark.range(0, 2000, 1, 4).select(F.lit(7.0).alias("a"))
    df = single.unionAll(copies)
    rank = row_rank(["a"], 42)
    for n in (5, 300, 2400):
        sample = sample_lowest(df, n, rank, distinct=True)
        assert rows_of(sample) == brute_force(df, n, rank)
    assert sample_lowest(df, 2600, rank, distinct=True).count() == 2500


def test_ties_are_settled_by_the_values(spark):
    df = spark.createDataFrame([(i, "k") for i in range(50)], "id int, k string").repartition(5)
    sample = sample_lowest(df, 10, row_rank(["k"], 42))
    assert rows_of(sample) == [(i, "k") for i in range(10)]


def test_rank_is_uniform_and_sees_nulls(spark):
    df = spark.range(0, 20_000, 1, 4).select(row_rank(["id"], 3).alias("r"))
    low, high, mean = df.agg(F.min("r"), F.max("r"), F.avg("r")).first()
    assert 0 <= low < 0.001 and 0.999 < high < 1 and abs(mean - 0.5) < 0.01
    pair = spark.createDataFrame([(None, 1.0), (1.0, None), (None, None)], "a double, b double")
    for rank in (row_rank(["a", "b"], 1), md5_rank(["a", "b"], 1)):
        assert pair.select(rank.alias("r")).distinct().count() == 3


def test_signed_zero_has_one_rank(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], ["a"])
    assert df.select(row_rank(["a"], 1).alias("r")).distinct().count() == 1


def test_fraction(numbers):
    sample = sample_fraction(numbers, 0.1, row_rank(["id"], 42))
    assert 400 < sample.count() < 600
    assert sample.join(numbers, ["id", "x"], "left_anti").count() == 0
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_bernoulli_is_capped_and_a_subset(numbers):
    sample = sample_bernoulli(numbers, 1000, 42).cache()
    assert 850 < sample.count() <= 1000
    assert sample.join(numbers, ["id", "x"], "left_anti").count() == 0
    assert sample_bernoulli(numbers, 5000, 42).count() == 5000


def test_size_must_be_positive(numbers):
    with pytest.raises(ValueError, match="at least 1"):
        sample_lowest(numbers, 0, row_rank(["id"], 1))


@pytest.fixture(scope="module")
def table(spark):
    path = fresh_path(spark, "a table")  # the blank is on purpose
    spark.range(0, 1000, 1, 10).select("id", F.col("id").cast("string").alias("s")).write.parquet(path)
    return path


@pytest.mark.parametrize("n", [1, 99, 100, 101, 250, 999, 1000, 2000])
def test_first_rows(spark, table, n):
    df = spark.read.parquet(table)
    rows = rows_of(first_rows(df, n))
    assert len(rows) == len(set(rows)) == min(n, 1000)
    assert set(rows) <= set(rows_of(df))


def test_plan_of_first_rows_does_not_grow_with_the_files(spark, table):
    sizes = []
    for partitions in (2, 300):
        path = fresh_path(spark, "files")
        spark.range(0, 1000, 1, partitions).write.parquet(path)
        rows = first_rows(spark.read.parquet(path), 900)
        assert rows.count() == 900
        sizes.append(len(rows._jdf.queryExecution().optimizedPlan().toString()))
    assert sizes[0] == sizes[1]


def test_first_rows_without_files(numbers):
    assert first_rows(numbers.groupBy("id").count(), 17).count() == 17


def test_write_sample_is_one_file_and_replaces(spark, table):
    out = fresh_path(spark, "copy")
    write_sample(spark, table, out, 300, files=3)
    assert len(spark.read.parquet(out).inputFiles()) == 3
    write_sample(spark, table, out, 120)
    copy = spark.read.parquet(out)
    assert len(copy.inputFiles()) == 1 and copy.count() == 120
    assert copy.columns == ["id", "s"]


def test_one_row_copied_to_a_third_is_cut_inside_its_copies(spark):
    copies = spark.range(0, 2000, 1, 4).select(F.lit(7.0).alias("a"), F.lit(None).cast("int").alias("b"))
    others = spark.range(0, 4000, 1, 4).select(F.col("id").cast("double").alias("a"), F.lit(1).alias("b"))
    df = others.unionAll(copies)
    rank = row_rank(["a", "b"], 42)
    below = df.where(rank < copies.select(rank).first()[0]).count()
    sample = sample_lowest(df, below + 700, rank)
    assert sample.count() == below + 700
    assert sample.where("b IS NULL").count() == 700
    assert "SinglePartition" not in sample._jdf.queryExecution().executedPlan().toString()


def test_bernoulli_has_no_single_task(numbers):
    plan = sample_bernoulli(numbers, 1000, 42)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_signed_zero_has_one_md5_rank(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], ["a"])
    assert df.select(md5_rank(["a"], 1).alias("r")).distinct().count() == 1
    texts = spark.createDataFrame([("0.0",), ("-0.0",)], ["a"])
    assert texts.select(md5_rank(["a"], 1).alias("r")).distinct().count() == 2
