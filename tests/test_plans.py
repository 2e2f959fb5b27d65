import pytest
from pyspark.sql import functions as F

from clusterprep import ClusterParams, cluster_table, prepare_training_data, run
from clusterprep.functions.columns import row_rank
from clusterprep.operators.cluster import fit_clusters, stable_layout
from clusterprep.plans import cluster_job
from clusterprep.session import checkpointed, fresh_path, held
from clusterprep.sinks.tables import PREDICTIONS_TABLE, ParquetTarget, results_summary


def frame(spark, partitions=4):
    i = F.col("id")
    return spark.range(0, 3000, 1, partitions).select(
        (i % 1000).cast("int").alias("z.n"),
        F.when(i % 10 == 0, None).otherwise(i % 7).alias("holes"),
        F.when(i % 2 == 0, i).alias("sparse"),
        F.lit(3.7).alias("const"),
        F.lit("t").alias("text"),
        (i % 1000 * 2.5).alias("a"),
    )


def test_preparation(spark):
    df = frame(spark)
    prepared = prepare_training_data(df)
    assert prepared.feature_cols == ("z.n", "holes", "a") and prepared.total_rows == 3000
    assert prepared.df.dtypes == [(c, "double") for c in prepared.feature_cols]
    expected = df.select("`z.n`", "holes", "a").distinct()
    assert prepared.working_rows == expected.count()
    assert prepared.df.exceptAll(expected).count() == 0


def test_exact_sample_is_the_same_for_any_layout(spark):
    samples = []
    for partitions in (1, 4, 9):
        prepared = prepare_training_data(frame(spark, partitions), target_rows=200)
        assert prepared.working_rows == 200
        samples.append(sorted(map(str, prepared.df.collect())))
    assert samples[0] == samples[1] == samples[2]
    whole = prepare_training_data(frame(spark), target_rows=None).df
    lowest = whole.orderBy(row_rank(whole.columns, 42)).limit(200)
    assert sorted(map(str, lowest.collect())) == samples[0]


def test_bernoulli_sample(spark):
    prepared = prepare_training_data(frame(spark), target_rows=500, sampling="bernoulli")
    whole = prepare_training_data(frame(spark), target_rows=None).df
    assert 350 < prepared.working_rows <= 500
    assert prepared.df.exceptAll(whole).count() == 0


def test_exclude(spark):
    assert prepare_training_data(frame(spark), exclude=["z.n"]).feature_cols == ("holes", "a")


@pytest.mark.parametrize(
    "change,message",
    [
        (lambda df: df.limit(0), "empty"),
        (lambda df: df.select("text"), "no numeric columns"),
        (lambda df: df.select("sparse"), "enough non-null"),
        (lambda df: df.select("const"), "varies"),
    ],
)
def test_guards(spark, change, message):
    with pytest.raises(ValueError, match=message):
        prepare_training_data(change(frame(spark)))


def test_unknown_sampling(spark):
    with pytest.raises(ValueError, match="sampling"):
        prepare_training_data(frame(spark), sampling="any")


def test_whole_job_does_not_depend_on_the_layout(spark):
    params = ClusterParams(k=3, target_rows=400, relative_error=0.0)
    results = [cluster_table(frame(spark, n), params) for n in (1, 4, 8)]
    assert len({round(r.score, 9) for r in results}) == 1
    rows = [sorted(map(str, r.predictions.collect())) for r in results]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 400
    assert results[0].predictions.columns == ["z.n", "holes", "a", "prediction"]
    assert results[0].predictions.where("holes IS NULL").count() > 0


@pytest.mark.parametrize("distance", ["squaredEuclidean", "cosine"])
def test_run_reads_and_saves(spark, distance):
    path = fresh_path(spark, "source")
    frame(spark).write.parquet(path)
    target = ParquetTarget(fresh_path(spark, "out"))
    params = ClusterParams(target_rows=300, distance_measure=distance)
    result = run(spark, path, target, params)
    assert target.read(spark, PREDICTIONS_TABLE).count() == 300
    assert tuple(results_summary(spark, target).first()) == ("silhouette", result.score, 300)
    assert -1 <= result.score <= 1


def overlapping(spark, partitions):
    """Rows without clear groups, in so many partitions."""
    i = F.col("id")
    return spark.range(0, 6000, 1, partitions).select(
        (i * 7919 % 50).cast("double").alias("q"),
        (i * 104729 % 9973).cast("double").alias("p"),
        (i * 31 % 11 / 100).alias("d"),
    )


@pytest.mark.parametrize("target_rows", [None, 2000])
def test_clusters_repeat(spark, target_rows):
    """Ordinary data, many partitions: the same centres for any layout, each time."""
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    before = {name: spark.conf.get(name) for name in settings}
    params = ClusterParams(k=5, target_rows=target_rows)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = [
            cluster_table(overlapping(spark, partitions), params)
            for partitions in (1, 3, 40)
            for _ in range(2)
        ]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    centers = [[x for center in result.model.centers for x in center] for result in found]
    for other in centers[1:]:
        assert other == pytest.approx(centers[0], rel=1e-9)
    assert len({round(result.score, 9) for result in found}) == 1


def test_all_rows_are_clustered_unless_a_sample_is_asked_for(spark):
    df = spark.range(0, 120_000, 1, 8).select(F.col("id").cast("double").alias("x"))
    result = cluster_table(df)
    assert result.predictions.count() == 120_000
    assert ClusterParams().target_rows is None


def test_prepared_rows_are_held_while_the_job_passes_over_them(spark, monkeypatch):
    rows = spark.range(400).selectExpr("id % 7 * 1D AS x", "id * 1D AS y")
    seen = []

    def fit(df, *args, **options):
        seen.append(df.storageLevel)
        return fit_clusters(df, *args, **options)

    monkeypatch.setattr(cluster_job, "fit_clusters", fit)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    result = cluster_table(rows)
    assert seen[0].useDisk and not seen[0].useMemory
    assert not result.prepared.df.storageLevel.useDisk
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before
    assert result.predictions.count() == 400


def test_held_rows_keep_their_partitions_and_order(spark):
    rows = checkpointed(stable_layout(spark.range(500).selectExpr("id * 1D AS x"), ["x"]))
    plain = rows.withColumn("part", F.spark_partition_id()).collect()
    with held(rows):
        kept = rows.withColumn("part", F.spark_partition_id())
        assert "InMemoryTableScan" in kept._jdf.queryExecution().executedPlan().toString()
        assert kept.collect() == plain
    assert rows.withColumn("part", F.spark_partition_id()).collect() == plain
