import math
import re

import pytest
from pyspark.errors import IllegalArgumentException
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from clusterprep import ClusterParams, cluster_table
from clusterprep.operators import cluster, kmeans
from clusterprep.operators.cluster import (
    assign_nearest,
    canonical_labels,
    centroid_update,
    fit_clusters,
    stable_layout,
)
from clusterprep.operators.evaluate import metrics_table, silhouette


def blobs(spark, partitions=4):
    """Three groups. A missing y is filled with another group's value, so only rows
    with a y must be found in their group; filled rows go to the nearest centre."""
    i = F.col("id")
    return spark.range(0, 600, 1, partitions).select(
        ((i % 3) * 100 + (i * 37 % 11)).cast("double").alias("a.b"),
        F.when(i % 50 != 7, (i % 3) * 10 + (i * 17 % 5) / 10).alias("y"),
        ((i % 3) * 50 + (i * 13 % 7)).cast("double").alias("z"),
        (i % 3).cast("int").alias("group"),
    )


def test_canonical_labels():
    assert canonical_labels([(2.0, 0.0), (1.0, 5.0), (1.0, 4.0)]) == (2, 1, 0)


@pytest.mark.parametrize("partitions", [1, 4, 8])
@pytest.mark.parametrize("strategy", ["median", "mean", "mode"])
def test_groups_are_found_and_numbered_by_position(spark, partitions, strategy):
    rows = blobs(spark, partitions).repartition(partitions).cache()
    model = fit_clusters(rows, ["a.b", "y", "z"], k=3, strategy=strategy)
    scored = model.predict(rows)
    assert scored.columns == ["a.b", "y", "z", "group", "prediction"]
    assert dict(scored.dtypes)["prediction"] == "int"
    assert scored.where("y IS NOT NULL AND prediction != group").count() == 0
    assert scored.where("y IS NOT NULL").count() > 0.95 * scored.count() == 0.95 * 600


@pytest.mark.parametrize("strategy", ["median", "mean", "mode"])
def test_prediction_is_the_nearest_center_in_scaled_space(spark, strategy):
    rows = blobs(spark)
    model = fit_clusters(rows, ["a.b", "y"], k=4, seed=3, strategy=strategy)
    scored = model.score(rows).select(vector_to_array("features").alias("v"), "prediction")
    points = scored.select(F.col("v")[0].alias("p"), F.col("v")[1].alias("q"), F.col("prediction").alias("given"))
    nearest = assign_nearest(points, ["p", "q"], model.centers)
    assert nearest.where("prediction != given").count() == 0
    assert sum(r["count"] for r in nearest.groupBy("given").count().collect()) == 600


def test_stable_layout_gives_one_result_for_any_input(spark):
    rows = spark.range(0, 3000, 1, 4).select(
        (F.col("id") * 7919 % 3001).cast("double").alias("a"),
        (F.col("id") * 104729 % 2999).cast("double").alias("b"),
    )
    centers = set()
    for df in (rows, rows.coalesce(1), rows.repartition(7)):
        model = fit_clusters(stable_layout(df, ["a", "b"]), ["a", "b"], k=3, relative_error=0.0)
        centers.add(tuple(round(x, 9) for c in model.centers for x in c))
    assert len(centers) == 1


def test_reserved_names(spark):
    df = spark.createDataFrame([(1.0, 2.0)], ["prediction", "a"])
    with pytest.raises(ValueError, match="prediction"):
        fit_clusters(df, ["a"])


def test_column_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "`a.b` double, c double")
    with pytest.raises(ValueError, match="a.b"):
        fit_clusters(df, ["a.b", "c"])


def test_identical_rows_have_no_silhouette(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], ["a"])
    scored = fit_clusters(df, ["a"], k=2).score(df)
    with pytest.raises(ValueError, match="at least two clusters"):
        silhouette(scored)


@pytest.mark.parametrize("flat", [0, 1000])
def test_both_forms_of_nearest(spark, monkeypatch, flat):
    monkeypatch.setattr(cluster, "_FLAT_COORDINATES", flat)
    df = spark.createDataFrame([(0.0, 0.0), (5.0, 5.0), (10.0, 9.0), (5.0, 6.0)], "`a.b` double, c double")
    centers = [[0.0, 0.0], [10.0, 10.0], [0.0, 0.0]]
    rows = assign_nearest(df, ["a.b", "c"], centers)
    assert dict(rows.dtypes)["prediction"] == "int"
    found = {(r["a.b"], r["c"]): r["prediction"] for r in rows.collect()}
    assert found == {(0.0, 0.0): 0, (5.0, 5.0): 0, (10.0, 9.0): 1, (5.0, 6.0): 1}
    assert "Join" not in rows._jdf.queryExecution().executedPlan().toString()


def test_centroid_update(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (9.0,), (None,)], "`a.b` double")
    rows = {tuple(r) for r in centroid_update(df, ["a.b"], [[0.0], [10.0], [99.0]]).collect()}
    assert rows == {(0, 2, 1.0), (1, 1, 9.0), (2, 0, 99.0)}


@pytest.mark.parametrize("flat", [0, 1000])
def test_rows_with_a_missing_value_have_no_nearest_center(spark, monkeypatch, flat):
    monkeypatch.setattr(cluster, "_FLAT_COORDINATES", flat)
    df = spark.createDataFrame([(math.nan, 0), (9.0, 1), (None, 2)], "a double, id int")
    rows = assign_nearest(df, ["a"], [[0.0], [10.0]])
    assert {r["id"]: r["prediction"] for r in rows.collect()} == {0: None, 1: 1, 2: None}


def brute_force_silhouette(points, distance):
    total = 0.0
    for i, (v, c) in enumerate(points):
        by = {}
        for j, (w, d) in enumerate(points):
            if i != j:
                by.setdefault(d, []).append(distance(v, w))
        if c not in by:
            continue
        a = sum(by[c]) / len(by[c])
        b = min(sum(x) / len(x) for d, x in by.items() if d != c)
        total += 0.0 if a == b else (b - a) / max(a, b)
    return total / len(points)


def squared(v, w):
    return sum((x - y) ** 2 for x, y in zip(v, w))


def cosine(v, w):
    dot = sum(x * y for x, y in zip(v, w))
    return 1 - dot / math.sqrt(sum(x * x for x in v) * sum(y * y for y in w))


@pytest.mark.parametrize("name,distance", [("squaredEuclidean", squared), ("cosine", cosine)])
def test_silhouette_against_all_pairs(spark, name, distance):
    points = [((1.0 + i % 5, 1.0 + i * 7 % 11), i % 3) for i in range(40)] + [((50.0, 1.0), 9)]
    df = spark.createDataFrame([(list(v), c) for v, c in points], "v array<double>, c int")
    df = df.select(array_to_vector("v").alias("features"), F.col("c").alias("prediction"))
    expected = brute_force_silhouette(points, distance)
    assert silhouette(df, distance_measure=name) == pytest.approx(expected)


def test_metrics_table(spark):
    table = metrics_table(spark, {"silhouette": 0.5, "other": 1})
    assert table.dtypes == [("metric", "string"), ("value", "double")]
    assert [tuple(r) for r in table.collect()] == [("silhouette", 0.5), ("other", 1.0)]


def uneven(spark, partitions=5):
    """Rows without clear groups, some values missing, in partitions of uneven size."""
    i = F.col("id")
    return spark.range(0, 2000, 1, partitions).select(
        F.when(i % 40 != 3, i * 7919 % 997 / 10).alias("a.b"),
        F.when(i % 90 == 4, math.nan).otherwise(i * i * 31 % 499 / 7).alias("y"),
        (i % 2 * 30 + i * 104729 % 41).cast("double").alias("z"),
    ).where("z != 7 OR y > 30")


@pytest.mark.parametrize("k,seed,partitions", [(2, 42, 37), (3, -7, 5), (4, 2**40 + 5, 64)])
def test_expressions_give_the_result_of_pyspark_ml(spark, monkeypatch, k, seed, partitions):
    rows = stable_layout(uneven(spark, partitions), ["a.b", "y", "z"]).cache()
    found = {}
    for many in (10**9, 0):
        monkeypatch.setattr(cluster, "_MANY_ROWS", many)
        model = fit_clusters(rows, ["a.b", "y", "z"], k=k, seed=seed)
        scored = model.score(rows).withColumn("features", vector_to_array("features"))
        assert scored.columns == [*rows.columns, "features", "prediction"]
        assert dict(scored.dtypes)["prediction"] == "int"
        found[many] = model, scored.collect()
    (old, theirs), (new, ours) = found[10**9], found[0]
    assert new.labels == old.labels and len(new.centers) == k
    for ours_of, theirs_of in zip(new.centers, old.centers):
        assert ours_of == pytest.approx(theirs_of, rel=1e-9, abs=1e-9)
    for a, b in zip(ours, theirs, strict=True):
        assert a["prediction"] == b["prediction"]
        assert a["features"] == pytest.approx(b["features"], rel=1e-9, abs=1e-9)
    by_stages = new.pipeline.transform(cluster._with_safe_names(rows, new.feature_cols))
    assert [new.labels[r["__cluster"]] for r in by_stages.collect()] == [r["prediction"] for r in ours]


def test_many_rows_of_few_features_need_no_vectors(spark, monkeypatch):
    """Neither the fit nor the score makes or keeps an object per row."""
    expected = cluster_table(uneven(spark), ClusterParams(k=3))
    monkeypatch.setattr(cluster, "_MANY_ROWS", 1000)

    def refused(*args, **options):
        raise AssertionError("vectors")

    for kind in (KMeans, StandardScaler):
        monkeypatch.setattr(kind, "_fit", refused)
    monkeypatch.setattr(ClusteringEvaluator, "_evaluate", refused)
    result = cluster_table(uneven(spark), ClusterParams(k=3))
    assert result.score == pytest.approx(expected.score)
    assert result.predictions.count() == expected.predictions.count() == 1981


@pytest.mark.parametrize("k,few", [(2, True), (12, True), (13, False)])
def test_many_coordinates_go_to_pyspark_ml(spark, monkeypatch, k, few):
    monkeypatch.setattr(cluster, "_MANY_ROWS", 0)
    result = cluster_table(uneven(spark), ClusterParams(k=k))
    assert bool(result.model.scaled_cols) == few
    assert {r[0] for r in result.predictions.select("prediction").distinct().collect()} == set(range(k))
    assert -1 <= result.score <= 1


@pytest.mark.parametrize("many", [0, 10**9])
def test_one_cluster_is_refused(spark, monkeypatch, many):
    monkeypatch.setattr(cluster, "_MANY_ROWS", many)
    with pytest.raises(IllegalArgumentException, match="parameter k"):
        fit_clusters(uneven(spark), ["y", "z"], k=1)


def test_fewer_different_rows_than_centers(spark, monkeypatch):
    monkeypatch.setattr(cluster, "_MANY_ROWS", 0)
    df = spark.createDataFrame([(1.0,), (1.0,), (4.0,)], ["a"])
    model = fit_clusters(df, ["a"], k=5)
    assert len(model.centers) == 2
    assert [r["prediction"] for r in model.predict(df).orderBy("a").collect()] == [0, 0, 1]


@pytest.mark.parametrize("start", [0, 1, 42, -5, 2**31 - 1, -(2**31)])
def test_random_numbers_of_a_partition(spark, start):
    rows = spark.range(0, 26, 1, 13)
    found = rows.select(F.spark_partition_id(), kmeans._rand_by_partition(start, 13)).collect()
    random = spark._jvm.org.apache.spark.util.random.XORShiftRandom
    for part in range(13):
        draw = random(start ^ part)
        assert [r[1] for r in found if r[0] == part] == [draw.nextDouble(), draw.nextDouble()]


def test_nearest_of_equal_distances_is_the_first(spark):
    df = spark.createDataFrame([(5.0, 1.0), (9.0, 1.0)], "`a.b` double, c double")
    rows = kmeans.with_nearest(df, ["a.b", "c"], [[9.5, 1.0], [4.0, 1.0], [6.0, 1.0], [4.0, 1.0]])
    assert [tuple(r)[-2:] for r in rows.collect()] == [(1, 1.0), (0, 0.25)]


@pytest.mark.parametrize("distance_measure,distance", [("squaredEuclidean", squared), ("cosine", cosine)])
def test_silhouette_of_columns_against_all_pairs(spark, distance_measure, distance):
    points = [((1.0 + i % 5, 1.0 + i * 7 % 11), i % 3) for i in range(40)] + [((50.0, 1.0), 9)]
    df = spark.createDataFrame([(*v, c) for v, c in points], "`x.1` double, y double, prediction int")
    found = silhouette(df, distance_measure=distance_measure, columns=["x.1", "y"])
    assert found == pytest.approx(brute_force_silhouette(points, distance))
    with pytest.raises(ValueError, match="at least two clusters"):
        silhouette(df.where("prediction = 1"), distance_measure=distance_measure, columns=["x.1", "y"])


def test_silhouette_of_columns_where_all_rows_are_equal(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 0), (1.0, 1), (1.0, 1)], "x double, prediction int")
    assert silhouette(df, columns=["x"]) == 0.0


@pytest.mark.parametrize("features,k", [(3, 2), (12, 2), (2, 12)])
def test_draws_are_short_code(spark, capsys, features, k):
    """The JVM compiles no method of more than 8,000 bytes, and then takes sixty times as long."""
    assert features * k <= cluster._FEW_COORDINATES
    rows = spark.range(100).select(*[F.expr(f"(coalesce(id, {i}) - 2D) * 0.3D AS f{i}") for i in range(features)])
    candidates = [[0.1 * i + j for i in range(features)] for j in range(1 + 4 * k)]
    draw = kmeans._rand_by_partition(444271815, 600)
    drawn = kmeans.drawn_rows(rows, rows.columns, candidates, draw, 2.0 * k, 3.0)
    drawn.explain("codegen")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
