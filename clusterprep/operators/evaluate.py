"""Silhouette score and the metrics table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterprep.functions.columns import column

# Metric and distance names.
SILHOUETTE = "silhouette"
SQUARED_EUCLIDEAN = "squaredEuclidean"
COSINE = "cosine"

_NO_CLUSTERS = "the silhouette needs rows in at least two clusters"


def silhouette(
    df: DataFrame,
    features_col: str = "features",
    prediction_col: str = "prediction",
    distance_measure: str = SQUARED_EUCLIDEAN,
    metric_name: str = SILHOUETTE,
    columns: Sequence[str] | None = None,
) -> float:
    """Mean silhouette of a clustering.

    Spark's evaluator works from one summary per cluster, so it is linear in
    the rows: no pair of rows is ever compared. Few features in few clusters
    may be given as `columns` of doubles instead of vectors: the squared
    distance then takes the same two passes by expressions over them.
    """
    if columns and (distance_measure, metric_name) == (SQUARED_EUCLIDEAN, SILHOUETTE):
        return _silhouette_of_columns(df, columns, prediction_col)
    if columns:
        df = df.withColumn(features_col, array_to_vector(F.array(*map(column, columns))))
    evaluator = ClusteringEvaluator(
        featuresCol=features_col,
        predictionCol=prediction_col,
        metricName=metric_name,
        distanceMeasure=distance_measure,
    )
    try:
        return float(evaluator.evaluate(df))
    except Exception as error:
        if "Number of clusters must be greater than one" in str(error):
            raise ValueError(_NO_CLUSTERS) from error
        raise


def _silhouette_of_columns(df: DataFrame, columns: Sequence[str], prediction_col: str) -> float:
    values = [column(name) for name in columns]
    squared = sum((v * v for v in values[1:]), start=values[0] * values[0])
    clusters = (
        df.groupBy(column(prediction_col).alias("cluster"))
        .agg(F.count(F.lit(1)), F.sum(squared), *[F.sum(v) for v in values])
        .orderBy("cluster")
        .collect()  # one row per cluster
    )
    if len(clusters) < 2:
        raise ValueError(_NO_CLUSTERS)

    def distance(size: int, squares: float, *sums: float) -> Column:
        """Mean squared distance of a row to the rows of a cluster."""
        products = [v * F.lit(2 * x / size) for v, x in zip(values, sums)]
        return sum((-p for p in products), start=F.col("squared") + F.lit(squares / size))

    names = [f"to{j}" for j in range(len(clusters))]
    distances = df.select("*", squared.alias("squared")).select(
        column(prediction_col).alias("cluster"),
        *[distance(*row[1:]).alias(name) for row, name in zip(clusters, names)],
    )
    own, others, size = F, [], F
    for row, name in zip(clusters, names):
        here = F.col("cluster") == F.lit(row["cluster"])
        # A row does not count among its own neighbours.
        own = own.when(here, F.col(name) * F.lit(row[1] / max(1, row[1] - 1)))
        size = size.when(here, F.lit(row[1]))
        others.append(F.when(~here, F.col(name)))
    pairs = distances.select(own.alias("own"), F.least(*others).alias("other"), size.alias("size"))
    score = (
        F.when(F.col("size") == 1, F.lit(0.0))
        .when(F.col("own") < F.col("other"), 1 - F.try_divide("own", "other"))
        .when(F.col("own") > F.col("other"), F.try_divide("other", "own") - 1)
        .otherwise(F.lit(0.0))
    )
    return float(pairs.agg(F.avg(score)).first()[0])


def metrics_table(spark: SparkSession, metrics: dict[str, float]) -> DataFrame:
    """One row {metric, value} per metric."""
    rows = [
        F.struct(F.lit(name).alias("metric"), F.lit(float(value)).alias("value"))
        for name, value in metrics.items()
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))
