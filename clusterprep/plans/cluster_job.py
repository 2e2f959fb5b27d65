"""The whole job: prepare, fit, predict, score, save."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from clusterprep.functions.columns import column
from clusterprep.operators.cluster import PREDICTION, ClusterModel, fit_clusters, stable_layout
from clusterprep.operators.evaluate import (
    SILHOUETTE,
    SQUARED_EUCLIDEAN,
    metrics_table,
    silhouette,
)
from clusterprep.operators.impute import RELATIVE_ERROR
from clusterprep.plans.prepare import (
    MIN_NON_NULL_RATIO,
    SEED,
    PreparedData,
    prepare_training_data,
)
from clusterprep.session import cut_lineage, held
from clusterprep.sinks.tables import Target, save_results
from clusterprep.sources.files import read_parquet


@dataclass(frozen=True)
class ClusterParams:
    """Parameters of a job; `seed` serves the sample and k-means."""

    min_non_null_ratio: float = MIN_NON_NULL_RATIO
    target_rows: int | None = None
    seed: int = SEED
    sampling: str = "exact"
    exclude: tuple[str, ...] = ()
    imputer_strategy: str = "median"
    relative_error: float = RELATIVE_ERROR
    k: int = 2
    metric_name: str = SILHOUETTE
    distance_measure: str = SQUARED_EUCLIDEAN


@dataclass(frozen=True)
class ClusterResult:
    """Feature rows with `prediction`, the metrics table, the model and its (written) input."""

    predictions: DataFrame
    metrics: DataFrame
    score: float
    model: ClusterModel
    prepared: PreparedData


def load_training_data(spark: SparkSession, path: str, params: ClusterParams) -> PreparedData:
    """Read a Parquet table and prepare it."""
    return prepare_training_data(
        read_parquet(spark, path),
        min_non_null_ratio=params.min_non_null_ratio,
        target_rows=params.target_rows,
        seed=params.seed,
        exclude=params.exclude,
        sampling=params.sampling,
    )


def cluster_prepared(prepared: PreparedData, params: ClusterParams) -> ClusterResult:
    """Fit, predict and score prepared rows.

    The rows are laid out by value, so that the result does not depend on the
    input's files, and held in that layout for the passes that draw from them.
    They are also written to the shared folder, which other passes and the
    result read: a written table takes the fewest bytes, but would be packed
    into partitions by file size.
    """
    rows = stable_layout(prepared.df, prepared.feature_cols)
    with held(rows):
        written = cut_lineage(rows, "prepared")
        model = fit_clusters(
            rows,
            prepared.feature_cols,
            k=params.k,
            seed=params.seed,
            strategy=params.imputer_strategy,
            relative_error=params.relative_error,
            copy=written,
        )
    scored = model.placed(written) if model.scaled_cols else model.score(written)
    score = silhouette(
        scored,
        distance_measure=params.distance_measure,
        metric_name=params.metric_name,
        columns=model.scaled_cols,
    )
    predictions = scored.select(*[column(c) for c in prepared.feature_cols], PREDICTION)
    metrics = metrics_table(rows.sparkSession, {params.metric_name: score})
    return ClusterResult(predictions, metrics, score, model, replace(prepared, df=written))


def cluster_table(df: DataFrame, params: ClusterParams = ClusterParams()) -> ClusterResult:
    """Prepare a table, group its rows and score the grouping."""
    prepared = prepare_training_data(
        df,
        min_non_null_ratio=params.min_non_null_ratio,
        target_rows=params.target_rows,
        seed=params.seed,
        exclude=params.exclude,
        sampling=params.sampling,
    )
    return cluster_prepared(prepared, params)


def run(
    spark: SparkSession,
    input_path: str,
    target: Target,
    params: ClusterParams = ClusterParams(),
    as_strings: bool = False,
) -> ClusterResult:
    """Read a Parquet table, cluster it and replace the stored results."""
    result = cluster_prepared(load_training_data(spark, input_path, params), params)
    save_results(result.predictions, result.metrics, target, as_strings)
    return result
