"""K-means: fit, assignment, canonical cluster ids and one explicit update step."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.clustering import KMeans
from pyspark.ml.common import _py2java
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.mllib.common import _py2java as _mllib_py2java
from pyspark.mllib.linalg import Vectors as MLlibVectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterprep.functions.columns import column
from clusterprep.operators.impute import (
    RELATIVE_ERROR,
    SUFFIX,
    count_known_values,
    imputer_stage,
)
from clusterprep.operators.kmeans import NEAREST, k_means, with_nearest
from clusterprep.session import held

FEATURES = "features"
PREDICTION = "prediction"

_RAW_VECTOR = "__raw"
_RAW_PREDICTION = "__cluster"

# Centres with more coordinates than this are compared by a loop over arrays,
# fewer by one flat expression that whole-stage codegen compiles.
_FLAT_COORDINATES = 256

# From so many rows, centres with at most so many coordinates are fitted by
# expressions over columns. These compare a row with about four times as many
# candidates, in methods of less than the 8,000 bytes that the JVM compiles. Fewer
# rows fit the workers' memory as the vectors of `KMeans`, which then takes less
# time per step; the result is the same.
_MANY_ROWS = 4_000_000
_FEW_COORDINATES = 24


@dataclass(frozen=True)
class ClusterModel:
    """Fitted impute, assemble, scale and k-means stages over named features.

    `labels[i]` is the canonical id of the i-th k-means centre.
    """

    feature_cols: tuple[str, ...]
    pipeline: PipelineModel
    labels: tuple[int, ...]

    @property
    def centers(self) -> list[list[float]]:
        """Centres in the scaled space, by canonical id."""
        return sorted([float(x) for x in c] for c in self.pipeline.stages[-1].clusterCenters())

    @property
    def scaled_cols(self) -> list[str] | None:
        """Names of the scaled features in `placed`; none if there are too many for it."""
        if len(self.labels) * len(self.feature_cols) > _FEW_COORDINATES:
            return None
        return [_scaled_name(i) for i in range(len(self.feature_cols))]

    def placed(self, df: DataFrame) -> DataFrame:
        """All columns of the frame, the scaled features as doubles and `prediction`."""
        filler, _, scaler, kmeans = self.pipeline.stages
        filled = filler.transform(_with_safe_names(df, self.feature_cols))
        kept = [column(name) for name in df.columns]
        scaled = filled.select(*kept, *_scaled_columns(scaler.mean, scaler.std))
        near = with_nearest(scaled, self.scaled_cols, kmeans.clusterCenters())
        canonical = F.element_at(F.lit(list(self.labels)), F.col(NEAREST) + 1)
        return near.select(*kept, *self.scaled_cols, canonical.cast("int").alias(PREDICTION))

    def score(self, df: DataFrame) -> DataFrame:
        """All columns of the frame, the scaled `features` vector and `prediction`."""
        if self.scaled_cols:
            features = array_to_vector(F.array(*self.scaled_cols)).alias(FEATURES)
            kept = [column(name) for name in df.columns]
            return self.placed(df).select(*kept, features, PREDICTION)
        scored = self.pipeline.transform(_with_safe_names(df, self.feature_cols))
        canonical = F.element_at(F.array(*map(F.lit, self.labels)), F.col(_RAW_PREDICTION) + 1)
        return scored.select(
            *[column(name) for name in df.columns],
            F.col(FEATURES),
            canonical.cast("int").alias(PREDICTION),
        )

    def predict(self, df: DataFrame) -> DataFrame:
        """All columns of the frame and `prediction`."""
        return self.score(df).drop(FEATURES)


def fit_clusters(
    df: DataFrame,
    feature_cols: Sequence[str],
    k: int = 2,
    seed: int = 42,
    strategy: str = "median",
    relative_error: float = RELATIVE_ERROR,
    copy: DataFrame | None = None,
) -> ClusterModel:
    """Fit impute -> assemble -> scale -> k-means (Euclidean) on the named columns.

    `copy` may give the same rows in any layout, such as a written table, for
    the passes that need no certain one.
    """
    taken = {FEATURES, PREDICTION} & set(df.columns)
    if taken:
        raise ValueError(f"the input must not have columns named {sorted(taken)}")
    wide = _with_safe_names(df, feature_cols)
    safe = _safe_names(feature_cols)
    sizes = count_known_values(wide, dict(zip(safe, feature_cols)))
    imputer = imputer_stage(wide, sizes, strategy, relative_error)
    stages = [
        imputer,
        VectorAssembler(inputCols=[s + SUFFIX for s in safe], outputCol=_RAW_VECTOR),
        StandardScaler(inputCol=_RAW_VECTOR, outputCol=FEATURES, withMean=True, withStd=True),
        KMeans(featuresCol=FEATURES, predictionCol=_RAW_PREDICTION, k=k, seed=seed),
    ]
    if max(sizes.values()) >= _MANY_ROWS and k * len(safe) <= _FEW_COORDINATES:
        kept = df.storageLevel.useDisk or df.storageLevel.useMemory
        with nullcontext() if kept else held(df):
            again = wide if copy is None else _with_safe_names(copy, feature_cols)
            pipeline = _fit_columns(wide, again, *stages)
    else:
        pipeline = Pipeline(stages=stages).fit(wide)
    centers = [tuple(float(x) for x in c) for c in pipeline.stages[-1].clusterCenters()]
    return ClusterModel(tuple(feature_cols), pipeline, canonical_labels(centers))


def _fit_columns(
    wide: DataFrame,
    copy: DataFrame,
    imputer: Imputer | Transformer,
    assembler: VectorAssembler,
    scaler: StandardScaler,
    kmeans: KMeans,
) -> PipelineModel:
    """The fitted stages, learned by passes over plain columns instead of vectors."""
    kmeans._transfer_params_to_java()  # refuses what a fit would refuse
    filler = imputer.fit(wide) if isinstance(imputer, Imputer) else imputer
    inputs = assembler.getInputCols()
    statistics = [f(name) for f in (F.avg, F.stddev_samp) for name in inputs]
    found = filler.transform(copy).agg(*statistics).first()
    means = list(found[: len(inputs)])
    deviations = [x or 0.0 for x in found[len(inputs) :]]  # null for a single row
    scaled = _scaled_columns(means, deviations)
    rows, again = (filler.transform(df).select(*scaled) for df in (wide, copy))
    centers = k_means(rows, again, rows.columns, kmeans.getK(), kmeans.getSeed())

    context = wide.sparkSession.sparkContext
    jvm = wide.sparkSession._jvm.org.apache.spark
    deviation, mean = (_py2java(context, Vectors.dense(v)) for v in (deviations, means))
    points = _mllib_py2java(context, [MLlibVectors.dense(c) for c in centers])
    fitted = {
        scaler: jvm.ml.feature.StandardScalerModel(scaler.uid, deviation, mean),
        kmeans: jvm.ml.clustering.KMeansModel(
            kmeans.uid, jvm.mllib.clustering.KMeansModel(points)
        ),
    }
    models = [stage._copyValues(stage._create_model(java)) for stage, java in fitted.items()]
    return PipelineModel([filler, assembler, *models])


def canonical_labels(centers: Sequence[Sequence[float]]) -> tuple[int, ...]:
    """Rank of each centre in lexicographic order: k-means numbers them arbitrarily."""
    order = sorted(range(len(centers)), key=lambda i: tuple(centers[i]))
    labels = [0] * len(centers)
    for label, i in enumerate(order):
        labels[i] = label
    return tuple(labels)


def stable_layout(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Partition and order *distinct* rows by their values.

    K-means picks its first centres partition by partition, so a fixed seed
    alone does not fix its result; this does, for any layout of the input and
    the same number of shuffle partitions. Distinct rows hash evenly; do not use
    it on rows with many copies.

    The rows go by a hash of their values, not by the values: a distinct before
    this is partitioned by those, and Spark would leave out this shuffle and
    merge the partitions of that one by their size.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [column(name) for name in columns]
    return df.repartition(n, F.xxhash64(*by)).sortWithinPartitions(*by)


def nearest_center(columns: Sequence[str], centers: Sequence[Sequence[float]]) -> Column:
    """Index of the centre nearest to a row; the first one if several are.

    Null for a row with a missing value (null or NaN): fill those first.

    The centres are part of the expression, so rows are neither joined nor
    shuffled.
    """
    doubles = [column(name).cast("double") for name in columns]
    values = [F.nanvl(value, F.lit(None).cast("double")) for value in doubles]
    if len(centers) * len(columns) <= _FLAT_COORDINATES:
        distances = [
            sum(
                ((v - F.lit(float(x))) * (v - F.lit(float(x))) for v, x in zip(values, center)),
                start=F.lit(0.0),
            )
            for center in centers
        ]
        nearest = F.array_min(
            F.array(
                *[
                    F.struct(distance.alias("distance"), F.lit(i).alias("center"))
                    for i, distance in enumerate(distances)
                ]
            )
        )
        return F.when(nearest["distance"].isNotNull(), nearest["center"])
    points = F.lit([[float(x) for x in center] for center in centers])
    distances = F.transform(
        points,
        lambda center, i: F.struct(
            F.aggregate(
                F.zip_with(F.array(*values), center, lambda v, x: (v - x) * (v - x)),
                F.lit(0.0),
                lambda total, part: total + part,
            ).alias("distance"),
            i.alias("center"),
        ),
    )
    nearest = F.array_min(distances)
    return F.when(nearest["distance"].isNotNull(), nearest["center"])


def assign_nearest(
    df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]]
) -> DataFrame:
    """Add `prediction`, the index of the nearest of the given centres."""
    return df.withColumn(PREDICTION, nearest_center(columns, centers))


_SIZE = "__size"


def _mean(i: int) -> str:
    return f"__mean{i}"


def _given(i: int) -> str:
    return f"__given{i}"


def centroid_update(
    df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]]
) -> DataFrame:
    """One k-means step: size and mean of the rows nearest to each given centre.

    One row per centre; a centre without rows has size 0 and stays where it is.
    Rows with a missing value count for none. At most one row per centre and
    task is shuffled, however uneven they are.
    """
    means = (
        assign_nearest(df, columns, centers)
        .where(F.col(PREDICTION).isNotNull())
        .groupBy(PREDICTION)
        .agg(
            F.count(F.lit(1)).alias(_SIZE),
            *[F.avg(column(name).cast("double")).alias(_mean(i)) for i, name in enumerate(columns)],
        )
    )
    given = df.sparkSession.createDataFrame(
        [(i, *map(float, center)) for i, center in enumerate(centers)],
        T.StructType(
            [T.StructField(PREDICTION, T.IntegerType(), False)]
            + [T.StructField(_given(i), T.DoubleType()) for i in range(len(columns))]
        ),
    )
    return given.join(F.broadcast(means), PREDICTION, "left").select(
        PREDICTION,
        F.coalesce(_SIZE, F.lit(0)).cast("long").alias("size"),
        *[F.coalesce(_mean(i), _given(i)).alias(name) for i, name in enumerate(columns)],
    )


def _safe_names(columns: Sequence[str]) -> list[str]:
    return [f"__f{i}" for i in range(len(columns))]


def _with_safe_names(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the features under names without dots, which ML stages do not accept."""
    pairs = zip(_safe_names(columns), columns)
    return df.withColumns({safe: column(name).cast("double") for safe, name in pairs})


def _scaled_name(i: int) -> str:
    return f"__scaled{i}"


def _scaled_columns(means: Sequence[float], deviations: Sequence[float]) -> list[Column]:
    """The filled features, scaled as `StandardScalerModel` does; 0.0 where nothing varies.

    None is null, and `coalesce` says so: code without checks for nulls is a third as long.
    """
    return [
        (
            (F.coalesce(F.col(f"__f{i}{SUFFIX}"), F.lit(float(mean))) - F.lit(float(mean)))
            * F.lit(1 / float(deviation) if deviation else 0.0)
        ).alias(_scaled_name(i))
        for i, (mean, deviation) in enumerate(zip(means, deviations))
    ]
