"""K-means over few columns of doubles, as passes of compiled expressions.

The steps, draws and results are those of `pyspark.ml`'s `KMeans` (k-means||,
then Lloyd), which keeps a vector object per row and passes over these; here a
pass reads columns, and only centres, sums and candidate rows are held.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterprep.functions.columns import column

NEAREST = "__nearest"
DISTANCE = "__distance"

# The defaults of `pyspark.ml`.
MAX_ITERATIONS = 20
TOLERANCE = 1e-4
INIT_STEPS = 2
_LOCAL_ITERATIONS = 30


def with_nearest(
    df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]]
) -> DataFrame:
    """Add the number of the nearest centre (the first of several) and the squared distance to it.

    The columns must have no missing values. Distances are columns of a select
    of their own, so that each is computed once.
    """
    parts = [f"__distance{j}" for j in range(len(centers))]
    distances = df.select("*", *[_squared(columns, c).alias(p) for c, p in zip(centers, parts)])
    least = F.least(*parts) if len(parts) > 1 else F.col(parts[0])
    nearest = F
    for j, part in enumerate(parts):
        nearest = nearest.when(F.col(part) == F.col(DISTANCE), F.lit(j))
    return distances.select("*", least.alias(DISTANCE)).select(
        *[column(name) for name in df.columns], nearest.alias(NEAREST), DISTANCE
    )


def _squared(columns: Sequence[str], center: Sequence[float]) -> Column:
    differences = [column(name) - F.lit(float(x)) for name, x in zip(columns, center)]
    return sum((d * d for d in differences[1:]), start=differences[0] * differences[0])


def k_means(
    rows: DataFrame, copy: DataFrame, columns: Sequence[str], k: int, seed: int
) -> list[tuple[float, ...]]:
    """At most k centres of the rows, fewer if there are fewer different rows.

    First centres are drawn from `rows`, whose partitions and order must be the
    same at each pass; passes for which these do not matter read the `copy`.
    """
    centers = first_centers(rows, copy, columns, k, seed)
    for _ in range(MAX_ITERATIONS):
        moved = dict(enumerate(centers))
        moved.update(cluster_means(copy, columns, centers))
        far = max(sum((x - y) ** 2 for x, y in zip(moved[j], c)) for j, c in enumerate(centers))
        centers = [moved[j] for j in range(len(centers))]
        if far <= TOLERANCE**2:
            break
    return centers


def cluster_means(
    rows: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]]
) -> dict[int, tuple[float, ...]]:
    """Mean of the rows nearest to each centre that has any."""
    means = (
        with_nearest(rows, columns, centers)
        .groupBy(NEAREST)
        .agg(*[F.avg(column(name)).alias(f"__mean{i}") for i, name in enumerate(columns)])
    )
    return {row[0]: tuple(row[1:]) for row in means.collect()}  # one row per centre


def first_centers(
    rows: DataFrame, copy: DataFrame, columns: Sequence[str], k: int, seed: int
) -> list[tuple[float, ...]]:
    """K-means||: a random row, two draws of about 2k rows by their cost, the k best of these."""
    spark = rows.sparkSession
    names = [column(name) for name in columns]
    seed = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    first, partitions = _any_row(rows, names, seed)
    candidates = [first]
    for step in range(INIT_STEPS):
        cost = with_nearest(copy, columns, candidates).agg(F.sum(DISTANCE)).first()[0]
        if cost == 0:
            break
        draw = _rand_by_partition(seed ^ (step << 16), partitions)
        chosen = drawn_rows(rows, columns, candidates, draw, 2.0 * k, cost)
        candidates += [tuple(row) for row in chosen.collect()]  # about 2k rows of any number
    candidates = list(dict.fromkeys(candidates))
    if len(candidates) <= k:
        return candidates
    counts = with_nearest(copy, columns, candidates).groupBy(NEAREST).count().collect()
    sizes = {row[0]: row[1] for row in counts}
    return _best(spark, candidates, [sizes.get(j, 0) for j in range(len(candidates))], k)


def drawn_rows(
    rows: DataFrame,
    columns: Sequence[str],
    candidates: Sequence[Sequence[float]],
    draw: Column,
    wanted: float,
    cost: float,
) -> DataFrame:
    """About so many of the rows as wanted, each by its share of the cost.

    The draw is a column, as Spark would push a filter of its own down to the scan
    with all distances in it, in a method too long for the JVM to compile.
    """
    names = [column(name) for name in columns]
    chance = F.col(DISTANCE) * F.lit(wanted) / F.lit(cost)
    near = with_nearest(rows, columns, candidates)
    return near.select(*names, (draw < chance).alias(NEAREST)).where(NEAREST).select(*names)


def _any_row(rows: DataFrame, names: list[Column], seed: int) -> tuple[tuple[float, ...], int]:
    """A row drawn as `takeSample` does, and the number of partitions.

    It draws from the rows' numbers, for which no column is read.
    """
    number = F.monotonically_increasing_id().alias(NEAREST)
    longs = rows.sparkSession._jvm.org.apache.spark.sql.Encoders.LONG()
    numbers = getattr(rows.select(number)._jdf, "as")(longs).toJavaRDD()
    drawn = numbers.takeSample(False, 1, seed)[0]
    (row,) = rows.select(*names, number).where(F.col(NEAREST) == drawn).collect()
    return tuple(row)[:-1], numbers.getNumPartitions()


def _rand_by_partition(start: int, partitions: int) -> Column:
    """Random numbers seeded with `start ^ partition`, where `rand` seeds with a sum.

    The sum is less by twice the bits that both have: one choice per bit of `start`.
    """

    def seeded(seed: int, bits: list[int]) -> Column:
        if not bits:
            return F.rand(seed)
        has = F.spark_partition_id().bitwiseAND(F.lit(bits[0])) != 0
        return F.when(has, seeded(seed - 2 * bits[0], bits[1:])).otherwise(seeded(seed, bits[1:]))

    every = [1 << i for i in range((partitions - 1).bit_length())]
    return seeded(start, [bit for bit in every if start & bit])


def _best(
    spark: SparkSession, candidates: list[tuple[float, ...]], sizes: list[int], k: int
) -> list[tuple[float, ...]]:
    """K-means++ and Lloyd over a few weighted points, on the driver."""
    clustering = spark._jvm.org.apache.spark.mllib.clustering
    gateway = spark.sparkContext._gateway
    points = gateway.new_array(clustering.VectorWithNorm, len(candidates))
    weights = gateway.new_array(gateway.jvm.double, len(candidates))
    for i, (candidate, size) in enumerate(zip(candidates, sizes)):
        points[i] = clustering.VectorWithNorm(_py2java(spark.sparkContext, Vectors.dense(candidate)))
        weights[i] = float(size)
    found = clustering.LocalKMeans.kMeansPlusPlus(0, points, weights, k, _LOCAL_ITERATIONS)
    return [tuple(center.vector().toArray()) for center in found]
