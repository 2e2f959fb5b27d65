"""

Every query reads whole tables. The test tables hold no nulls and no constant
columns, so some queries first derive holes and a constant by expression; both
sides use the same expressions.
"""

from __future__ import annotations

import importlib
import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clusterprep.functions.columns import md5_rank, numeric_columns, row_rank  # noqa: E402
from clusterprep.operators.cluster import assign_nearest, centroid_update  # noqa: E402
from clusterprep.operators.evaluate import (  # noqa: E402
    COSINE,
    SQUARED_EUCLIDEAN,
    metrics_table,
    silhouette,
)
from clusterprep.operators.features import (  # noqa: E402
    assemble,
    cast_features,
    distinct_rows,
    standard_scale,
)
from clusterprep.operators.impute import impute  # noqa: E402
from clusterprep.operators.profile import filled_enough, table_profile, varying  # noqa: E402
from clusterprep.operators.sampling import (  # noqa: E402
    sample_bernoulli,
    sample_fraction,
    sample_lowest,
)
from clusterprep.operators.word_count import word_count  # noqa: E402
from clusterprep.plans.cluster_job import (  # noqa: E402
    ClusterParams,
    ClusterResult,
    cluster_table,
)
from clusterprep.plans.prepare import prepare_training_data  # noqa: E402
from clusterprep.plans.sample_file import SAMPLE_ROWS, write_sample  # noqa: E402
from clusterprep.session import cut_lineage, fresh_path  # noqa: E402
from clusterprep.sinks.files import rows_to_json, write_jsonl  # noqa: E402
from clusterprep.sinks.tables import (  # noqa: E402
    INPUT_TABLE,
    METRICS_TABLE,
    PREDICTIONS_TABLE,
    CatalogTarget,
    ParquetTarget,
    replace_table,
    results_summary,
    save_input,
    save_results,
)
from clusterprep.sources.files import read_jsonl, read_lines, read_parquet  # noqa: E402

# Three well separated groups; some y are missing.
BLOBS = ClusterParams(k=3, relative_error=0.0)
CENTERS = [[10.0, 20000.0], [40.0, 80000.0]]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def _holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_extendedprice END AS price",
        "CASE WHEN l_linenumber = 1 THEN l_quantity END AS sparse",
        "CAST(3.7 AS DOUBLE) AS const",
        "l_discount",
    )


def _holes_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_quantity END AS qty",
        "CASE WHEN l_linenumber = 1 THEN l_quantity END AS sparse",
        "CAST(3.7 AS DOUBLE) AS const",
        "l_discount",
        "l_linenumber",
        "l_returnflag",
    )


def _blobs(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        *keys,
        "o_totalprice + (o_orderkey % 3) * 5e6D AS x",
        "CASE WHEN o_orderkey % 3 = 1 AND o_orderkey % 20 = 1 THEN NULL "
        "ELSE CAST(o_custkey % 50 + (o_orderkey % 3) * 1000 AS DOUBLE) END AS y",
    )


def _clustered_blobs(spark: SparkSession, sf_dir: str) -> ClusterResult:
    return cluster_table(_blobs(spark, sf_dir), BLOBS)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem rows as vectors, with the line number as their cluster."""
    rows = _table(spark, sf_dir, "lineitem")
    vectors = assemble(rows, ["l_quantity", "l_tax", "l_discount"], "features")
    return vectors.select("features", F.col("l_linenumber").alias("prediction"))


def entry(spark: SparkSession) -> DataFrame:
    """Prepare, cluster and score; the feature rows with their cluster."""
    return _clustered_blobs(spark, "/root/testdata/sf0.001").predictions


# --- sources and sinks -------------------------------------------------------


def scan_parquet(spark, sf_dir):
    return _table(spark, sf_dir, "orders")


def jsonl_roundtrip(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").drop("o_orderdate")
    path = fresh_path(spark, "jsonl")
    write_jsonl(rows, path)
    return read_jsonl(spark, path, rows.schema)


def text_scan_lines(spark, sf_dir):
    path = fresh_path(spark, "lines")
    _table(spark, sf_dir, "documents").select("text").write.text(path)
    return read_lines(spark, path)


def rows_to_json_lines(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END AS o_custkey"
    )
    return rows_to_json(rows)


def sample_to_parquet(spark, sf_dir):
    source = f"{sf_dir}/lineitem.parquet"
    path = fresh_path(spark, "copy")
    write_sample(spark, source, path)
    copy = read_parquet(spark, path)
    known = copy.join(read_parquet(spark, source).distinct(), copy.columns, "left_semi")
    return copy.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(known.count()).cast("long").alias("n_from_source"),
        F.lit(len(copy.inputFiles())).cast("long").alias("n_files"),
    )


def source_rows_readback(spark, sf_dir):
    rows = cast_features(
        _table(spark, sf_dir, "customer"), ["c_custkey", "c_nationkey", "c_acctbal"]
    )
    return save_input(rows, ParquetTarget(fresh_path(spark, "input")))


def catalog_tables(spark, sf_dir):
    """The input as a table of a new catalog database, read back with the database's table list."""
    path = fresh_path(spark, "catalog")
    target = CatalogTarget(os.path.basename(path).replace("-", "_"), path)
    rows = _table(spark, sf_dir, "customer")
    save_input(rows, target)
    replace_table(metrics_table(spark, {"rows": float(rows.count())}), target, METRICS_TABLE)
    stored = target.read(spark, INPUT_TABLE).withColumn("tables", F.lit(",".join(target.tables(spark))))
    stored = cut_lineage(stored, "stored")
    target.drop(spark)
    return stored


def predictions_text_sink(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_extendedprice END AS price",
        "l_quantity",
        "l_extendedprice",
        "l_extendedprice * 1024 AS large",
        "l_tax / 64 AS small",
        "l_returnflag = 'R' AS returned",
        "l_returnflag",
        "array(l_linenumber, l_suppkey) AS codes",
    )
    labelled = assign_nearest(rows, ["l_quantity", "l_extendedprice"], CENTERS)
    target = ParquetTarget(fresh_path(spark, "text"))
    replace_table(labelled, target, PREDICTIONS_TABLE, as_strings=True)
    return target.read(spark, PREDICTIONS_TABLE)


def save_results_roundtrip(spark, sf_dir):
    result = _clustered_blobs(spark, sf_dir)
    target = ParquetTarget(fresh_path(spark, "results"))
    save_results(result.predictions, result.metrics, target)
    return target.read(spark, PREDICTIONS_TABLE)


def results_row_count(spark, sf_dir):
    result = _clustered_blobs(spark, sf_dir)
    target = ParquetTarget(fresh_path(spark, "results"))
    save_results(result.predictions, result.metrics, target)
    return results_summary(spark, target).withColumn("value", F.round("value", 6))


# --- profile and preparation -------------------------------------------------


def numeric_column_names(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem")
    return table_profile(rows, numeric_columns(rows)).select("column_name", "non_null")


def table_profile_holes(spark, sf_dir):
    return table_profile(_holes(spark, sf_dir)).select(
        "column_name",
        "total_rows",
        "non_null",
        F.round("fill_ratio", 6).alias("fill_ratio"),
        F.round("stddev", 4).alias("stddev"),
        "min_value",
        "max_value",
        "varies",
    )


def column_fill_ratio(spark, sf_dir):
    return table_profile(_holes(spark, sf_dir)).select(
        "column_name", F.round("fill_ratio", 6).alias("fill_ratio")
    )


def keep_filled(spark, sf_dir):
    return filled_enough(table_profile(_holes(spark, sf_dir)), 0.9).select("column_name")


def drop_constant(spark, sf_dir):
    return varying(table_profile(_holes(spark, sf_dir))).select("column_name")


def cast_feature_columns(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders")
    return cast_features(rows, numeric_columns(rows))


def distinct_feature_rows(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem")
    return distinct_rows(cast_features(rows, ["l_quantity", "l_discount", "l_tax"]))


def prepare_all(spark, sf_dir):
    return prepare_training_data(_holes_wide(spark, sf_dir)).df


def prepare_sampled(spark, sf_dir):
    return prepare_training_data(
        _holes_wide(spark, sf_dir), target_rows=1000, rank=lambda names: md5_rank(names, 42)
    ).df


def sample_hash_cap(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sample_lowest(rows, 1000, md5_rank(["o_orderkey"], 42))


def sample_hash_fraction(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sample_fraction(rows, 0.1, md5_rank(["o_orderkey"], 42))


def sample_bernoulli_cap(spark, sf_dir):
    """The whole of a small table, and sizes and origin of a draw from a larger one."""
    target = 1000
    rows = distinct_feature_rows(spark, sf_dir)
    sample = sample_bernoulli(rows, target, 42)
    known = sample.join(rows, rows.columns, "left_semi").count()
    drawn = sample.count()
    every = sample_bernoulli(rows, rows.count(), 42)
    return every.agg(
        F.count(F.lit(1)).alias("n_all"),
        F.round(F.sum("l_tax"), 4).alias("tax_all"),
        F.lit(0.8 * target <= drawn <= target).alias("near_target"),
        F.lit(drawn == known).alias("all_from_source"),
    )


# --- imputation, vectors, clustering -----------------------------------------


def _imputed(spark, sf_dir, column, strategy):
    rows = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        f"CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE {column} END AS v",
    )
    filled = impute(rows, ["v"], strategy, relative_error=0.0)
    return filled.withColumn("v_imp", F.round("v_imp", 6))


def impute_median(spark, sf_dir):
    return _imputed(spark, sf_dir, "l_extendedprice", "median")


def impute_mean(spark, sf_dir):
    return _imputed(spark, sf_dir, "l_extendedprice", "mean")


def impute_mode(spark, sf_dir):
    return _imputed(spark, sf_dir, "l_quantity", "mode")


FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]


def _vector_columns(df, vector, digits):
    values = vector_to_array(vector)
    return df.select(
        "l_orderkey",
        "l_linenumber",
        *[F.round(values[i], digits).alias(f"v{i}") for i in range(len(FEATURES))],
    )


def assemble_vector(spark, sf_dir):
    rows = assemble(_table(spark, sf_dir, "lineitem"), FEATURES)
    return _vector_columns(rows, "features_raw", 6)


def standard_scale_rows(spark, sf_dir):
    rows = standard_scale(assemble(_table(spark, sf_dir, "lineitem"), FEATURES))
    return _vector_columns(rows, "features", 6)


def assign_nearest_rows(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    return assign_nearest(rows, ["l_quantity", "l_extendedprice"], CENTERS)


def centroid_update_rows(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem")
    step = centroid_update(rows, ["l_quantity", "l_extendedprice"], CENTERS)
    return step.select(
        "prediction",
        "size",
        F.round("l_quantity", 4).alias("l_quantity"),
        F.round("l_extendedprice", 4).alias("l_extendedprice"),
    )


def kmeans_blobs(spark, sf_dir):
    model = _clustered_blobs(spark, sf_dir).model
    return model.predict(_blobs(spark, sf_dir, "o_orderkey")).select("o_orderkey", "prediction")


def kmeans_cluster_sizes(spark, sf_dir):
    predictions = _clustered_blobs(spark, sf_dir).predictions
    return predictions.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("size"),
        F.round(F.avg("x"), 2).alias("x"),
        F.round(F.avg("y"), 4).alias("y"),
    )


def cluster_all_rows(spark, sf_dir):
    """By default every distinct row is clustered; the table has more than 100,000 of them."""
    rows = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_quantity", "l_extendedprice", "l_discount", "explode(sequence(0, 2)) AS n"
    )
    rows = rows.selectExpr("l_quantity", "l_extendedprice + n / 1000D AS price", "l_discount")
    predictions = cluster_table(rows).predictions
    return predictions.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("prediction").alias("n_predicted")
    )


def _share_elsewhere(predictions, names):
    """Share of rows nearer to the mean of another cluster, measured without the library."""
    scale = predictions.agg(
        *[F.avg(n).alias(f"m_{n}") for n in names], *[F.stddev(n).alias(f"s_{n}") for n in names]
    ).first()
    rows = predictions.select(
        "prediction", *[((F.col(n) - scale[f"m_{n}"]) / scale[f"s_{n}"]).alias(n) for n in names]
    )
    means = rows.groupBy("prediction").agg(*[F.avg(n).alias(n) for n in names]).collect()

    def distance(mean):
        return sum((F.col(n) - mean[n]) * (F.col(n) - mean[n]) for n in names)

    nearest = F.array_min(
        F.array(*[F.struct(distance(m).alias("d"), F.lit(m["prediction"]).alias("c")) for m in means])
    )["c"]
    return rows.agg(F.avg((nearest != F.col("prediction")).cast("double"))).first()[0]


def cluster_default_fixed_point(spark, sf_dir):
    """A job with default parameters on overlapping data ends where k-means stops."""
    rows = _table(spark, sf_dir, "lineitem").select(FEATURES)
    result = cluster_table(rows)
    target = ParquetTarget(fresh_path(spark, "ordinary"))
    save_results(result.predictions, result.metrics, target)
    stored = target.read(spark, PREDICTIONS_TABLE)
    share = _share_elsewhere(stored, FEATURES)
    return stored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("prediction").alias("n_clusters"),
        F.lit(share < 0.002).alias("settled"),
    )


def cluster_sampled(spark, sf_dir):
    """A job on a sample of 1000 distinct rows: those of lowest rank, and settled as well."""
    rows = _table(spark, sf_dir, "lineitem").select(FEATURES)
    sample = cluster_table(rows, ClusterParams(k=3, target_rows=1000)).predictions
    rank = row_rank(FEATURES, ClusterParams().seed)
    every = rows.distinct().select(*FEATURES, rank.alias("rank"))
    highest = sample.select(F.max(rank)).first()[0]
    share = _share_elsewhere(sample, FEATURES)
    return every.agg(
        F.count_if(F.col("rank") <= highest).alias("n_lowest"),
        F.lit(sample.join(every, FEATURES, "left_semi").count()).cast("long").alias("n_from_source"),
        F.lit(share < 0.01).alias("settled"),
    )


def predictions_projection(spark, sf_dir):
    return _clustered_blobs(spark, sf_dir).predictions


def silhouette_blobs(spark, sf_dir):
    return _clustered_blobs(spark, sf_dir).metrics.withColumn("value", F.round("value", 6))


def silhouette_embeddings(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.col("label").alias("prediction"),
    )
    score = silhouette(rows)
    return metrics_table(spark, {"silhouette": round(score, 6)})


def silhouette_cosine(spark, sf_dir):
    score = silhouette(_labelled(spark, sf_dir), distance_measure=COSINE)
    return metrics_table(spark, {"silhouette": round(score, 6)})


def metrics_rows(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    scores = {name: silhouette(rows, distance_measure=name) for name in (SQUARED_EUCLIDEAN, COSINE)}
    return metrics_table(spark, {name: round(score, 6) for name, score in scores.items()})


# --- text --------------------------------------------------------------------


def word_count_documents(spark, sf_dir):
    return word_count(_table(spark, sf_dir, "documents"), "text")


def word_count_conversations(spark, sf_dir):
    return word_count(_table(spark, sf_dir, "conversations"), "text")


def word_count_lines(spark, sf_dir):
    return word_count(text_scan_lines(spark, sf_dir))


def _training_data():
    """Queries of the training-data operators, where that subpackage is present."""
    try:
        found = importlib.util.find_spec("clusterprep.llm.queries")
    except ModuleNotFoundError:
        found = None
    return importlib.import_module("clusterprep.llm.queries") if found else None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = _training_data()
    return table_queries() | (more.queries() if more else {})


def table_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_parquet": scan_parquet,
        "jsonl_roundtrip": jsonl_roundtrip,
        "text_scan_lines": text_scan_lines,
        "rows_to_json": rows_to_json_lines,
        "sample_to_parquet": sample_to_parquet,
        "source_rows_readback": source_rows_readback,
        "catalog_tables": catalog_tables,
        "predictions_text_sink": predictions_text_sink,
        "save_results_roundtrip": save_results_roundtrip,
        "results_row_count": results_row_count,
        "numeric_columns": numeric_column_names,
        "table_profile": table_profile_holes,
        "column_fill_ratio": column_fill_ratio,
        "keep_filled_columns": keep_filled,
        "drop_constant_columns": drop_constant,
        "cast_features": cast_feature_columns,
        "distinct_feature_rows": distinct_feature_rows,
        "prepare_training_data": prepare_all,
        "prepare_training_data_sampled": prepare_sampled,
        "sample_hash_cap": sample_hash_cap,
        "sample_hash_fraction": sample_hash_fraction,
        "sample_bernoulli_cap": sample_bernoulli_cap,
        "impute_median": impute_median,
        "impute_mean": impute_mean,
        "impute_mode": impute_mode,
        "assemble_vector": assemble_vector,
        "standard_scale": standard_scale_rows,
        "assign_nearest": assign_nearest_rows,
        "centroid_update": centroid_update_rows,
        "kmeans_blobs": kmeans_blobs,
        "kmeans_cluster_sizes": kmeans_cluster_sizes,
        "cluster_all_rows": cluster_all_rows,
        "cluster_default_fixed_point": cluster_default_fixed_point,
        "cluster_sampled": cluster_sampled,
        "predictions_projection": predictions_projection,
        "silhouette_blobs": silhouette_blobs,
        "silhouette_embeddings": silhouette_embeddings,
        "silhouette_cosine": silhouette_cosine,
        "metrics_table": metrics_rows,
        "word_count": word_count_documents,
        "word_count_conversations": word_count_conversations,
        "word_count_lines": word_count_lines,
    }


# --- DuckDB equivalents ------------------------------------------------------

_HOLES = """
    SELECT CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_extendedprice END AS price,
           CASE WHEN l_linenumber = 1 THEN l_quantity END AS sparse,
           CAST(3.7 AS DOUBLE) AS const,
           l_discount
    FROM lineitem"""

_HOLES_PROFILE = f"""
    WITH h AS ({_HOLES}),
    long AS (
      SELECT 'price' AS column_name, price AS v FROM h UNION ALL
      SELECT 'sparse', sparse FROM h UNION ALL
      SELECT 'const', const FROM h UNION ALL
      SELECT 'l_discount', l_discount FROM h),
    p AS (
      SELECT column_name, count(*) AS total_rows, count(v) AS non_null,
             count(v) / count(*) AS fill_ratio, stddev_samp(v) AS stddev,
             min(v) AS min_value, max(v) AS max_value, min(v) < max(v) AS varies
      FROM long GROUP BY column_name)"""

_PREPARED = """
    SELECT DISTINCT CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_quantity END AS qty,
           l_discount, CAST(l_linenumber AS DOUBLE) AS l_linenumber
    FROM lineitem"""

_BLOB_ROWS = """
    SELECT o_orderkey, o_totalprice + (o_orderkey % 3) * 5e6 AS x,
           CASE WHEN o_orderkey % 3 = 1 AND o_orderkey % 20 = 1 THEN NULL
                ELSE CAST(o_custkey % 50 + (o_orderkey % 3) * 1000 AS DOUBLE) END AS y,
           CAST(o_orderkey % 3 AS INTEGER) AS prediction
    FROM orders"""

_BLOB_PREDICTIONS = f"SELECT DISTINCT x, y, prediction FROM ({_BLOB_ROWS})"

_BLOB_POINTS = f"""
    SELECT prediction AS c,
           [(x - avg(x) OVER ()) / stddev_samp(x) OVER (),
            (yi - avg(yi) OVER ()) / stddev_samp(yi) OVER ()] AS v
    FROM (SELECT x, prediction,
                 coalesce(y, (SELECT quantile_disc(y, 0.5) FROM ({_BLOB_PREDICTIONS}))) AS yi
          FROM ({_BLOB_PREDICTIONS}))"""

_LABELLED_POINTS = "SELECT l_linenumber AS c, [l_quantity, l_tax, l_discount] AS v FROM lineitem"


def _silhouette_sql(points: str, cosine: bool = False) -> str:
    """Scalar query for the silhouette of points (c, v)."""
    unit = "list_transform(v, lambda x: x / sqrt(list_dot_product(v, v)))" if cosine else "v"
    distance = (
        "1 - list_dot_product(p.v, k.total) / k.n"
        if cosine
        else "list_dot_product(p.v, p.v) + k.psi / k.n - 2 * list_dot_product(p.v, k.total) / k.n"
    )
    return f"""(
    WITH raw AS ({points}),
    p AS (SELECT row_number() OVER () AS id, c, {unit} AS v FROM raw),
    coordinates AS (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM p),
    totals AS (
      SELECT c, list(s ORDER BY j) AS total
      FROM (SELECT c, j, sum(x) AS s FROM coordinates GROUP BY c, j) GROUP BY c),
    sizes AS (SELECT c, count(*) AS n, sum(list_dot_product(v, v)) AS psi FROM p GROUP BY c),
    k AS (SELECT c, n, psi, total FROM sizes JOIN totals USING (c)),
    d AS (SELECT p.id, p.c = k.c AS own, k.n, {distance} AS distance FROM p CROSS JOIN k),
    ab AS (
      SELECT id, max(CASE WHEN own THEN n END) AS n,
             max(CASE WHEN own AND n > 1 THEN distance * n / (n - 1) END) AS a,
             min(CASE WHEN NOT own THEN distance END) AS b
      FROM d GROUP BY id)
    SELECT avg(CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b
                    WHEN a > b THEN b / a - 1 ELSE 0 END) FROM ab)"""


def _imputed_sql(column: str, value: str) -> str:
    return f"""
    WITH r AS (
      SELECT l_orderkey, l_linenumber,
             CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE {column} END AS v FROM lineitem),
    f AS ({value})
    SELECT l_orderkey, l_linenumber, v, round(coalesce(v, f.filler), 6) AS v_imp
    FROM r CROSS JOIN f"""


_DISTANCES = """
    SELECT *, (l_quantity - 10) * (l_quantity - 10)
              + (l_extendedprice - 20000) * (l_extendedprice - 20000) AS d0,
              (l_quantity - 40) * (l_quantity - 40)
              + (l_extendedprice - 80000) * (l_extendedprice - 80000) AS d1
    FROM lineitem"""

_RANK_42 = "CAST('0x' || substr(md5('42|' || {key}), 1, 13) AS BIGINT) / 4503599627370496.0"


def _word_count_sql(table: str) -> str:
    return f"""
    SELECT word, count(*) AS count
    FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS word FROM {table})
    WHERE word <> '' GROUP BY word"""


def oracle_sql() -> dict[str, str]:
    more = _training_data()
    return table_oracle_sql() | (more.oracle_sql() if more else {})


def table_oracle_sql() -> dict[str, str]:
    blob_score = f"round({_silhouette_sql(_BLOB_POINTS)}, 6)"
    return {
        "scan_parquet": "SELECT * FROM orders",
        "jsonl_roundtrip": """
            SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
            FROM orders""",
        "text_scan_lines": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
        "rows_to_json": """
            SELECT '{"o_orderkey":' || o_orderkey
                   || CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE ',"o_custkey":' || o_custkey END
                   || '}' AS json
            FROM orders""",
        "sample_to_parquet": f"""
            SELECT least(count(*), {SAMPLE_ROWS}) AS n_rows,
                   least(count(*), {SAMPLE_ROWS}) AS n_from_source,
                   CAST(1 AS BIGINT) AS n_files
            FROM lineitem""",
        "source_rows_readback": """
            SELECT CAST(c_custkey AS DOUBLE) AS c_custkey,
                   CAST(c_nationkey AS DOUBLE) AS c_nationkey, c_acctbal
            FROM customer""",
        "catalog_tables": f"SELECT *, '{INPUT_TABLE},{METRICS_TABLE}' AS tables FROM customer",
        "predictions_text_sink": f"""
            SELECT CASE WHEN l_orderkey % 13 = 0 THEN ''
                        ELSE CAST(l_extendedprice AS VARCHAR) END AS price,
                   CAST(l_quantity AS VARCHAR) AS l_quantity,
                   CAST(l_extendedprice AS VARCHAR) AS l_extendedprice,
                   CAST(l_extendedprice * 1024 AS VARCHAR) AS large,
                   CAST(l_tax / 64 AS VARCHAR) AS small,
                   CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END AS returned,
                   l_returnflag,
                   '[' || l_linenumber || ',' || l_suppkey || ']' AS codes,
                   CASE WHEN d0 <= d1 THEN '0' ELSE '1' END AS prediction
            FROM ({_DISTANCES})""",
        "save_results_roundtrip": _BLOB_PREDICTIONS,
        "results_row_count": f"""
            SELECT 'silhouette' AS metric, {blob_score} AS value,
                   (SELECT count(*) FROM ({_BLOB_PREDICTIONS})) AS predictions""",
        "numeric_columns": """
            SELECT column_name, (SELECT count(*) FROM lineitem) AS non_null
            FROM (DESCRIBE lineitem)
            WHERE column_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'FLOAT', 'DOUBLE')
               OR column_type LIKE 'DECIMAL%'""",
        "table_profile": f"""{_HOLES_PROFILE}
            SELECT column_name, total_rows, non_null, round(fill_ratio, 6) AS fill_ratio,
                   round(stddev, 4) AS stddev, min_value, max_value, varies
            FROM p""",
        "column_fill_ratio": f"""{_HOLES_PROFILE}
            SELECT column_name, round(fill_ratio, 6) AS fill_ratio FROM p""",
        "keep_filled_columns": f"{_HOLES_PROFILE} SELECT column_name FROM p WHERE fill_ratio >= 0.9",
        "drop_constant_columns": f"{_HOLES_PROFILE} SELECT column_name FROM p WHERE varies",
        "cast_features": """
            SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey,
                   CAST(o_custkey AS DOUBLE) AS o_custkey, o_totalprice
            FROM orders""",
        "distinct_feature_rows": "SELECT DISTINCT l_quantity, l_discount, l_tax FROM lineitem",
        "prepare_training_data": _PREPARED,
        "prepare_training_data_sampled": f"""
            SELECT qty, l_discount, l_linenumber FROM ({_PREPARED})
            ORDER BY substr(md5('42|' || coalesce(CAST(qty AS VARCHAR), '~') || '|' || l_discount
                                || '|' || l_linenumber), 1, 13), qty, l_discount, l_linenumber
            LIMIT 1000""",
        "sample_hash_cap": f"""
            SELECT o_orderkey, o_totalprice FROM orders
            ORDER BY {_RANK_42.format(key="o_orderkey")}, o_orderkey LIMIT 1000""",
        "sample_hash_fraction": f"""
            SELECT o_orderkey, o_totalprice FROM orders
            WHERE {_RANK_42.format(key="o_orderkey")} < 0.1""",
        "sample_bernoulli_cap": """
            SELECT count(*) AS n_all, round(sum(l_tax), 4) AS tax_all, true AS near_target,
                   true AS all_from_source
            FROM (SELECT DISTINCT l_quantity, l_discount, l_tax FROM lineitem)""",
        "impute_median": _imputed_sql(
            "l_extendedprice", "SELECT quantile_disc(v, 0.5) AS filler FROM r"
        ),
        "impute_mean": _imputed_sql("l_extendedprice", "SELECT avg(v) AS filler FROM r"),
        "impute_mode": _imputed_sql(
            "l_quantity",
            """SELECT v AS filler FROM r WHERE v IS NOT NULL
               GROUP BY v ORDER BY count(*) DESC, v LIMIT 1""",
        ),
        "assemble_vector": """
            SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS v0,
                   round(l_extendedprice, 6) AS v1, round(l_discount, 6) AS v2
            FROM lineitem""",
        "standard_scale": "SELECT l_orderkey, l_linenumber, "
        + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS v{i}"
            for i, c in enumerate(FEATURES)
        )
        + " FROM lineitem",
        "assign_nearest": f"""
            SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
                   CAST(CASE WHEN d0 <= d1 THEN 0 ELSE 1 END AS INTEGER) AS prediction
            FROM ({_DISTANCES})""",
        "centroid_update": f"""
            SELECT CAST(CASE WHEN d0 <= d1 THEN 0 ELSE 1 END AS INTEGER) AS prediction,
                   count(*) AS size, round(avg(l_quantity), 4) AS l_quantity,
                   round(avg(l_extendedprice), 4) AS l_extendedprice
            FROM ({_DISTANCES}) GROUP BY 1""",
        "kmeans_blobs": f"SELECT o_orderkey, prediction FROM ({_BLOB_ROWS})",
        "kmeans_cluster_sizes": f"""
            SELECT prediction, count(*) AS size, round(avg(x), 2) AS x, round(avg(y), 4) AS y
            FROM ({_BLOB_PREDICTIONS}) GROUP BY prediction""",
        "cluster_all_rows": """
            SELECT count(*) AS n_rows, count(*) AS n_predicted
            FROM (SELECT DISTINCT l_quantity, l_extendedprice + n / 1000.0::DOUBLE AS price, l_discount
                  FROM lineitem, range(0, 3) t(n))""",
        "cluster_default_fixed_point": f"""
            SELECT count(*) AS n_rows, CAST(2 AS BIGINT) AS n_clusters, true AS settled
            FROM (SELECT DISTINCT {", ".join(FEATURES)} FROM lineitem)""",
        "cluster_sampled": f"""
            SELECT least(count(*), 1000) AS n_lowest, least(count(*), 1000) AS n_from_source,
                   true AS settled
            FROM (SELECT DISTINCT {", ".join(FEATURES)} FROM lineitem)""",
        "predictions_projection": _BLOB_PREDICTIONS,
        "silhouette_blobs": f"SELECT 'silhouette' AS metric, {blob_score} AS value",
        "silhouette_embeddings": f"""
            SELECT 'silhouette' AS metric, round({_silhouette_sql(
                "SELECT label AS c, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"
            )}, 6) AS value""",
        "silhouette_cosine": f"""
            SELECT 'silhouette' AS metric,
                   round({_silhouette_sql(_LABELLED_POINTS, cosine=True)}, 6) AS value""",
        "metrics_table": f"""
            SELECT 'squaredEuclidean' AS metric,
                   round({_silhouette_sql(_LABELLED_POINTS)}, 6) AS value
            UNION ALL
            SELECT 'cosine', round({_silhouette_sql(_LABELLED_POINTS, cosine=True)}, 6)""",
        "word_count": _word_count_sql("documents"),
        "word_count_conversations": _word_count_sql("conversations"),
        "word_count_lines": _word_count_sql("documents"),
    }
