"""Command line, for `spark-submit` or `python -m clusterprep`."""

from __future__ import annotations

import argparse
import json
from dataclasses import fields
from pathlib import Path

from pyspark.sql import SparkSession

from clusterprep.operators.word_count import word_count
from clusterprep.plans.cluster_job import ClusterParams, run
from clusterprep.plans.sample_file import SAMPLE_ROWS, write_sample
from clusterprep.session import scratch
from clusterprep.sinks.files import write_parquet
from clusterprep.sinks.tables import CatalogTarget, JdbcTarget, ParquetTarget, Target
from clusterprep.sources.files import read_lines


def parser() -> argparse.ArgumentParser:
    usual = ClusterParams()
    top = argparse.ArgumentParser(prog="clusterprep")
    commands = top.add_subparsers(dest="command", required=True)

    cluster = commands.add_parser("cluster", help="prepare, cluster, score and save a table")
    cluster.add_argument("input", help="Parquet table")
    cluster.add_argument("output", help="folder, catalog database or JDBC address")
    cluster.add_argument("--catalog", action="store_true", help="output is a catalog database")
    cluster.add_argument("--jdbc", action="store_true", help="output is a JDBC address")
    cluster.add_argument(
        "--jdbc-properties",
        help="JSON file with the connection's properties (driver, user, password)",
    )
    cluster.add_argument("--config", help="JSON file with parameters; options override it")
    cluster.add_argument("--text", action="store_true", help="store every column as text")
    cluster.add_argument("--k", type=int, default=usual.k)
    cluster.add_argument("--seed", type=int, default=usual.seed)
    cluster.add_argument("--min-non-null-ratio", type=float, default=usual.min_non_null_ratio)
    cluster.add_argument(
        "--target-rows", type=int, default=usual.target_rows, help="sample so many distinct rows"
    )
    cluster.add_argument("--sampling", choices=["exact", "bernoulli"], default=usual.sampling)
    cluster.add_argument("--exclude", nargs="*", default=[], help="columns that are no features")
    cluster.add_argument(
        "--imputer-strategy", choices=["mean", "median", "mode"], default=usual.imputer_strategy
    )
    cluster.add_argument("--relative-error", type=float, default=usual.relative_error)
    cluster.add_argument(
        "--distance-measure",
        choices=["squaredEuclidean", "cosine"],
        default=usual.distance_measure,
    )

    sample = commands.add_parser("sample", help="write a small copy of a table")
    sample.add_argument("source")
    sample.add_argument("destination")
    sample.add_argument("rows", type=int, nargs="?", default=SAMPLE_ROWS)

    count = commands.add_parser("words", help="count the words of text files")
    count.add_argument("input")
    count.add_argument("output", help="Parquet folder")
    return top


def parsed(arguments: list[str] | None = None) -> argparse.Namespace:
    """The options; those not given take their value from the file of --config, if any."""
    top = parser()
    args = top.parse_args(arguments)
    if getattr(args, "config", None):
        values = json.loads(Path(args.config).read_text())
        unknown = set(values) - {field.name for field in fields(ClusterParams)}
        if unknown:
            top.error(f"unknown parameters in {args.config}: {', '.join(sorted(unknown))}")
        commands = next(a for a in top._actions if isinstance(a, argparse._SubParsersAction))
        commands.choices["cluster"].set_defaults(**values)
        args = top.parse_args(arguments)
    return args


def _target(args: argparse.Namespace) -> Target:
    if args.jdbc:
        properties = json.loads(Path(args.jdbc_properties).read_text()) if args.jdbc_properties else {}
        return JdbcTarget(args.output, properties)
    return CatalogTarget(args.output) if args.catalog else ParquetTarget(args.output)


def main(arguments: list[str] | None = None) -> None:
    args = parsed(arguments)
    spark = SparkSession.builder.appName(f"clusterprep-{args.command}").getOrCreate()
    if args.command == "sample":
        write_sample(spark, args.source, args.destination, args.rows)
    elif args.command == "words":
        write_parquet(word_count(read_lines(spark, args.input)), args.output)
    else:
        params = ClusterParams(
            min_non_null_ratio=args.min_non_null_ratio,
            target_rows=args.target_rows,
            seed=args.seed,
            sampling=args.sampling,
            exclude=tuple(args.exclude),
            imputer_strategy=args.imputer_strategy,
            relative_error=args.relative_error,
            k=args.k,
            distance_measure=args.distance_measure,
        )
        with scratch(spark):
            result = run(spark, args.input, _target(args), params, args.text)
            prepared = result.prepared
            print(f"rows: {prepared.working_rows} of {prepared.total_rows}")
            print(f"features: {', '.join(prepared.feature_cols)}")
            print(f"{params.metric_name}: {result.score:.4f}")


if __name__ == "__main__":
    main()
