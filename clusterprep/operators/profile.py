"""Column profile of a table and the column filters that use it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from clusterprep.functions.columns import column, numeric_columns, unpivoted

# Up to so many columns have one aggregate expression per statistic, which is the
# faster form while its compiled code is small; more columns are unpivoted.
_FLAT_COLUMNS = 16


def table_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column, in a single job over the table.

    Columns: column_name, total_rows, non_null, fill_ratio, stddev, min_value,
    max_value, varies. NaN counts as present; the statistics are on raw rows.
    A table without rows has no profile rows.

    Each task sends its partial statistics only: one row, or one per column.

    A column with NaN or an infinity has a NaN deviation and does not vary, nor
    does one with fewer than two values. Comparing the extremes, and not the
    deviation with 0, keeps rounding noise from making a constant vary.
    """
    names = numeric_columns(df) if columns is None else list(columns)
    if not names:
        raise ValueError("no numeric columns in the input")
    few = len(names) <= _FLAT_COLUMNS
    statistics = _flat_statistics(df, names) if few else _grouped_statistics(df, names)
    return statistics.select(
        F.element_at(F.lit(names), F.col("number") + 1).alias("column_name"),
        "total_rows",
        "non_null",
        (F.col("non_null") / F.col("total_rows")).alias("fill_ratio"),
        "stddev",
        "min_value",
        "max_value",
        F.coalesce(
            ~F.isnan("stddev") & F.col("stddev").isNotNull() & F.expr("min_value < max_value"),
            F.lit(False),
        ).alias("varies"),
    )


def _statistics(value: Column) -> dict[str, Column]:
    return {
        "non_null": F.count(value),
        "stddev": F.stddev_samp(value),
        "min_value": F.min(value),
        "max_value": F.max(value),
    }


# Both forms work on the doubles that features become, so equal doubles (longs
# beyond 2**53) count as equal here as well.


def _flat_statistics(df: DataFrame, names: list[str]) -> DataFrame:
    totals = [F.count(F.lit(1)).alias("total_rows")]
    lists = {}
    for i, name in enumerate(names):
        for label, statistic in _statistics(column(name).cast("double")).items():
            totals.append(statistic.alias(f"{label}{i}"))
            lists.setdefault(label, []).append(F.col(f"{label}{i}"))
    numbers = F.lit(list(range(len(names)))).alias("number")
    rows = F.arrays_zip(numbers, *[F.array(*v).alias(label) for label, v in lists.items()])
    return df.agg(*totals).where("total_rows > 0").select("total_rows", F.inline(rows))


def _grouped_statistics(df: DataFrame, names: list[str]) -> DataFrame:
    statistics = _statistics(F.col("value"))
    return (
        unpivoted(df, names)
        .groupBy("number")
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            *[statistic.alias(label) for label, statistic in statistics.items()],
        )
    )


def filled_enough(profile: DataFrame, min_non_null_ratio: float) -> DataFrame:
    """Profile rows of the columns whose share of non-null rows is enough (inclusive)."""
    return profile.where(F.col("fill_ratio") >= min_non_null_ratio)


def varying(profile: DataFrame) -> DataFrame:
    """Profile rows of the columns that vary."""
    return profile.where("varies")


def keep_filled_columns(
    df: DataFrame, min_non_null_ratio: float, columns: Sequence[str] | None = None
) -> list[str]:
    """Names of the numeric columns that are filled enough, in schema order."""
    profile = filled_enough(table_profile(df, columns), min_non_null_ratio)
    kept = {row.column_name for row in profile.collect()}
    return [name for name in df.columns if name in kept]


def drop_constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Names of the numeric columns that vary, in schema order."""
    kept = {row.column_name for row in varying(table_profile(df, columns)).collect()}
    return [name for name in df.columns if name in kept]


def choose_features(
    profile: Sequence[Row], columns: Sequence[str], min_non_null_ratio: float
) -> list[str]:
    """The usable ones of `columns`, given their collected profile rows (one per column)."""
    by_name = {row.column_name: row for row in profile}
    if not by_name:
        raise ValueError("the input table is empty")
    filled = [name for name in columns if by_name[name].fill_ratio >= min_non_null_ratio]
    if not filled:
        raise ValueError("no numeric column has enough non-null values")
    features = [name for name in filled if by_name[name].varies]
    if not features:
        raise ValueError("no numeric column varies")
    return features
