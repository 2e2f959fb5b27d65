"""Fill missing values (null or NaN) with the median, mean or mode of a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Imputer, SQLTransformer
from pyspark.sql import DataFrame

from clusterprep.functions.columns import column, quoted
from clusterprep.operators.order_statistics import count_values, kth_smallest

# Fixed value: suffix of the filled columns.
SUFFIX = "_imp"

# Strategies and the usual rank error of the median.
STRATEGIES = ("mean", "median", "mode")
RELATIVE_ERROR = 0.001


def imputer_stage(
    df: DataFrame,
    sizes: dict[str, int],
    strategy: str = "median",
    relative_error: float = RELATIVE_ERROR,
):
    """Pipeline stage that adds `<column>_imp` for each of some double columns.

    `sizes` gives the value count of each column (`count_values`).

    Medians are approximate within `relative_error` ranks and then depend a
    little on the data layout. A `relative_error` of 0 asks for the exact lower
    median, found here by narrowing; the plain `Imputer` would merge a summary
    of the whole column in one place for it.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown imputation strategy {strategy!r}; use one of {STRATEGIES}")
    if strategy != "median" or relative_error > 0:
        return Imputer(
            inputCols=list(sizes),
            outputCols=[name + SUFFIX for name in sizes],
            strategy=strategy,
            relativeError=relative_error,
        )
    middles = {name: (size + 1) // 2 for name, size in sizes.items()}
    medians = kth_smallest(df, middles, sizes)
    filled = ", ".join(
        f"coalesce(nanvl({quoted(name)}, NULL), double('{median!r}')) AS {quoted(name + SUFFIX)}"
        for name, median in medians.items()
    )
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def count_known_values(df: DataFrame, names: dict[str, str]) -> dict[str, int]:
    """Value counts of the columns `names` (column in the frame -> name to report)."""
    sizes = count_values(df, list(names))
    empty = [names[column] for column, size in sizes.items() if size == 0]
    if empty:
        raise ValueError(f"nothing to impute from: no value at all in {empty}")
    return sizes


def impute(
    df: DataFrame,
    columns: Sequence[str],
    strategy: str = "median",
    relative_error: float = RELATIVE_ERROR,
) -> DataFrame:
    """The frame with `<column>_imp` added for each given column, as doubles."""
    safe = {name: f"__m{i}" for i, name in enumerate(columns)}
    wide = df.withColumns({alias: column(name).cast("double") for name, alias in safe.items()})
    sizes = count_known_values(wide, {alias: name for name, alias in safe.items()})
    stage = imputer_stage(wide, sizes, strategy, relative_error)
    model = stage.fit(wide) if isinstance(stage, Imputer) else stage
    filled = model.transform(wide)
    renamed = filled.withColumnsRenamed({s + SUFFIX: name + SUFFIX for name, s in safe.items()})
    return renamed.drop(*safe.values())
