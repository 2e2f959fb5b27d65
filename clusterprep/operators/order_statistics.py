"""Exact order statistics without a global sort."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterprep.functions.columns import column, unpivoted

# Up to so many columns are counted by an expression each, more are unpivoted.
_FLAT_COLUMNS = 16


@dataclass
class _Search:
    """The wanted value is the `want`-th of `size` values in the open interval (low, high)."""

    name: str
    want: int
    size: int
    low: float | None = None
    high: float | None = None
    found: float | None = None


def count_values(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Number of values (neither null nor NaN) of each column, in one pass."""
    if len(columns) <= _FLAT_COLUMNS:
        values = [column(name).cast("double") for name in columns]
        known = [F.count(F.nanvl(value, F.lit(None).cast("double"))) for value in values]
        return dict(zip(columns, df.agg(*known).first()))
    counts = (
        unpivoted(df, columns)
        .where(~F.isnan("value"))
        .groupBy("number")
        .agg(F.count("value").alias("size"))
    )
    sizes = {row["number"]: row["size"] for row in counts.collect()}
    return {name: sizes.get(number, 0) for number, name in enumerate(columns)}


def kth_smallest(
    df: DataFrame,
    wanted: dict[str, int],
    sizes: dict[str, int],
    direct_rows: int = 20_000,
    relative_error: float = 1e-3,
) -> dict[str, float]:
    """Exact k-th smallest value (from 1) of several numeric columns.

    `sizes` are the value counts of the columns (`count_values`). While more
    than `direct_rows` values are left, a grid of approximate quantiles, two
    `relative_error` apart, brackets the position and one pass counts the values
    below, at and between the bracket ends: about 0.6% are left each time. The at most `direct_rows` rest
    of a column is sorted by one task. All columns advance together in the
    unpivoted form, one group per column: a round costs two passes for any
    number of columns, and the driver gets one grid for each. A value
    that fills a third of the rows ends its search early.
    """
    for name, position in wanted.items():
        if not 1 <= position <= sizes[name]:
            raise ValueError(f"position {position} of column {name!r} is out of range")
    searches = [_Search(name, position, sizes[name]) for name, position in wanted.items()]
    while large := [s for s in searches if s.found is None and s.size > direct_rows]:
        _narrow(df, large, relative_error)
    _finish(df, [s for s in searches if s.found is None])
    return {s.name: s.found for s in searches}


def _inside(df: DataFrame, searches: list[_Search]) -> DataFrame:
    """One column v0, v1, ... per search: its values in its interval, else null."""

    def bounded(s: _Search) -> Column:
        value = column(s.name).cast("double")
        condition = ~F.isnan(value)
        if s.low is not None:
            condition &= value > s.low
        if s.high is not None:
            condition &= value < s.high
        return F.when(condition, value)

    return df.select([bounded(s).alias(f"v{i}") for i, s in enumerate(searches)])


def _narrow(df: DataFrame, searches: list[_Search], relative_error: float) -> None:
    values = _inside(df, searches)
    steps = max(2, math.ceil(0.5 / relative_error))
    grid = [i / steps for i in range(steps + 1)]
    quantiles = (
        unpivoted(values, values.columns)
        .where(F.col("value").isNotNull())
        .groupBy("number")
        .agg(F.percentile_approx("value", grid, 10 * steps).alias("grid"))
    )
    grids = {row["number"]: row["grid"] for row in quantiles.collect()}
    lows, highs = [], []
    for i, s in enumerate(searches):
        middle = int((s.want - 0.5) / s.size * steps)
        lows.append(grids[i][max(0, middle - 1)])
        highs.append(grids[i][min(steps, middle + 2)])

    value = F.col("value")
    low = F.element_at(F.lit(lows), F.col("number") + 1)
    high = F.element_at(F.lit(highs), F.col("number") + 1)
    counts = (
        unpivoted(values, values.columns)
        .where(value.isNotNull())
        .groupBy("number")
        .agg(
            F.count_if(value < low).alias("below"),
            F.count_if(value == low).alias("at_low"),
            F.count_if((value > low) & (value < high)).alias("between"),
            F.count_if((value == high) & (low < high)).alias("at_high"),
        )
    )
    for row in counts.collect():  # one row per column
        i = row["number"]
        _move(searches[i], lows[i], highs[i], row)


def _move(s: _Search, low: float, high: float, counts) -> None:
    """Continue a search in the part of its interval that holds the wanted position."""
    to_low = counts["below"] + counts["at_low"]
    to_high = to_low + counts["between"]
    past_high = to_high + counts["at_high"]
    if s.want <= counts["below"]:
        s.high, s.size = low, counts["below"]
    elif s.want <= to_low:
        s.found = low
    elif s.want <= to_high:
        s.low, s.high, s.want, s.size = low, high, s.want - to_low, counts["between"]
    elif s.want <= past_high:
        s.found = high
    else:
        s.low, s.want, s.size = high, s.want - past_high, s.size - past_high


def _finish(df: DataFrame, searches: list[_Search]) -> None:
    """Sort what is left of each column and take the wanted place."""
    if not searches:
        return
    values = _inside(df, searches)
    wants = F.lit([s.want for s in searches])
    left = (
        unpivoted(values, values.columns)
        .where(F.col("value").isNotNull())
        .groupBy("number")
        .agg(F.sort_array(F.collect_list("value")).alias("sorted"))
        .select("number", F.element_at("sorted", F.element_at(wants, F.col("number") + 1)).alias("found"))
    )
    for row in left.collect():  # one row per column
        searches[row["number"]].found = row["found"]
