"""Samples and first rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clusterprep.functions.columns import column, row_rank
from clusterprep.operators.order_statistics import kth_smallest
from clusterprep.session import cut_lineage

_RANK = "__rank"
_NUMBER = "__number"
_COUNT = "__count"
_RUNNING = "__running"


def sample_fraction(df: DataFrame, fraction: float, rank: Column) -> DataFrame:
    """Rows whose rank in [0, 1) is below the fraction: a map-only, repeatable sample."""
    return df.where(rank < F.lit(fraction))


def sample_lowest(
    df: DataFrame, n: int, rank: Column, total_rows: int | None = None, distinct: bool = False
) -> DataFrame:
    """The n rows of lowest rank, or all rows if there are no more than n.

    With `distinct`, repeated rows count once (`rank` must then be a function
    of the row's values). Of rows with the rank at the cut any are taken: with
    `row_rank` these are copies of one row, so that the result depends on the
    data and not on its layout.

    Ranks are uniform over distinct rows, so the n lowest lie below about n/N.
    Only rows below such a bound, a little above n of them, are shuffled and
    written to the shared folder; if they turn out to be fewer than n the bound
    is raised by what was observed, until it holds n rows or the whole table.
    The cut at exactly n is then a filter, so no task ever sees all n rows.
    """
    if n < 1:
        raise ValueError("the sample size must be at least 1")
    total = df.count() if total_rows is None else total_rows
    if total <= n:
        return df.dropDuplicates() if distinct else df

    wanted = n + 6 * math.sqrt(n) + 10
    share = min(1.0, wanted / total)
    while True:
        kept = df.where(rank < F.lit(share)) if share < 1.0 else df
        if distinct:
            kept = kept.dropDuplicates()
        candidates = cut_lineage(kept.withColumn(_RANK, rank), "sample")
        found = candidates.count()
        if found >= n or share == 1.0:
            break
        # Low estimate of what the bound holds: better some rows too many than one more pass.
        surely = max(1.0, found - 2 * math.sqrt(found))
        share = min(1.0, max(2 * share, share * wanted / surely))
    if found <= n:
        return candidates.drop(_RANK)

    cut = kth_smallest(candidates, {_RANK: n}, {_RANK: found})[_RANK]
    counts = candidates.agg(
        F.count(F.when(F.col(_RANK) < cut, 1)).alias("below"),
        F.count(F.when(F.col(_RANK) == cut, 1)).alias("at"),
    ).first()
    if counts["below"] + counts["at"] == n:
        return candidates.where(F.col(_RANK) <= cut).drop(_RANK)
    tied = _first_in_order(candidates.where(F.col(_RANK) == cut).drop(_RANK), n - counts["below"])
    return candidates.where(F.col(_RANK) < cut).drop(_RANK).unionByName(tied)


def _first_in_order(df: DataFrame, n: int) -> DataFrame:
    """The n first rows (of more than n) in the order of their values.

    Copies are counted, and the different rows sorted with their counts, to
    find the row at the cut; the result is a filter, plus some of that row's
    copies. So no task sees all copies of a row.
    """
    values = [column(name) for name in df.columns]
    counted = df.groupBy(*values).agg(F.count(F.lit(1)).alias(_COUNT)).orderBy(*values)
    counted = cut_lineage(counted.withColumn(_NUMBER, F.monotonically_increasing_id()), "tied")
    # The upper bits of the numbers are the partition: sorted ranges, in order.
    part = F.shiftright(F.col(_NUMBER), 33)
    parts = counted.groupBy(part.alias("part")).agg(F.sum(_COUNT).alias("rows")).orderBy("part")
    left = n
    for row in parts.collect():  # one row per partition
        if row["rows"] >= left:
            break
        left -= row["rows"]
    running = F.sum(_COUNT).over(Window.partitionBy(part).orderBy(_NUMBER))
    last = (
        counted.where(part == row["part"])
        .withColumn(_RUNNING, running)
        .where(F.col(_RUNNING) >= left)
        .orderBy(_NUMBER)
        .first()
    )
    border = F.struct(
        *[F.lit(last[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    own = F.struct(*values)
    copies = left - (last[_RUNNING] - last[_COUNT])
    return df.where(own < border).unionByName(_any_rows(df.where(own == border), copies))


def _any_rows(df: DataFrame, n: int) -> DataFrame:
    """n of the rows, from the first partitions of their written form.

    One count per partition reaches the driver; the cut is a filter, so no task
    sees more than its own rows.
    """
    numbered = cut_lineage(df.withColumn(_NUMBER, F.monotonically_increasing_id()), "tied")
    number = F.col(_NUMBER)
    # The upper bits are the partition, the lower 33 count its rows from 0.
    part = F.shiftright(number, 33)
    counts = numbered.groupBy(part.alias("part")).count().orderBy("part").collect()
    last, left = -1, n
    for row in counts:
        if row["count"] > left:
            last = row["part"]
            break
        left -= row["count"]
    else:
        return numbered.drop(_NUMBER)
    cut = (last << 33) + left
    return numbered.where(number < F.lit(cut)).drop(_NUMBER)


def sample_bernoulli(df: DataFrame, n: int, seed: int, total_rows: int | None = None) -> DataFrame:
    """Independent draws at rate n/rows, then at most n of them, those of lowest hash rank.

    Gives up to n rows, often fewer, and another sample for another layout, so
    the draw is written to the shared folder. Use `sample_lowest` for an exact
    and repeatable one.
    """
    total = df.count() if total_rows is None else total_rows
    if total <= n:
        return df
    drawn = cut_lineage(df.sample(False, n / total, seed), "drawn")
    return sample_lowest(drawn, n, row_rank(df.columns, seed + 1))


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """Any n rows (all, if there are fewer): Spark's limit.

    It first runs as few tasks as may do and at most n rows of each go to the
    one task that cuts them. Meant for small copies: for a large share of a
    table use `sample_fraction`, which shuffles nothing.
    """
    return df.limit(n)
