"""Turn a wide table into a distinct, sampled table of usable features."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame

from clusterprep.functions.columns import numeric_columns, row_rank
from clusterprep.operators.features import cast_features, distinct_rows
from clusterprep.operators.profile import choose_features, table_profile
from clusterprep.operators.sampling import sample_bernoulli, sample_lowest
from clusterprep.session import cut_lineage

# Defaults of a preparation request.
MIN_NON_NULL_RATIO = 0.9
SEED = 42


@dataclass(frozen=True)
class PreparedData:
    """Feature rows, their columns in schema order and the input's row count."""

    df: DataFrame
    feature_cols: tuple[str, ...]
    total_rows: int

    @cached_property
    def working_rows(self) -> int:
        """Number of feature rows; counted when first asked for."""
        return self.df.count()


def prepare_training_data(
    df: DataFrame,
    min_non_null_ratio: float = MIN_NON_NULL_RATIO,
    target_rows: int | None = None,
    seed: int = SEED,
    exclude: Iterable[str] = (),
    sampling: str = "exact",
    rank: Callable[[list[str]], Column] | None = None,
) -> PreparedData:
    """Select usable numeric columns, cast them to double and drop copies; sample if asked.

    A column is usable if it is filled enough and varies; both are measured on
    the raw rows in one pass. `exclude` names columns that must not become
    features, such as identifiers.

    All distinct rows are kept unless `target_rows` asks for a sample. Then
    `sampling="exact"` takes exactly so many distinct rows, the same ones for any
    layout, and shuffles only about that many; `"bernoulli"` draws rows
    independently after a full distinct and returns at most so many. `rank` replaces the row hash that
    orders an exact sample: a function from the feature names to a column of
    ranks in [0, 1).
    """
    if sampling not in ("exact", "bernoulli"):
        raise ValueError("sampling must be 'exact' or 'bernoulli'")
    names = numeric_columns(df, exclude)
    profile = table_profile(df, names).collect()
    features = choose_features(profile, names, min_non_null_ratio)
    total = profile[0].total_rows
    rows = cast_features(df, features)

    if target_rows is None or (sampling == "exact" and total <= target_rows):
        sample = distinct_rows(rows)
    elif sampling == "exact":
        by = row_rank(features, seed) if rank is None else rank(features)
        sample = sample_lowest(rows, target_rows, by, total, distinct=True)
    else:
        distinct = cut_lineage(distinct_rows(rows), "distinct")
        sample = sample_bernoulli(distinct, target_rows, seed)
    return PreparedData(sample, tuple(features), total)
