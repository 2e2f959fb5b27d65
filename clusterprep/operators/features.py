"""Feature table: cast, distinct, assemble, scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame

from clusterprep.functions.columns import column


def cast_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns as doubles, under their own names."""
    return df.select([column(name).cast("double").alias(name) for name in columns])


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows. Null equals null, NaN equals NaN and -0.0 equals 0.0.

    Repeated rows are merged before the shuffle, so copies of one row do not
    gather in a task.
    """
    return df.dropDuplicates()


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features_raw") -> DataFrame:
    """Add a vector column made of the given columns; a null value is an error."""
    safe = {name: f"__v{i}" for i, name in enumerate(columns)}
    wide = df.withColumns({alias: column(name).cast("double") for name, alias in safe.items()})
    vectors = VectorAssembler(inputCols=list(safe.values()), outputCol=output).transform(wide)
    return vectors.drop(*safe.values())


def standard_scale(
    df: DataFrame, input_col: str = "features_raw", output_col: str = "features"
) -> DataFrame:
    """Add `(x - mean) / stddev_samp` of a vector column; 0.0 where nothing varies."""
    scaler = StandardScaler(inputCol=input_col, outputCol=output_col, withMean=True, withStd=True)
    return scaler.fit(df).transform(df)
