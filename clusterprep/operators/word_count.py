"""Word count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterprep.functions.columns import column
from clusterprep.functions.text import words


def word_count(df: DataFrame, text_col: str = "value") -> DataFrame:
    """`word` and `count`, in byte order of the words.

    Counts are combined before the shuffle, so a frequent word costs one row
    per task; the final order is a range partitioning, not one task.
    """
    return (
        df.select(F.explode(words(column(text_col))).alias("word"))
        .where(F.col("word") != "")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("word")
    )
