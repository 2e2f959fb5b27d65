"""Exact duplicates: groups of equal content, whatever their white space.

Rows are grouped by a 128-bit hash of the text without white space. The bytes
of the texts inside each group are then compared; a group of different texts
(a collision) is split by a second hash.

Of equal texts the one with the most code points stays, then the smallest id,
then the first row. A null text counts as empty, and empty texts are equal to
each other. A null id comes after all others. Rows that repeat with their id
are copies as well: one of them stays. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterprep.llm.rows import picked, small, with_row, without
from clusterprep.session import cut_lineage

WHITE_SPACE = " \t\n\x0b\x0c\r"


def without_white_space(text: Column) -> Column:
    return reduce(
        lambda value, char: F.replace(value, F.lit(char), F.lit("")),
        WHITE_SPACE,
        F.coalesce(text, F.lit("")),
    )


def mark_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
    digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per row of `docs`: row, doc_id, keep_id, group_size, kept, text_sha256.

    Only hashes are shuffled, with partial results per task; of the texts, only
    those of groups of two or more, as the smallest and largest per task.
    """
    columns = {"doc_id": id_col, "text": text_col} | ({"row": row_col} if row_col else {})
    docs = picked(docs, **columns)
    bare = without_white_space(F.col("text"))
    hashed = cut_lineage(
        docs.select(
            (F.col("row") if row_col else F.monotonically_increasing_id()).alias("row"),
            "doc_id",
            F.length(F.coalesce("text", F.lit(""))).alias("chars"),
            digest(bare).alias("digest"),
            F.sha2(bare, 256).alias("text_sha256"),
        ),
        "digests",
    )
    several = hashed.groupBy("digest").count().filter("count > 1").select("digest")
    several = cut_lineage(several, "several")
    split = cut_lineage(_collisions(docs, bare, digest, several), "collisions")
    marked = small(split.withColumn("collides", F.lit(True)))
    hashed = hashed.join(marked, "digest", "left").withColumn(
        "digest", F.when(F.col("collides"), F.concat("digest", "text_sha256")).otherwise(F.col("digest"))
    )
    # min() of a structure: its fields decide in turn.
    best = F.min(F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row")))
    groups = (
        hashed.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .filter("group_size > 1")
        .select(
            "digest",
            "group_size",
            F.col("best.doc_id").alias("keep_id"),
            F.col("best.row").alias("keep_row"),
        )
    )
    groups = cut_lineage(groups, "groups")
    alone = F.col("keep_row").isNull()
    return hashed.join(groups, "digest", "left").select(
        "row",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )


def _collisions(
    docs: DataFrame, bare: Column, digest: Callable[[Column], Column], several: DataFrame
) -> DataFrame:
    """Digests that texts of different bytes share."""
    texts = docs.select(digest(bare).alias("digest"), bare.alias("bare"))
    return (
        texts.join(small(several), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min("bare").alias("least"), F.max("bare").alias("most"))
        .filter("least <> most")
        .select("digest")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each group, and all its columns."""
    rows, row = with_row(docs)
    dropped = mark_copies(rows, id_col, text_col, row).filter(~F.col("kept"))
    return without(rows, row, dropped.select(F.col("row").alias(row)))
