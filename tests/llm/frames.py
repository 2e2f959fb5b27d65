"""Small document tables with every awkward case."""

from pyspark.sql import Row

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, `a.b` string"


def docs(spark, texts, ids=None, partitions=3):
    """Documents of the given texts; ids count from 0 unless given. Extra columns clash in name."""
    rows = [
        Row(i, text, None, "s", None, 7, "x")
        for i, text in zip(range(len(texts)) if ids is None else ids, texts)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    """Rows as a dictionary by id; ids must be unique."""
    rows = [r.asDict(recursive=True) for r in df.collect()]
    found = {r["doc_id"]: r for r in rows}
    assert len(found) == len(rows)
    if not columns:
        return found
    return {i: tuple(r[c] for c in columns) for i, r in found.items()}
