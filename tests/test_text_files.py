"""Text, JSON-lines and Parquet: sources, sinks and word count."""

import sys

import pytest
from pyspark.sql import functions as F

from clusterprep.functions.text import words
from clusterprep.operators.word_count import word_count
from clusterprep.session import cut_lineage, fresh_path, shared_folder
from clusterprep.sinks.files import rows_to_json, write_jsonl, write_parquet
from clusterprep.sources.files import read_jsonl, read_lines, read_parquet


def test_words_are_split_like_str_split(spark):
    text = "a b c \t\nd\x1ce\x85f"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(words(F.col("t"))).first()[0] == text.split()


def test_every_character_separates_as_in_str_split(spark):
    codes = [i for i in range(1, sys.maxunicode + 1) if not 0xD800 <= i <= 0xDFFF and i < 0x30000]
    df = spark.range(1, 0x30000, 1, 8).where("id < 55296 OR id > 57343")
    text = F.concat(F.lit("a"), F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32"), F.lit("b"))
    split = {r.id for r in df.select("id", words(text).alias("w")).where(F.size("w") == 2).collect()}
    assert split == {i for i in codes if len(f"a{chr(i)}b".split()) == 2}


def test_word_count(spark):
    texts = ["  the cat\tthe  dog ", "", " ", None, "dogé the", "Zebra"]
    df = spark.createDataFrame([(t,) for t in texts], "`a.b` string")
    rows = [tuple(r) for r in word_count(df, "a.b").collect()]
    expected = {}
    for t in texts:
        for w in (t or "").split():
            expected[w] = expected.get(w, 0) + 1
    assert rows == sorted(expected.items())


def test_word_count_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([("a b",)], "value string")
    plan = word_count(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "rangepartitioning" in plan


def test_lines(spark, tmp_path):
    (tmp_path / "t.txt").write_bytes("a b\n\nc\r\nlast".encode())
    lines = read_lines(spark, str(tmp_path))
    assert sorted(r.value for r in lines.collect()) == ["", "a b", "c", "last"]
    assert {tuple(r) for r in word_count(lines).collect()} == {("a", 1), ("b", 1), ("c", 1), ("last", 1)}


def test_json_rows_leave_nulls_out(spark):
    df = spark.createDataFrame([(1, None, "ä\"x"), (None, None, None)], "`a.b` int, n double, s string")
    texts = sorted(r.json for r in rows_to_json(df).collect())
    assert texts == ['{"a.b":1,"s":"ä\\"x"}', "{}"]


def test_jsonl_keeps_columns_that_are_null_everywhere(spark):
    df = spark.createDataFrame([(1.5, None, 2), (None, None, 3)], "z double, n double, b int")
    path = fresh_path(spark, "json")
    write_jsonl(df, path)
    back = read_jsonl(spark, path, df.schema)
    assert back.dtypes == df.dtypes
    assert back.exceptAll(df).count() == 0 and back.count() == 2
    assert read_jsonl(spark, path).columns == ["b", "z"]


def test_malformed_json_is_an_error_unless_allowed(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a":1}\n{"a":\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_jsonl(spark, str(tmp_path), "a int").collect()
    assert read_jsonl(spark, str(tmp_path), "a int", mode="DROPMALFORMED").collect()[0].a == 1


def test_parquet_files(spark):
    path = fresh_path(spark, "p")
    write_parquet(spark.range(100), path, files=3)
    assert len(read_parquet(spark, path).inputFiles()) == 3
    write_parquet(spark.range(10), path, files=1)
    assert read_parquet(spark, path).count() == 10


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = cut_lineage(spark.range(5).select(F.col("id").alias("a.b")))
    assert df.inputFiles()[0].startswith("file://" + shared_folder(spark))
    assert df.columns == ["a.b"] and df.count() == 5
