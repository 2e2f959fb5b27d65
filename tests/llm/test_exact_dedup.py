import hashlib
import re

import pytest
from pyspark.sql import functions as F

from clusterprep.llm.exact_dedup import drop_copies, mark_copies
from tests.llm.frames import by_id, docs, empty

TEXTS = [
    "a b", "ab", "a  b\n", None, "", " \t\n\x0b\x0c\r", "c", "ab ", "é", "é",
    "x" * 200_000, "x " * 200_000, "ab",
]


def brute(texts, ids):
    groups = {}
    for row, (i, text) in enumerate(zip(ids, texts)):
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(bare, []).append((-len(text or ""), i is None, i if i is not None else 0, row, i))
    found = {}
    for bare, members in groups.items():
        best = min(members)
        for *_, row, i in members:
            digest = hashlib.sha256(bare.encode()).hexdigest()
            found[row] = (i, best[-1], len(members), row == best[-2], digest)
    return found


def test_groups(spark):
    found = mark_copies(docs(spark, TEXTS))
    got = by_id(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == {r[0]: r for r in brute(TEXTS, range(len(TEXTS))).values()}


def one_letter(text):
    return F.substring(F.md5(text), 1, 1)


@pytest.mark.parametrize("digest", [one_letter, lambda text: F.lit("same")])
def test_collisions_are_told_apart_by_their_bytes(spark, digest):
    texts = [f"t{i % 30}" for i in range(90)]
    got = by_id(mark_copies(docs(spark, texts), digest=digest), "keep_id", "group_size")
    assert got == {i: (i % 30, 3) for i in range(90)}


def test_repeated_rows_and_missing_ids(spark):
    frame = docs(spark, ["a", "a", "a", "b", "b", "c"], [5, 5, None, None, None, None])
    rows = mark_copies(frame).collect()
    assert sum(r["kept"] for r in rows) == 3
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in rows} == {
        (5, 5, 3), (None, 5, 3), (None, None, 2), (None, None, 1),
    }
    kept = drop_copies(frame)
    assert kept.columns == frame.columns
    assert sorted(r["text"] for r in kept.collect()) == ["a", "b", "c"]


def test_a_third_of_all_rows_equal(spark):
    texts = ["same text"] * 400 + [f"text {i}" for i in range(800)]
    found = mark_copies(docs(spark, texts, partitions=8))
    assert found.where("kept").count() == 801
    assert found.where("group_size = 400 AND keep_id = 0").count() == 400


def test_empty_table(spark):
    assert mark_copies(empty(spark)).count() == 0 and drop_copies(empty(spark)).count() == 0
