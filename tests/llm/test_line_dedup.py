import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clusterprep.llm import line_dedup
from clusterprep.llm.arrays import text_bytes
from tests.llm.frames import docs, empty


def tokens(line):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), line)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    k = min(line_dedup.K, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def brute(texts):
    earlier, removed = [], {}
    for i, text in enumerate(texts):
        removed[i] = []
        for n, line in enumerate((text or "").split("\n")):
            own = tokens(line)
            if own and any(len(own & x) / len(own | x) >= line_dedup.SIMILARITY - 1e-9 for x in earlier):
                removed[i].append(n)
            if own:
                earlier.append(own)
    return removed


def corpus(seed, groups, size, length):
    rng = random.Random(seed)
    lines = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randint(0, 12))) for _ in range(60)]
    for _ in range(groups):
        base = [f"v{rng.randrange(300)}" for _ in range(length)]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(length)] = f"n{rng.randrange(1000)}"
            lines.append(" ".join(words[: rng.randint(length - 4, length)]))
    rng.shuffle(lines)
    texts, at = [], 0
    while at < len(lines):
        n = rng.randint(1, 6)
        texts.append("\n".join(lines[at : at + n]))
        at += n
    return texts


def found(frame):
    rows = line_dedup.repeated_lines(frame).collect()
    return {r["doc_id"]: (r["n_lines"], list(r["removed"])) for r in rows}


@pytest.mark.parametrize("seed,groups,size,length", [(1, 15, 5, 50), (2, 1, 70, 60), (3, 40, 3, 8)])
def test_against_all_pairs(spark, seed, groups, size, length):
    texts = corpus(seed, groups, size, length) + [None, "", "\n\n", "---\n---", "Word\nword!\nword"]
    expected = brute(texts)
    got = found(docs(spark, texts))
    assert got == {i: ((t or "").count("\n") + 1, expected[i]) for i, t in enumerate(texts)}


@pytest.mark.parametrize("growth", [2, 16])
def test_tokens_that_many_lines_share(spark, monkeypatch, growth):
    monkeypatch.setattr(line_dedup, "SMALL", 2)
    monkeypatch.setattr(line_dedup, "GROWTH", growth)
    texts = corpus(5, 1, 50, 60)
    assert {i: r for i, (_, r) in found(docs(spark, texts)).items()} == brute(texts)


@pytest.mark.parametrize("size", range(1, 60))
def test_prefixes_hold_a_shared_token(size):
    """The largest number of tokens that matching sets of these sizes may miss is inside."""
    s = line_dedup.SIMILARITY
    for other in range(size, int(size / s + 1e-9) + 1):
        shared = next(n for n in range(size + 1) if n >= s / (1 + s) * (size + other) - 1e-9)
        probe = other - line_dedup._whole(s * other) + 1
        index = size - line_dedup._whole(2 * s / (1 + s) * size) + 1
        assert probe > other - shared and index >= size - shared + 1 or shared > size


def test_dropped_lines(spark):
    frame = docs(spark, ["a b\nkeep\n\na b", "a b\nx", None, "A b!"], [1, 2, 3, None])
    rows = {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(frame).collect()}
    assert rows == {1: "a b\nkeep\n", 2: "x", 3: None, None: ""}
    assert line_dedup.drop_lines(frame).columns == frame.columns


def test_repeated_rows_and_empty_table(spark):
    frame = docs(spark, ["one line"] * 5, [7] * 5)
    assert sorted(len(r["removed"]) for r in line_dedup.repeated_lines(frame).collect()) == [0, 1, 1, 1, 1]
    assert line_dedup.repeated_lines(empty(spark)).count() == 0


def test_words_of_candidates_by_a_shuffled_join(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    texts = corpus(9, 8, 6, 50)
    assert {i: r for i, (_, r) in found(docs(spark, texts)).items()} == brute(texts)


def test_keys_tell_lines_by_their_words_in_order():
    texts = ["a b\nb a\nA, B!\n\na\nb\na a", None, "a b", "ä b\n--\nab"]
    lines = line_dedup.Lines(*text_bytes(pa.array(texts)))
    keys = list(zip(*map(np.ndarray.tolist, lines.keys())))
    words = []
    for text in texts:
        for line in (text or "").split("\n"):
            own = tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line.lower()))
            words += [own] if own else []
    assert len(keys) == len(words)
    assert len(set(keys)) == len(set(words)) == len(set(zip(keys, words)))


def test_lines_met_by_common_tokens_only(spark):
    base = "a b c d e f g h i"
    texts = [base] * (line_dedup.COMMON + 9) + [f"{base} w{n}" for n in range(30)] + ["a b c d e x y z v"]
    assert {i: r for i, (_, r) in found(docs(spark, texts)).items()} == brute(texts)


def test_only_repeated_or_matched_lines_are_judged(spark, monkeypatch):
    texts = [f"line {n} alone" for n in range(200)] + ["two of this", "two of this"]
    base = "a b c d e f g h i"
    texts += [base, base + " j"]
    rows, write = {}, line_dedup.cut_lineage

    def counted(df, label="stage"):
        written = write(df, label)
        rows[label] = written.count()
        return written

    monkeypatch.setattr(line_dedup, "cut_lineage", counted)
    assert {i: r for i, (_, r) in found(docs(spark, texts)).items()} == brute(texts)
    assert rows["sets"] == 203 and rows["judged"] == 2


def test_ids_that_cannot_be_null(spark):
    frame = docs(spark, ["a b", "c d", "a b"]).withColumn("doc_id", F.monotonically_increasing_id())
    assert sorted(r["removed"] for r in line_dedup.repeated_lines(frame).collect()) == [[], [], [0]]


def test_similarity_of_pairs_at_once():
    rng = random.Random(4)
    pairs = []
    for _ in range(300):
        left = [rng.randrange(1 << 32) for _ in range(rng.randint(1, 30))] * rng.randint(1, 2)
        right = [w if rng.random() < 0.9 else 7 for w in left][: rng.randint(1, 40)]
        pairs.append((left, right))

    def runs(words):
        k = min(line_dedup.K, len(words))
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}

    def binary(lists):
        return pa.array([b"", *(np.array(words, np.uint32).tobytes() for words in lists)])[1:]

    got = line_dedup.jaccard(*map(binary, zip(*pairs)))
    assert got.tolist() == [len(runs(a) & runs(b)) / len(runs(a) | runs(b)) for a, b in pairs]
