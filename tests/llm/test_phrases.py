import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from clusterprep.llm import phrases, queries
from tests.llm.frames import SCHEMA


def brute(rows, max_words, min_count, top):
    """Rows are (lang, text)."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            own = counts.setdefault(lang, Counter())
            for n in range(1, max_words + 1):
                own.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    found = set()
    for lang, own in counts.items():
        rows = []
        candidates = [p for p, a in own.items() if len(p) > 1 and a >= min_count]
        parts = {}
        for p in candidates:
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    parts.setdefault(p[i : i + n], set()).add(own[p])
        for p in candidates:
            a, n = own[p], totals[lang]
            if any(100 * f >= 100 * a for f in parts.get(p, ())):
                continue
            cuts = [(1000 * a * n // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]], n))
        for rank, (score, a, phrase, x, y, n) in enumerate(sorted(rows)[:top], 1):
            found.add((lang, rank, phrase.decode(), -a, x, y, n, -score))
    return found


def frame(spark, rows, partitions=4):
    made = [(i, text, lang, "s", 1, 2, "x") for i, (lang, text) in enumerate(rows)]
    return spark.createDataFrame(made, SCHEMA).repartition(partitions)


def mined(df, **options):
    rows = [tuple(r) for r in phrases.mine_phrases(df, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, count, words, langs=("en", "de", None)):
    rng = random.Random(seed)
    names = [f"w{n}" for n in range(words)] + ["Über", "a\x01", "a", "\x00", "ß", "\U0001f600", "A-b", "'x'", "a\x1fb"]
    fixed = [rng.choices(names, k=rng.randint(2, 7)) for _ in range(6)]
    rows = []
    for _ in range(count):
        text = ""
        for _ in range(rng.randint(0, 12)):
            part = rng.choice(fixed) if rng.random() < 0.4 else rng.choices(names, k=rng.randint(1, 4))
            text += rng.choice([" ", " ", "\t", ".", ", ", "\n", "\r\n", "\x0b", "  "]) + " ".join(part)
        rows.append((rng.choice(langs), text))
    return rows


AWKWARD = [("en", None), (None, ""), ("en", " \t.,;"), ("fr", "x"), ("", "a b a b a b a b"), ("und", "w1 w2 w1 w2")]


@pytest.mark.parametrize("seed,words,partitions", [(1, 3, 1), (2, 12, 8), (3, 30, 40), (4, 8, 20)])
def test_equals_brute_force(spark, seed, words, partitions):
    rows = corpus(seed, 400, words) + AWKWARD * 3
    options = {"max_words": 5, "min_count": 6, "top": 50}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        assert mined(frame(spark, rows), **options) == brute(rows, **options)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_phrase_in_most_rows_spreads(spark):
    rows = [("en", f"the same start of v{n % 37} u{n % 11} " + "the same start of all") for n in range(600)]
    rows += [("en", "a " * 500)] * 3
    options = {"max_words": 4, "min_count": 5, "top": 500}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        assert mined(frame(spark, rows), **options) == brute(rows, **options)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["lang"], r["text"]) for r in table.collect()]
    found = {tuple(r) for r in queries.op11_phrases(spark, sf_dir).collect()}
    assert found == brute(rows, 5, 100, 2000)
    few = {"max_words": 5, "min_count": 5, "top": 2000}
    assert mined(table, **few) == brute(rows, **few)


def test_many_different_words_in_a_slab():
    """Places of words that don't fit into one number."""
    rng = random.Random(9)
    text = " ".join(f"w{rng.randrange(70_000)}" for _ in range(200_000))
    slab = pa.RecordBatch.from_arrays([pa.array([text, "\x00 \x01 a"]), pa.array(["en", "x"])], ["text", "lang"])
    keys, times = phrases._counted(phrases.Pieces(slab), 5)
    keys = keys.cast(pa.binary()).to_pylist()
    words = text.split()
    expected = Counter("\x00".join(["en", *words[i : i + 5]]).encode() for i in range(len(words)))
    expected.update([b"x\0\1\1\0\1\2\0a", b"x\0\1\2\0a", b"x\0a"])
    assert dict(zip(keys, times.tolist())) == expected and keys == sorted(expected)


def test_counts_past_64_bits(spark):
    df = spark.createDataFrame(
        [("en", ["a", "b", "c"], 10**9, 10**16, [10**10, 10**9], [10**12, 10**9])],
        "lang string, words array<string>, f long, n long, starts array<long>, ends array<long>",
    )
    (row,) = phrases._scored(df).collect()
    assert tuple(row)[2:] == (10**9, 10**9, 10**12, 10**16, 10**7)


def test_long_texts_and_empty_table(spark):
    rows = [("en", "one two. " * 200_000), ("en", "x" * 1_000_000)]
    options = {"max_words": 3, "min_count": 100, "top": 10}
    assert mined(frame(spark, rows), **options) == brute(rows, **options)
    assert mined(spark.createDataFrame([], SCHEMA)) == set()
