import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterprep.llm import language_id, quality
from clusterprep.llm.queries import op1_quality, op9_language_id
from clusterprep.llm.rows import in_held_out
from tests.llm.frames import by_id, docs, empty

SF_DIR = "/root/testdata/sf0.1"
SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["zu", "xe", "qo"]}


def speak(rng, lang, words=30):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(words))


def labelled(spark, per_lang=40):
    rng = random.Random(1)
    rows = [(i * 2 + n, speak(rng, lang), lang) for n, lang in enumerate(SYLLABLES) for i in range(per_lang)]
    rows += [(9001, None, "aa"), (9002, "kalo", None), (None, "zuxe", "bb")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages(spark):
    model = language_id.fit_language_model(labelled(spark))
    assert model.languages == ["aa", "bb"]
    rng = random.Random(2)
    texts = [speak(rng, "aa"), speak(rng, "bb").upper(), None, "", "12 !!", "KALO 3 mi", speak(rng, "aa", 40_000)]
    found = by_id(language_id.identify_language(docs(spark, texts), model), "lang_pred", "score")
    assert [found[i][0] for i in range(7)] == ["aa", "bb", "und", "und", "und", "aa", "aa"]
    assert all(0 <= score <= 1 for _, score in found.values()) and found[2][1] == 0.0
    assert language_id.identify_language(empty(spark), model).count() == 0


def test_language_scores_are_those_of_plain_naive_bayes(spark):
    model = language_id.fit_language_model(labelled(spark))
    for text in ("Kalo ZU", "xe-ka", "mimimi lo"):
        buckets, _, _ = language_id.gram_buckets([text])
        totals = model.log_prior + model.log_likelihood[:, buckets].sum(axis=1)
        chances = np.exp(totals - totals.max())
        _, score = model.score([text])
        assert score[0] == pytest.approx(chances.max() / chances.sum(), rel=1e-4)


def plain_buckets(text):
    """N-grams of a text, one letter at a time, in plain integers."""

    def bucket(value):
        value ^= value >> 15
        value = value * 0x2C1B3C6D % 2**32
        value ^= value >> 13
        return value % language_id.BUCKETS

    found = []
    letters = [ord(c) if c.isalpha() else 0 for c in text.lower()]
    for n, here in enumerate(letters):
        if not here:
            continue
        before = letters[n - 1] if n else 0
        after = letters[n + 1] if n + 1 < len(letters) else 0
        one = here * 0x9E3779B1 % 2**32
        two = one ^ ((before * 0x85EBCA6B + 1) % 2**32)
        three = (two * 0x27D4EB2F + after * 0xC2B2AE35 + 2) % 2**32
        found += [bucket(one), bucket(two), bucket(three)]
    return found


def test_training_counts_are_those_of_single_letters(spark):
    rng = random.Random(8)
    letters = "abcÄßéΣ 1-,.\n😀"
    rows = [
        (i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60))), rng.choice(["x", "y"]))
        for i in range(80)
    ]
    model = language_id.fit_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for k, lang in enumerate(["x", "y"]):
        counts = np.full(language_id.BUCKETS, language_id.SMOOTHING)
        for _, text, own in rows:
            if own == lang:
                for bucket in plain_buckets(text):
                    counts[bucket] += 1
        assert model.log_likelihood[k] == pytest.approx(np.log(counts / counts.sum()), rel=1e-4)
        assert model.log_prior[k] == pytest.approx(np.log(sum(r[2] == lang for r in rows) / 80))


def test_batches_do_not_change_language_scores(spark):
    model = language_id.fit_language_model(labelled(spark))
    texts = ["kalo", "", "zu", "x", "12", "lo mi"]
    together = model.score(texts)
    apart = [model.score([t]) for t in texts]
    assert together[0] == [a[0][0] for a in apart]
    assert together[1] == pytest.approx([a[1][0] for a in apart])


def test_nothing_to_learn_from(spark):
    model = language_id.fit_language_model(labelled(spark).limit(0))
    assert by_id(language_id.identify_language(docs(spark, ["abc"]), model), "lang_pred") == {0: ("und",)}
    marks = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_quality_model(docs(spark, ["abc"]), marks)
    assert by_id(quality.score_quality(docs(spark, ["abc", None]), model), "score") == {0: (0.5,), 1: (0.5,)}


def quality_model(spark):
    rng = random.Random(4)
    texts = [speak(rng, "aa") if i % 3 else "### " * 20 + speak(rng, "bb", 3) for i in range(90)]
    marks = [(i, int(i % 3 > 0)) for i in range(90)] + [(1, 0), (500, 1), (7, None), (None, 1)]
    return quality.fit_quality_model(
        docs(spark, texts), spark.createDataFrame(marks, "doc_id long, quality int"), rows_per_label=25
    )


def test_quality(spark):
    model = quality_model(spark)
    assert len(model.labels) == 50 and model.labels.sum() == 25
    rng = random.Random(5)
    texts = [speak(rng, "aa"), "### " * 30, None, "", speak(rng, "aa", 50_000)]
    frame = docs(spark, texts, [0, 1, 2, 3, 4])
    found = by_id(quality.score_quality(frame, model), "score")
    assert found[0][0] > 0.9 and found[1][0] < 0.1 and found[4][0] > 0.9
    assert all(0 <= score <= 1 for (score,) in found.values())
    kept = quality.keep_quality(frame, model, 0.9)
    assert kept.columns == frame.columns and {0, 4} <= {r["doc_id"] for r in kept.collect()}
    assert quality.score_quality(empty(spark), model).count() == 0


def test_votes_are_exact(spark, monkeypatch):
    model = quality_model(spark)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(20, model.vectors.shape[1])).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    monkeypatch.setattr(quality, "BLOCK", 7)
    got = model.vote(vectors)
    for vector, score in zip(vectors, got):
        cosines = model.vectors @ vector
        nearest = np.argsort(-cosines, kind="stable")[: quality.NEIGHBOURS]
        weight = np.clip(cosines[nearest], 0, 1).astype(float) ** quality.SHARPNESS
        total = (weight * model.labels[nearest]).sum() + quality.PRIOR_WEIGHT * model.prior
        assert score == pytest.approx(total / (weight.sum() + quality.PRIOR_WEIGHT), rel=1e-4)


def test_of_equal_references_the_earlier_vote(monkeypatch):
    """Many equal references with mixed labels, in blocks of any size."""
    rng = np.random.default_rng(3)
    three = np.eye(4, dtype=np.float32)[:3]
    which = rng.integers(0, 3, 400)
    labels = rng.integers(0, 2, 400).astype(np.float32)
    model = quality.QualityModel(np.ones(1), np.ones((1, 1)), three[which], labels, 0.5)
    vector = np.array([[0.8, 0.6, 0, 0]], np.float32)
    nearest = [*np.flatnonzero(which == 0), *np.flatnonzero(which == 1), *np.flatnonzero(which == 2)]
    nearest = np.array(nearest)[: quality.NEIGHBOURS]
    weight = (three[which[nearest]] @ vector[0]).astype(float) ** quality.SHARPNESS
    total = (weight * labels[nearest]).sum() + quality.PRIOR_WEIGHT * 0.5
    for block in (5, 64, 1000):
        monkeypatch.setattr(quality, "BLOCK", block)
        got = model.vote(vector)[0]
        assert got == pytest.approx(total / (weight.sum() + quality.PRIOR_WEIGHT), rel=1e-5)


def test_held_out_rule(spark):
    import zlib

    rows = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    got = {r[0]: r[1] for r in rows.select("doc_id", in_held_out(F.col("doc_id"))).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)} | {None: False}


def test_held_out_accuracy(spark):
    docs_ = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    langs = op9_language_id(spark, SF_DIR).filter("held_out").join(docs_.select("doc_id", "lang"), "doc_id")
    right, total = langs.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert right / total > 0.98
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    marked = op1_quality(spark, SF_DIR).filter("held_out").join(labels, "doc_id")
    rates = {
        r["quality"]: r["right"]
        for r in marked.groupBy("quality")
        .agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right"))
        .collect()
    }
    assert rates[1] > 0.98 and rates[0] > 0.95
