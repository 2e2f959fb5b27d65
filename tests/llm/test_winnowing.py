import random
import re
import time

import numpy as np
import pytest

from clusterprep.llm import winnowing
from clusterprep.llm.arrays import Words, text_bytes
from tests.llm.frames import by_id, docs, empty

import pyarrow as pa


def words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        theirs = words(item_text)
        n = min(10, len(theirs))
        windows = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(own), len(hit), sorted(found)


def measured(frame, items, **options):
    rows = by_id(winnowing.shared_runs(frame, items, **options))
    return {
        i: (
            r["n_words"],
            len({w for run in r["runs"] for w in range(run["first"], run["end"])}),
            sorted({run["item_id"] for run in r["runs"]}),
        )
        for i, r in rows.items()
    }


@pytest.mark.parametrize("part,most", [(500_000, 1_000_000), (40, 1_000_000), (500_000, 0)])
def test_against_all_windows(spark, monkeypatch, part, most):
    monkeypatch.setattr(winnowing, "BROADCAST_WORDS", part)
    rng = random.Random(part)
    letters = ["a", "B", "c!", "é,", "d\n", "0"]

    def text(n):
        return " ".join(rng.choice(letters) for _ in range(n))

    items = [(i, text(rng.randint(0, 25))) for i in range(20)] + [(3, text(12)), (99, None), (98, "...")]
    texts = [text(rng.randint(0, 80)) for _ in range(40)] + [None, "", "!!", text(3000)]
    texts += ["x " + items[k][1].upper() + " y" for k in range(20)]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = measured(docs(spark, texts), table, most_broadcast=most)
    assert got == {i: brute(t, items) for i, t in enumerate(texts)}


def test_every_long_span_has_a_shared_fingerprint():
    rng = random.Random(1)
    for _ in range(200):
        span = [str(rng.randint(0, 30)) for _ in range(winnowing.WINDOW)]
        left = [str(rng.randint(0, 30)) for _ in range(rng.randint(0, 20))]
        right = [str(rng.randint(0, 30)) for _ in range(rng.randint(0, 20))]
        a, b = (
            winnowing.fingerprints(Words(*text_bytes(pa.array([" ".join(t)]))))[0]
            for t in (left + span, span + right)
        )
        assert np.intersect1d(a, b).size


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_drop_contaminated(spark, most):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    frame = docs(spark, ["clean", "x ONE, two three four five six seven eight nine ten!", None, "clean"], [0, 1, 2, 0])
    kept = winnowing.drop_contaminated(frame, items, most_broadcast=most)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 0, 2]
    none = spark.createDataFrame([], "item_id long, text string")
    assert winnowing.drop_contaminated(frame, none, most_broadcast=most).count() == 4
    assert winnowing.shared_runs(empty(spark), items, most_broadcast=most).count() == 0


def words_of(text):
    return Words(*text_bytes(pa.array([text])))


def test_repeated_words_take_linear_time():
    for count in (8_000, 40_000):
        known = winnowing.Items([1, 2], ["x " * (count // 2), "y"])
        start = time.perf_counter()
        (runs,) = known.runs(words_of("x " * count))
        assert time.perf_counter() - start < count / 8_000
        assert runs == [(0, count, 0)]


def test_a_collision_beside_a_shared_run_keeps_the_run():
    """A word whose hash equals another's ends a run and does not undo it."""
    shared = [f"w{i}" for i in range(14)]
    own, theirs = words_of(" ".join([*shared, "left", "end"])), " ".join([*shared, "right", "end"])
    known = winnowing.Items([7], [theirs])
    known.words.hash[14] = own.hash[14]
    known.windows[10] = winnowing.grams_at(known.words.hash, np.arange(7), 10), np.arange(7)
    order = np.argsort(known.windows[10][0])
    known.windows[10] = tuple(x[order] for x in known.windows[10])
    assert known.runs(own) == [[(0, 14, 0)]]
