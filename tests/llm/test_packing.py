import random
import tracemalloc
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from clusterprep.llm import grouping, packing, tokens
from clusterprep.llm.token_pieces import cut
from tests.llm.frames import docs, empty

WORDS = tokens.default_path("word_bpe_49k.json")
RANKS = tokens.default_path("byte_bpe_50k.tiktoken")
TEXTS = [None, "", "One two.", "<|endoftext|> it's", "\x1c a", "ΣΑΣ İß ﬁ", "é" * 30, "x" * 3000, "a b c " * 3000]


def plain_ids(text):
    return Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids


def test_word_ids_are_those_of_the_library():
    rng = random.Random(1)
    letters = "abcZYéÉßİΣσ'ſstreveml lld0123_.,!?-<|endoftext|> \n\t\x1c\x85\xa0​́한😀ǅŉ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += [t or "" for t in TEXTS]
    encoder = tokens.WordEncoder(WORDS)
    encoder.CACHED = 500
    library = Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)
    for start in range(0, len(texts), 100):
        got = encoder.encode(texts[start : start + 100])
        assert [ids.tolist() for ids in got] == [e.ids for e in library[start : start + 100]]


def test_each_different_word_is_merged_once():
    words = [f"{a}{b}{c}" for a in "abcdefgh" for b in "eiou" for c in "nrst"]
    texts = [" ".join(words[n:] + words[:n]) for n in range(50)]
    encoder = tokens.WordEncoder(WORDS)
    merges, given = encoder._merges, []

    class Counted:
        def encode_to_numpy(self, text, **options):
            given.append(text)
            return merges.encode_to_numpy(text, **options)

    encoder._merges = Counted()
    got = encoder.encode(texts)
    assert sum(text.count(encoder._END) for text in given) == len(words)
    assert [ids.tolist() for ids in got] == [plain_ids(text) for text in texts]


@pytest.mark.parametrize("together", [1, 3, 1000])
def test_chunks_looked_up_in_runs(together):
    texts = [t or "" for t in TEXTS] + ["a b, a", "", " ", "it's b, c! Été été, \x1f"]
    encoder = tokens.WordEncoder(WORDS)
    encoder.TOGETHER = together
    assert [ids.tolist() for ids in encoder.encode(texts)] == [plain_ids(text) for text in texts]
    assert encoder.encode([]) == [] and [len(ids) for ids in encoder.encode([""])] == [0]


def test_cut():
    assert cut(5, 2) == [(0, 2), (2, 2), (4, 1)] and cut(4, 2) == [(0, 2), (2, 2)] and cut(1, 2) == [(0, 1)]


@pytest.mark.parametrize("capacity,block", [(16, 5), (64, 2000)])
def test_every_piece_is_placed_once(spark, monkeypatch, capacity, block):
    monkeypatch.setattr(grouping, "BLOCK", block)
    rng = random.Random(capacity)
    texts = TEXTS + [" ".join("word" for _ in range(rng.randint(0, 40))) for _ in range(120)]
    frame = docs(spark, texts + ["same"] * 40)
    rows = grouping.pack_documents(frame, WORDS, capacity, with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text in enumerate(texts):
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        ids = np.array([*plain_ids(text), 0], "<u4")
        assert b"".join(bytes(p["ids"]) for p in pieces) == ids.tobytes()
        assert [(p["start"], p["length"]) for p in pieces] == cut(len(ids), capacity)
        assert all(p["ids_crc32"] == zlib.crc32(bytes(p["ids"])) for p in pieces)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r["length"] for r in rows) // capacity)
    assert len(by_sequence) <= least * 1.1 + 2


def test_sequences_hold_their_pieces(spark):
    packed = grouping.pack_documents(docs(spark, ["one two", "three", None]), WORDS, 8, with_ids=True)
    rows = grouping.sequences(packed).collect()
    ids = np.concatenate([np.frombuffer(bytes(r["ids"]), "<u4") for r in rows])
    assert sorted(ids.tolist()) == sorted([*plain_ids("one two"), *plain_ids("three"), 0, 0, 0])
    assert sum(len(r["doc_ids"]) for r in rows) == 3


def test_tiny_pieces_end(spark):
    frame = docs(spark, [None] * 300, ids=[1] * 300)
    rows = grouping.pack_documents(frame, WORDS, 64).collect()
    assert len(rows) == 300 and len({r["sequence_id"] for r in rows}) == 5


def test_packing_of_nothing(spark):
    assert grouping.pack_documents(empty(spark), WORDS).count() == 0
    assert packing.pack(empty(spark), RANKS).count() == 0


def test_evolution_beats_or_equals_the_first_packing():
    rng = random.Random(3)
    for seed in range(5):
        lengths = [rng.randint(200, 900) for _ in range(120)]
        population = [grouping.first_packing(lengths, 1000, rng, 0.1 * n) for n in range(4)]
        first = min(len(p.bins) for p in population)
        best = grouping.evolve(population, lengths, random.Random(seed), 40)[0]
        assert len(best.bins) <= first
        assert sorted(i for members in best.bins for i in members) == list(range(120))
        assert [1000 - sum(lengths[i] for i in m) for m in best.bins] == best.room
        again = grouping.Packing.from_numbers(best.as_numbers(120), lengths, 1000)
        assert again.cost() == best.cost()


def test_capacity_tree_against_a_scan():
    rng = random.Random(2)
    tree, count = packing.CapacityTree(20), [0] * 21
    for _ in range(4000):
        room = rng.randint(0, 20)
        change = -1 if count[room] and rng.random() < 0.6 else 1
        tree.add(room, change)
        count[room] += change
        need = rng.randint(0, 20)
        assert tree.at_least(need) == next((r for r in range(need, 21) if count[r]), None)


@pytest.mark.parametrize("buffer", [50, 1 << 20])
def test_matrices_round_trip(spark, monkeypatch, tmp_path, buffer):
    monkeypatch.setattr(packing, "BUFFER", buffer)
    texts = TEXTS + [f"text number {i} " * (i % 9) for i in range(80)]
    frame = docs(spark, texts, partitions=2)
    path = str(tmp_path / "packed")
    packing.write_matrices(packing.pack(frame, RANKS, width=64), path)
    packed = spark.read.parquet(path)
    encoder = tokens.byte_encoder(RANKS)
    pieces = sorted((r["doc_id"], r["piece"], bytes(r["ids"])) for r in packing.unpacked(packed).collect())
    found = {}
    for i, _, ids in pieces:
        found[i] = found.get(i, b"") + ids
    for i, text in enumerate(texts):
        ids = np.frombuffer(found[i], "<u2")
        assert ids[-1] == encoder.free_id and encoder.decode(ids[:-1]) == (text or "").encode()
    rows = packed.collect()
    ids = packing.matrix([bytes(r["ids"]) for r in rows], 64)
    places = packing.matrix([bytes(r["position_ids"]) for r in rows], 64)
    assert ids.shape == places.shape == (len(rows), 64)
    for row, line in zip(rows, places):
        ends = row["cu_seqlens"]
        assert ends[0] == 0 and ends[-1] == row["n_tokens"] <= 64
        expected = np.concatenate([np.arange(b - a) for a, b in zip(ends, ends[1:])])
        assert line[: row["n_tokens"]].tolist() == expected.tolist()
    assert len({r["sequence_id"] for r in rows}) == len(rows)


def optimum(lengths, capacity):
    """The least number of sequences, by trying every place for every piece."""
    best = [len(lengths)]
    ordered = sorted(lengths, reverse=True)

    def place(n, rooms):
        if len(rooms) >= best[0]:
            return
        if n == len(ordered):
            best[0] = len(rooms)
            return
        for i in {room: i for i, room in enumerate(rooms) if room >= ordered[n]}.values():
            rooms[i] -= ordered[n]
            place(n + 1, rooms)
            rooms[i] += ordered[n]
        rooms.append(capacity - ordered[n])
        place(n + 1, rooms)
        rooms.pop()

    place(0, [])
    return best[0]


def test_small_packings_are_best_possible(spark):
    rng = random.Random(12)
    found, least = 0, 0
    for case in range(6):
        lengths = [rng.randint(3, 18) for _ in range(11)]
        schema = "key long, doc_id long, piece int, start long, length long, ids_crc32 long"
        rows = [(n, n, 0, 0, length, 0) for n, length in enumerate(lengths)]
        packed = grouping.pack_pieces(spark.createDataFrame(rows, schema), 20).collect()
        found += len({r["sequence_id"] for r in packed})
        least += optimum(lengths, 20)
    assert found == least


def test_placement_is_plain_best_fit():
    """Each piece goes to the fullest open sequence that has room for it."""
    rng = random.Random(13)
    for _ in range(200):
        packer, rooms, width = packing.Packer(30), [], 30
        for n in range(40):
            need = rng.randint(1, 30)
            packer.place((n, np.zeros(need, np.uint16)))
            fitting = [room for room in rooms if room >= need]
            if fitting:
                rooms[rooms.index(min(fitting))] -= need
            else:
                rooms.append(width - need)
            open_ = sorted(room for room, some in packer.by_room.items() for _ in some)
            assert open_ == sorted(rooms)


def test_few_chunks_are_held_as_strings():
    words = [f"word{n}" for n in range(500)]
    text = " ".join(words * 40)
    encoder = tokens.WordEncoder(WORDS)
    encoder.encode([text])
    expected = plain_ids(text)
    tracemalloc.start()
    try:
        got = encoder.encode(text for _ in range(20))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [ids.tolist() for ids in got] == [expected] * 20
    chunks = 20 * len(words) * 40
    assert most < sum(ids.nbytes for ids in got) * 2 + 24 * chunks
