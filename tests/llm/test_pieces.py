import hashlib
import random

import numpy as np
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from clusterprep.llm import pieces, queries
from clusterprep.llm.tokens import default_path
from tests.llm.frames import by_id, docs, empty

PATH = default_path(queries.PIECES)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)

AWKWARD = [
    None, "", " ", "  ", " " * 40, "a", " a", "a ", "a  b   c    ", "▁", "▁a▁ ▁b ", "\t\n\r\x00\x1f",
    "x y　z​", "\U0001f600\U0001f469‍\U0001f4bb \U0001f600", "ﬁ ａ", "é é", "<s> </s> <unk> <0x41>", "1234567890 3.14",
    "Don't stop", "שלום 你好世界 नमस्ते", "a" * 3000, "你" * 500, "▁" * 100 + "x",
]


def mixed(seed, count=200):
    rng = random.Random(seed)
    signs = "  ▁\n\t.,;abcdeABC019éß你\U0001f600́​'-"
    return ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(count)]


def test_ids_and_texts_equal_the_library(spark):
    texts = AWKWARD + mixed(1)
    encoded = pieces.encode_pieces(docs(spark, texts), PATH)
    found = by_id(pieces.decode_pieces(encoded, PATH), "ids", "text")
    for i, text in enumerate(texts):
        ids = LIBRARY.encode(text or "")
        assert found[i] == (ids, LIBRARY.decode(ids)), text
    both = pieces.encode_pieces(docs(spark, texts), PATH, decoded=True)
    assert by_id(both, "ids", "text") == found


def test_whole_table(spark, sf_dir):
    found = by_id(queries.op13_sentencepiece(spark, sf_dir))
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for row in rows:
        ids = LIBRARY.encode(row["text"] or "")
        assert found[row["doc_id"]] == {
            "doc_id": row["doc_id"],
            "n_tokens": len(ids),
            "ids_sha256": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest(),
        }


def test_generations_keep_chunks_in_use(monkeypatch):
    monkeypatch.setattr(pieces, "CHUNKS", 4)
    encoder = pieces.PieceEncoder(PATH)
    asked = []
    library = encoder.library

    class Counted:
        def encode(self, texts, **options):
            asked.extend(texts)
            return library.encode(texts, **options)

    encoder.library = Counted()
    for n in range(40):
        text = f"often w{n} v{n} u{n}"
        (ids,) = encoder.encode([text])
        assert ids.tolist() == LIBRARY.encode(text)
        assert len(encoder._young) <= 8 and len(encoder._old) <= 8
    assert asked.count("often") == 1 and asked.count("w7") == 1


def test_models_whose_pieces_may_cross():
    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        model.ParseFromString(file.read())
    assert pieces.separable(model)
    model.pieces[500].piece = "▁of▁the"
    assert not pieces.separable(model)
    model.pieces[500].piece = "x"
    model.pieces[500].type = 4
    assert not pieces.separable(model)
    model.pieces[500].type = 1
    model.normalizer_spec.remove_extra_whitespaces = True
    assert not pieces.separable(model)


def test_a_model_with_crossing_pieces_gets_whole_texts(tmp_path):
    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        model.ParseFromString(file.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(model.SerializeToString())
    encoder = pieces.PieceEncoder(str(path))
    texts = [t or "" for t in AWKWARD]
    assert [i.tolist() for i in encoder.encode(texts)] == encoder.library.encode(texts)


def test_long_chunks_and_texts(spark):
    texts = ["ab" * 100_000, "word " * 100_000, " " * 200_000]
    found = by_id(pieces.encode_pieces(docs(spark, texts), PATH), "ids")
    for i, text in enumerate(texts):
        assert np.array_equal(found[i][0], LIBRARY.encode(text))


def test_empty_table_and_repeated_rows(spark):
    assert pieces.decode_pieces(pieces.encode_pieces(empty(spark), PATH), PATH).collect() == []
    rows = pieces.encode_pieces(docs(spark, ["a b", "a b", None], ids=[1, 1, None]), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["ids"]) for r in rows) == [(0, []), *[(1, LIBRARY.encode("a b"))] * 2]
