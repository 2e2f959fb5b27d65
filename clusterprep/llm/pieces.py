"""SentencePiece encoding and decoding, by a table of distinct chunks.

A piece that holds a white-space mark anywhere but at its start could cross
from one word to the next. Where a vocabulary has no such piece, no merge
crosses the start of a run of marks either: a text's ids are the ids of its
chunks, one after the other, where a chunk is a run of marks and the signs that
follow it. So each distinct chunk is segmented once, by the sentencepiece
library, and the ids of all chunks are joined back by their places in the text.

The table belongs to a Python worker, which shares nothing with others: texts
are neither shuffled nor exploded into words, and a lost task only fills its
table again. It keeps two generations of at most `CHUNKS` chunks and `CHARS`
characters; chunks in use move to the younger one, so that frequent words stay
while rare ones go, and memory does not grow with the corpus.

`separable` tells from the model file whether chunks can be told apart: it asks
for merges (BPE) without normalisation, marks written before words, no piece
that a user defined, and no mark inside a piece. Other models are given
whole texts; their results are the library's as well.

A null text is empty and has no ids; no ids decode to an empty text. Texts may be of any
length. Rows are treated one by one: repeated rows give repeated results, null
ids stay, and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from clusterprep.llm.arrays import slabs
from clusterprep.llm.rows import map_arrow, picked

MARK = "▁"  # fixed value: the sign that stands for a space
CHUNKS = 100_000
CHARS = 4_000_000
DECODED = 1 << 20  # ids decoded together
_CHUNK = re.compile(f"[ {MARK}]+[^ {MARK}]*")
_BPE, _USER_DEFINED = 2, 4  # fixed values of the file format

_loaded: dict[str, PieceEncoder] = {}


def piece_encoder(path: str) -> PieceEncoder:
    """The encoder of a model file, loaded once by a worker."""
    if path not in _loaded:
        _loaded[path] = PieceEncoder(path)
    return _loaded[path]


def separable(model: sentencepiece_model_pb2.ModelProto) -> bool:
    """Whether the ids of a text are those of its chunks, one after the other."""
    rules, trainer = model.normalizer_spec, model.trainer_spec
    return (
        not rules.precompiled_charsmap
        and rules.add_dummy_prefix
        and rules.escape_whitespaces
        and not rules.remove_extra_whitespaces
        and not trainer.treat_whitespace_as_suffix
        and trainer.model_type == _BPE
        and any(p.piece == MARK for p in model.pieces)
        and not any(p.type == _USER_DEFINED or MARK in p.piece.lstrip(MARK) for p in model.pieces)
    )


class PieceEncoder:
    """Ids of texts, equal to the library's on the same file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            content = file.read()
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(content)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.separable = separable(model)
        self._mark = np.array([self.library.piece_to_id(MARK)], np.int32).tobytes()
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._chars = 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.separable:
            return [np.array(ids, np.int32) for ids in self.library.encode(texts, num_threads=1)]
        # The library writes a mark before every text that is not empty.
        chunks = [_CHUNK.findall(" " + text) if text else [] for text in texts]
        self._look_up(set().union(*chunks))
        known = self._young.__getitem__
        ids = [np.frombuffer(b"".join(map(known, c)), np.int32) for c in chunks]
        if len(self._young) > CHUNKS or self._chars > CHARS:
            self._old, self._young, self._chars = self._young, {}, 0
        return ids

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1)

    def _look_up(self, chunks: set[str]) -> None:
        """Put all of these chunks into the younger generation."""
        missing = chunks.difference(self._young)
        self._chars += sum(map(len, missing))
        kept = self._old.keys() & missing
        self._young.update(zip(kept, map(self._old.__getitem__, kept)))
        new = list(missing - kept)
        # The first mark of a chunk is the one that the library adds.
        ids = self.library.encode([chunk[1:] for chunk in new], num_threads=1)
        raw = np.fromiter(chain.from_iterable(ids), np.int32).tobytes()
        at = 0
        for chunk, size in zip(new, map(len, ids)):
            self._young[chunk] = raw[at : at + 4 * size] if len(chunk) > 1 else self._mark
            at += 4 * size


def encode_pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """One row per row of `docs`: doc_id, ids (array of int).

    With `decoded` also text, which the ids stand for: the same as `decode_pieces`
    of the result, without another way of all ids to the workers.
    """

    def run(batches):
        encoder = piece_encoder(path)
        for slab in slabs(batches, "text"):
            texts = [text or "" for text in slab.column("text").to_pylist()]
            ids = encoder.encode(texts)
            ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
            columns, names = [slab.column("doc_id"), lists], ["doc_id", "ids"]
            if decoded:
                columns.append(pa.array(encoder.decode([i.tolist() for i in ids]), pa.string()))
                names.append("text")
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = picked(docs, doc_id=id_col, text=text_col)
    fields = [rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField("text", T.StringType()))
    return map_arrow(rows, run, T.StructType(fields))


def decode_pieces(
    encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """One row per row of `encoded`: doc_id, ids and the text that they stand for.

    The library turns marks into spaces, takes away the one it adds before a
    text, and reads runs of byte pieces as UTF-8. Null ids are no ids; ids
    outside the vocabulary are an error.
    """

    def run(batches):
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                size = max(1, _rows_of(batch.column("ids").slice(at)))
                part = batch.slice(at, size)
                ids = [i or [] for i in part.column("ids").to_pylist()]
                texts = pa.array(piece_encoder(path).decode(ids), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], ["doc_id", "ids", "text"])
                at += size

    rows = picked(encoded, doc_id=id_col, ids=ids_col)
    text = T.StructField("text", T.StringType())
    return map_arrow(rows, run, T.StructType([*rows.schema.fields, text]))


def _rows_of(lists: pa.ListArray) -> int:
    """How many lists, from the first on, hold at most `DECODED` values together."""
    ends = np.asarray(lists.offsets)
    return int(np.searchsorted(ends, ends[0] + DECODED, side="right")) - 1
