"""Quality: nearest-neighbour voting among labelled texts in a latent-semantic space.

A text is the counts of its hashed byte trigrams, damped by log(1 + n),
weighted by inverse document frequency and scaled to length 1, next to a few
shares that trigrams miss (`SHARES`: words that repeat the word before them,
punctuation, upper case). The rows are projected on the leading singular
vectors of the labelled sample and scaled to length 1 again. The labelled vectors
are broadcast; each batch of texts takes its exact cosines with all of them,
one block of references at a time, keeps the `NEIGHBOURS` largest, and lets
them vote with their similarity as weight.

It learns from at most `rows_per_label` labelled texts of each label (chosen by
a hash of the id), so the two labels weigh the same; their texts are read
whole. The share of label 1 among all learned labels joins the vote with the weight
`PRIOR_WEIGHT`, so that a text similar to no reference, like an empty one, has
about that share as its score (0.5 if there are no labels). Labels that are
null and texts without a label are left out; a null text is empty.
Ties between neighbours go to the earlier reference. Repeated rows get equal
scores; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterprep.llm.arrays import LOWER, WORD_BYTE, Words, mix, slabs, text_bytes
from clusterprep.llm.rows import map_arrow, picked, plain_name

FEATURES = 2048
DIMENSIONS = 64
ROWS_PER_LABEL = 1500
NEIGHBOURS = 25
SHARPNESS = 8  # a vote's weight is the cosine to this power
PRIOR_WEIGHT = 0.05
SHARES = (2.0, 4.0, 2.0)  # weights of the shares
SHORT_WORDS, SHORT_BYTES = 8, 60  # added to the lengths, so that short texts have small shares
BLOCK = 1024  # references multiplied at a time
_TEXTS = 128  # texts in a dense block of counts


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed byte trigrams, one row per text."""
    texts = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((texts, FEATURES), np.float32)
    values = data.astype(np.uint32)
    grams = (values[:-2] << np.uint32(16)) | (values[1:-1] << np.uint32(8)) | values[2:]
    grams *= np.uint32(0x9E3779B1)
    grams ^= grams >> np.uint32(15)
    grams *= np.uint32(0x85EBCA6B)
    cells = (grams >> np.uint32(32 - FEATURES.bit_length() + 1)).astype(np.int64)
    of = np.repeat(np.arange(texts), np.diff(offsets))
    inside = of[:-2] == of[2:]
    cells = cells[inside] + of[:-2][inside] * FEATURES
    return np.bincount(cells, minlength=texts * FEATURES).reshape(texts, FEATURES).astype(np.float32)


def text_shares(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Share of repeated words, of punctuation and of upper-case letters, by text."""
    texts = len(offsets) - 1
    words = Words(data, offsets)
    counts = np.diff(words.of)
    word_of = np.repeat(np.arange(texts), counts)
    again = np.zeros(len(words.hash), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (word_of[1:] == word_of[:-1])
    byte_of = np.repeat(np.arange(texts), np.diff(offsets))
    punctuation = (data > 32) & ~WORD_BYTE[LOWER[data]]
    length = np.diff(offsets) + SHORT_BYTES
    return np.stack(
        [
            np.bincount(word_of[again], minlength=texts) / (counts + SHORT_WORDS),
            np.bincount(byte_of[punctuation], minlength=texts) / length,
            np.bincount(byte_of[LOWER[data] != data], minlength=texts) / length,
        ],
        axis=1,
    ).astype(np.float32)


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Damped trigram counts and shares, one row per text."""
    return np.hstack([np.log1p(gram_counts(data, offsets)), text_shares(data, offsets)])


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(length > 0, length, 1)


def weighted(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted counts at length 1, and weighted shares."""
    return np.hstack(
        [_unit(features[:, :FEATURES] * weights), features[:, FEATURES:] * np.float32(SHARES)]
    )


def nearest(cosines: np.ndarray, count: int) -> np.ndarray:
    """Columns of the `count` largest values of each row, in their order; the earlier of equal ones."""
    least = np.partition(cosines, -count, axis=1)[:, -count][:, None]
    chosen = cosines >= least
    for row in np.flatnonzero(chosen.sum(axis=1) > count):
        equal = np.flatnonzero(cosines[row] == least[row])
        chosen[row, equal[count - int((cosines[row] > least[row]).sum()) :]] = False
    return np.nonzero(chosen)[1].reshape(len(cosines), count)


@dataclass(frozen=True)
class QualityModel:
    """Feature weights, projection (features x dimensions), reference vectors, labels, prior."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def embed(self, features: np.ndarray) -> np.ndarray:
        return _unit(weighted(features, self.weights) @ self.projection)

    def vote(self, vectors: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest references, weighted by similarity."""
        best = np.zeros((len(vectors), 0), np.float32)
        mark = np.zeros((len(vectors), 0), np.float32)
        for start in range(0, len(self.vectors), BLOCK):
            cosines = vectors @ self.vectors[start : start + BLOCK].T
            labels = np.broadcast_to(self.labels[start : start + BLOCK], cosines.shape)
            best = np.concatenate([best, cosines], axis=1)
            mark = np.concatenate([mark, labels], axis=1)
            if best.shape[1] > NEIGHBOURS:
                top = nearest(best, NEIGHBOURS)
                best = np.take_along_axis(best, top, axis=1)
                mark = np.take_along_axis(mark, top, axis=1)
        weight = np.clip(best, 0, 1).astype(np.float64) ** SHARPNESS
        votes = (weight * mark).sum(axis=1) + PRIOR_WEIGHT * self.prior
        return votes / (weight.sum(axis=1) + PRIOR_WEIGHT)


def fit_quality_model(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows_per_label: int = ROWS_PER_LABEL,
) -> QualityModel:
    """Learn from the texts that `labels` (id, 0 or 1) marks.

    An id that several label rows mark takes the largest label; an id that
    several documents share takes the largest text.
    """
    marks = picked(labels, key=id_col, label=label_col).dropna().groupBy("key").agg(F.max("label").alias("label"))
    shares = marks.agg(F.avg("label")).first()[0]
    prior = 0.5 if shares is None else float(shares)
    rank = F.xxhash64(F.lit(1).cast("long"), "key")
    chosen = [
        marks.filter(F.col("label") == value).orderBy(rank, "key").limit(rows_per_label)
        for value in (0, 1)
    ]
    chosen = chosen[0].unionAll(chosen[1])
    texts = picked(docs, key=id_col, text=text_col).join(F.broadcast(chosen), "key")
    texts = texts.groupBy("key", "label").agg(F.max("text").alias("text"))

    def count(batches):
        for slab in slabs(batches, "text"):
            features = text_features(*text_bytes(slab.column("text"))).astype(np.float16)
            rows = [row.tobytes() for row in features]
            yield pa.RecordBatch.from_arrays(
                [slab.column("key"), slab.column("label"), pa.array(rows, pa.binary())],
                ["key", "label", "features"],
            )

    schema = T.StructType(
        [texts.schema["key"], texts.schema["label"], T.StructField("features", T.BinaryType())]
    )
    # At most 2 x rows_per_label rows of 2 x FEATURES bytes.
    sample = map_arrow(texts, count, schema).orderBy("key").toArrow()
    if not sample.num_rows:
        return QualityModel(
            np.ones(FEATURES, np.float32),
            np.zeros((FEATURES + len(SHARES), 1), np.float32),
            np.zeros((0, 1), np.float32),
            np.zeros(0, np.float32),
            prior,
        )
    features = np.stack([np.frombuffer(row, np.float16) for row in sample["features"].to_pylist()])
    features = features.astype(np.float32)
    found = (features[:, :FEATURES] > 0).sum(axis=0)
    weights = np.log((1 + len(features)) / (1 + found)).astype(np.float32) + 1
    rows = weighted(features, weights)
    projection = singular_vectors(rows, min(DIMENSIONS, *rows.shape))
    labels_ = sample["label"].to_numpy().astype(np.float32)
    return QualityModel(weights, projection, _unit(rows @ projection), labels_, prior)


def singular_vectors(rows: np.ndarray, count: int) -> np.ndarray:
    """Leading right singular vectors, as columns, by subspace iteration from a fixed start."""
    start = mix(np.arange(rows.shape[1] * count, dtype=np.uint64) + np.uint64(1))
    basis = (start >> np.uint64(40)).astype(np.float32).reshape(-1, count) / 2**23 - 1
    for _ in range(8):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    return np.ascontiguousarray(basis, np.float32)


def score_quality(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id and its score, the likelihood of label 1."""
    rows = picked(docs, doc_id=id_col, text=text_col)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def scored(batch, scores):
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], schema.names)

    return _scored(rows, model, schema, scored)


def keep_quality(
    docs: DataFrame, model: QualityModel, threshold: float, text_col: str = "text"
) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores at least `threshold`."""

    def kept(batch, scores):
        return batch.filter(pa.array(scores >= threshold))

    return _scored(docs, model, docs.schema, kept, text_col)


def _scored(rows: DataFrame, model: QualityModel, schema: T.StructType, result, text_col="text") -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)
    text_col = plain_name(text_col)

    def run(batches):
        for slab in slabs(batches, text_col):
            for start in range(0, slab.num_rows, _TEXTS):
                batch = slab.slice(start, _TEXTS)
                features = text_features(*text_bytes(batch.column(text_col)))
                scores = shared.value.vote(shared.value.embed(features))
                yield result(batch, scores)

    return map_arrow(rows, run, schema)
