"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased and every other character is a break between words;
runs of 1 to 3 letters, with the break before and after a word, are hashed
into `BUCKETS` buckets. Training counts them per language in Spark; the matrix
of log-probabilities (languages x buckets) is broadcast; a batch of texts is
scored as a sparse matrix of its n-grams, one gather and one sum per language.

It learns from a sample of at most about `rows_per_language` labelled texts of
each language, chosen by a hash of the id, and reads those texts whole. A text
that is null or has no letter is `und` with score 0; without any training text
everything is. Ties go to the first language by name. Repeated rows get equal
results; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterprep.llm.arrays import slabs
from clusterprep.llm.rows import map_arrow, picked

BUCKETS = 1 << 15
ROWS_PER_LANGUAGE = 2000
SMOOTHING = 0.5
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Whether each code point is a letter; built once per worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def gram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text number of every n-gram, by text, and whether texts have a letter."""
    joined = "\n".join(text.lower() for text in texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((len(text.lower()) for text in texts), np.int64, len(texts))
    ends = np.cumsum(lengths + 1)
    letter = _letter_table()[points]
    points = np.where(letter, points, np.uint32(0))
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # one break after each word
    of = np.repeat(np.arange(len(texts)), lengths + 1)[keep]
    points = points[keep].astype(np.uint32)
    found = np.zeros(len(texts), bool)
    found[of[points != 0]] = True

    before = np.empty_like(points)
    before[0], before[1:] = 0, points[:-1]
    after = np.empty_like(points)
    after[-1], after[:-1] = 0, points[1:]
    here = points * np.uint32(0x9E3779B1)
    left = before * np.uint32(0x85EBCA6B) + np.uint32(1)
    right = after * np.uint32(0xC2B2AE35) + np.uint32(2)
    middle = points != 0
    kinds = [here, here ^ left, (here ^ left) * np.uint32(0x27D4EB2F) + right]
    buckets = np.stack([_bucket(kind[middle]) for kind in kinds], axis=1).ravel()
    return buckets, np.repeat(of[middle], len(kinds)), found


def _bucket(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint32(15))
    values = values * np.uint32(0x2C1B3C6D)
    values ^= values >> np.uint32(13)
    return (values & np.uint32(BUCKETS - 1)).astype(np.int32)


@dataclass(frozen=True)
class LanguageModel:
    """Languages by name, and the log-probability of each bucket in each of them."""

    languages: list[str]
    log_prior: np.ndarray
    log_likelihood: np.ndarray

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Most likely language of each text and its probability."""
        buckets, of, found = gram_buckets(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        first = np.searchsorted(of, np.arange(len(texts)))
        totals = np.zeros((len(texts), len(self.languages)))
        if len(of):
            filled = first[found]
            for k, row in enumerate(self.log_likelihood):
                totals[found, k] = np.add.reduceat(row[buckets], filled, dtype=np.float64)
        totals += self.log_prior
        best = totals.argmax(axis=1)
        chance = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
        names = [self.languages[b] if f else UNKNOWN for b, f in zip(best, found)]
        return names, np.where(found, chance, 0.0)


def fit_language_model(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    key_col: str = "doc_id",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> LanguageModel:
    """Learn from labelled rows; those without text, language or key are left out."""
    rows = picked(labelled, text=text_col, lang=lang_col, key=key_col).dropna()
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    shares = rows.sparkSession.createDataFrame(
        [(name, min(1.0, rows_per_language / sizes[name])) for name in languages],
        "lang string, share double",
    )
    rank = F.shiftrightunsigned(F.xxhash64(F.lit(9).cast("long"), "key"), 11) / F.lit(float(2**53))
    sample = rows.join(F.broadcast(shares), "lang").filter(rank < F.col("share")).select("lang", "text")

    def count(batches):
        counts = np.zeros((len(languages), BUCKETS), np.int64)
        for slab in slabs(batches, "text"):
            buckets, of, _ = gram_buckets(slab.column("text").to_pylist())
            number = {name: i for i, name in enumerate(languages)}
            lang = np.array([number[name] for name in slab.column("lang").to_pylist()], np.int64)
            cells = lang[of] * BUCKETS + buckets
            counts += np.bincount(cells, minlength=counts.size).reshape(counts.shape)
        k, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k), pa.array(bucket), pa.array(counts[k, bucket])], ["k", "bucket", "n"]
        )

    # At most languages x BUCKETS cells.
    cells = (
        map_arrow(sample, count, "k long, bucket long, n long")
        .groupBy("k", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    counts[cells["k"].to_numpy(), cells["bucket"].to_numpy()] += cells["n"].to_numpy()
    likelihood = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    prior = np.log(np.array([sizes[name] for name in languages], float) / max(1, sum(sizes.values())))
    return LanguageModel(languages, prior, likelihood.astype(np.float32))


def identify_language(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, lang_pred, score."""
    rows = picked(docs, doc_id=id_col, text=text_col)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for slab in slabs(batches, "text"):
            texts = [text or "" for text in slab.column("text").to_pylist()]
            names, chances = shared.value.score(texts)
            yield pa.RecordBatch.from_arrays(
                [slab.column("doc_id"), pa.array(names, pa.string()), pa.array(chances)],
                ["doc_id", "lang_pred", "score"],
            )

    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return map_arrow(rows, run, schema)
