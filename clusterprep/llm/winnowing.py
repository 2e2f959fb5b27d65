"""Benchmark decontamination by winnowed fingerprints.

Words are runs of digits, letters and non-ASCII characters, lower case. Of the
hashes of every `K` consecutive words, the smallest of each `WINDOW - K + 1`
neighbours is kept; so any span of `WINDOW` words that a document shares with
an item has a fingerprint that both sides keep. Documents' fingerprints are
joined with the items'; each hit is extended in both directions, to every window
of `WINDOW` words around it that an item has (by hash, then by the words' bytes),
and windows of one item that overlap are one run. A window counts once for an
item, however often the item has it, so the work is linear in a document of one
repeated word. An item shorter than `WINDOW` words is a single window of its own
length and is found by all its n-grams of that length.

Items of up to `MOST_BROADCAST` words (counted from above) are broadcast in parts of
about `BROADCAST_WORDS`: the join is a look-up in their sorted fingerprints,
nothing is shuffled, and common passages make no hot task. A larger benchmark
is joined as a table: documents send the fingerprints whose bucket some item
has (one bit each of `BUCKETS`), both sides meet by fingerprint, salted by
document, and the items of each document that they find are checked as above.

Null texts have no words, and a document without words has no hits. An item
without words, or with a null id, is never found. Item ids that repeat count once for a document.
Each document row is treated on its own; an empty table on either side gives
no hits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterprep.llm.arrays import Words, grams, mix, slabs, text_bytes
from clusterprep.llm.bucket_counts import bucket_counts, bucket_of
from clusterprep.llm.rows import map_arrow, picked, plain_name, small, with_row, without
from clusterprep.session import cut_lineage

WINDOW = 10
K = 5
BROADCAST_WORDS = 500_000
MOST_BROADCAST = 1_000_000
BUCKETS = 1 << 22
SALT = 16


def winnow(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the minimum of each `width` neighbouring values, the last of equal ones."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    best = np.arange(len(values) - width + 1)
    least = values[: len(best)].copy()
    for j in range(1, width):
        here = values[j : j + len(best)]
        better = here <= least
        least = np.where(better, here, least)
        best = np.where(better, np.arange(j, j + len(best)), best)
    return best


def fingerprints(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed hashes of all texts of a slab, and their positions among its words."""
    codes = grams(words.hash, K)
    best = winnow(codes, WINDOW - K + 1)
    text = _text_of(words)
    inside = text[: len(best)] == text[WINDOW - 1 :][: len(best)]
    at = np.unique(best[inside])
    return codes[at], at


def _text_of(words: Words) -> np.ndarray:
    return np.repeat(np.arange(len(words.of) - 1), np.diff(words.of))


def grams_at(hashes: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k values from each of the given positions on, as `grams` has it."""
    total = np.zeros(len(starts), np.uint64)
    for j in range(k):
        total *= np.uint64(0xD1342543DE82EF95)
        total += hashes[starts + j]
    return mix(total)


class Items:
    """Benchmark items as one run of words, with their fingerprints and windows in hash order."""

    def __init__(self, ids: list, texts: list[str]):
        self.words = words = Words(*text_bytes(pa.array(texts, pa.string())))
        self.ids = [str(i) for i in ids]
        self.item = _text_of(words)
        self.hash = np.unique(fingerprints(words)[0])
        # Windows by length: their hashes and one place for each item that has them.
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sizes = np.diff(words.of)
        for length in map(int, np.unique(np.minimum(sizes[sizes > 0], WINDOW))):
            if length < WINDOW:
                starts = words.of[:-1][sizes == length]
            else:
                last = len(self.item) - WINDOW + 1
                starts = np.flatnonzero(self.item[:last] == self.item[WINDOW - 1 :])
            codes = grams_at(words.hash, starts, length)
            order = np.lexsort((starts, self.item[starts], codes))
            codes, starts = codes[order], starts[order]
            new = np.ones(len(codes), bool)
            new[1:] = (codes[1:] != codes[:-1]) | (self.item[starts[1:]] != self.item[starts[:-1]])
            self.windows[length] = codes[new], starts[new]

    def runs(self, words: Words) -> list[list[tuple[int, int, int]]]:
        """For each text, the runs (first word, end, item) that it shares with items."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(words.of) - 1)]
        text = _text_of(words)
        for length, (hashes, places) in self.windows.items():
            if length == WINDOW:
                codes, at = fingerprints(words)
                near = at[np.isin(codes, self.hash)][:, None] - np.arange(WINDOW - K + 1)
                starts = np.unique(near[near >= 0])
                starts = starts[starts + WINDOW <= len(text)]
            else:
                starts = np.arange(max(0, len(text) - length + 1))
            starts = starts[text[starts] == text[starts + length - 1]]
            pairs = _matches(grams_at(words.hash, starts, length), starts, hashes, places)
            self._add(found, words, text, length, *pairs)
        return found

    def _add(self, found, words, text, length, starts, places) -> None:
        """Windows that the texts have, with overlapping ones of one item as one run."""
        item = self.item[places]
        by = np.lexsort((starts, item, text[starts]))
        last = None
        for n in by.tolist():
            start, place = int(starts[n]), int(places[n])
            if words.text(start, start + length) != self.words.text(place, place + length):
                continue  # different words of equal hash
            own = int(text[start]), int(item[n])
            first = start - int(words.of[own[0]])
            if last == own and first <= found[own[0]][-1][1]:
                found[own[0]][-1] = (found[own[0]][-1][0], first + length, own[1])
            else:
                found[own[0]].append((first, first + length, own[1]))
            last = own


def _matches(codes, at, hashes, places) -> tuple[np.ndarray, np.ndarray]:
    """Positions and places with equal hashes; `hashes` are sorted."""
    low = np.searchsorted(hashes, codes, "left")
    counts = np.searchsorted(hashes, codes, "right") - low
    ends = np.cumsum(counts)
    inner = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
    return np.repeat(at, counts), places[np.repeat(low, counts) + inner]


def _item_words(items: DataFrame) -> float:
    """At least the number of words: a word and the break after it take two characters."""
    return items.agg(F.coalesce(F.sum(F.length("text") / 2 + 1), F.lit(0.0))).first()[0]


def _code_of(codes: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of long items and the hashes of whole short ones, told apart."""
    return mix(codes ^ np.uint64(length)).view(np.int64)


def _codes(texts: pa.Array, lengths: list[int], whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of the texts' fingerprints and of their n-grams, or whole texts, of some lengths."""
    words = Words(*text_bytes(texts))
    text = _text_of(words)
    codes, at = fingerprints(words)
    where, found = [text[at]], [_code_of(codes, WINDOW)]
    sizes = np.diff(words.of)
    for length in lengths:
        if whole:
            starts = words.of[:-1][sizes == length]
        else:
            starts = np.arange(max(0, len(text) - length + 1))
            starts = starts[text[starts] == text[starts + length - 1]]
        where.append(text[starts])
        found.append(_code_of(grams_at(words.hash, starts, length), length))
    return np.concatenate(where), np.concatenate(found)


def _sent_codes(lengths: list[int], whole: bool, key: str, keep=None):
    """Function for `map_arrow`: the different codes of each row."""

    def run(batches):
        for slab in slabs(batches, "text"):
            text, code = _codes(slab.column("text"), lengths, whole)
            if keep is not None:
                chosen = keep.value[bucket_of(code.view(np.uint64), BUCKETS)]
                text, code = text[chosen], code[chosen]
            both = np.unique(np.stack([text, code]), axis=1) if len(text) else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays(
                [slab.column(key).take(pa.array(both[0])), pa.array(both[1])], [key, "code"]
            )

    return run


def _joined_runs(rows: DataFrame, items: DataFrame) -> DataFrame:
    """row and runs of the (row, text) rows that share windows with (item, text) rows; by joins."""
    items, number = with_row(items)
    items = items.withColumnRenamed(number, "no")
    short = list(range(1, WINDOW))
    seen = bucket_counts(
        items, lambda slab: _codes(slab.column("text"), short, True)[1].view(np.uint64), BUCKETS
    )
    keep = rows.sparkSession.sparkContext.broadcast(seen > 0)
    of_items = cut_lineage(
        map_arrow(items.select("no", "text"), _sent_codes(short, True, "no"), "no long, code long"), "codes"
    )
    of_docs = map_arrow(rows, _sent_codes(short, False, "row", keep), "row long, code long")
    # Each document goes to one salt, each item to all.
    salt = F.pmod("row", F.lit(SALT)).alias("salt")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))).alias("salt")
    met = of_docs.select("*", salt).join(of_items.select("*", salts), ["code", "salt"])
    met = cut_lineage(met.select("row", "no", "salt").distinct(), "met")
    texts = met.join(items.select("no", "item", F.col("text").alias("item_text"), salts), ["no", "salt"])
    texts = texts.select("row", F.col("item").cast("string").alias("item"), "item_text")
    involved = rows.join(small(met.select("row").distinct()), "row", "left_semi")

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        known = Items(right["item"].to_pylist(), right["item_text"].to_pylist())
        words = Words(*text_bytes(left["text"].combine_chunks().cast(pa.string())))
        runs = [_as_rows(known, own) for own in known.runs(words)]
        return pa.table({"row": left["row"], "runs": pa.array(runs, _RUNS)})

    found = involved.groupBy("row").cogroup(texts.groupBy("row")).applyInArrow(check, _FOUND)
    return cut_lineage(found.filter(F.size("runs") > 0), "runs")


def _as_rows(known: Items, runs: list[tuple[int, int, int]]) -> list[dict]:
    return [{"first": first, "end": end, "item_id": known.ids[item]} for first, end, item in runs]


def _parts(items: DataFrame, size: float) -> list:
    """The items as broadcast parts."""
    count = int(size // BROADCAST_WORDS) + 1
    context = items.sparkSession.sparkContext
    shared = []
    for n in range(count):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == n).toArrow()
        shared.append(context.broadcast(Items(part["item"].to_pylist(), part["text"].to_pylist())))
    return shared


_RUN = T.StructType(
    [
        T.StructField("first", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("item_id", T.StringType()),
    ]
)
_FOUND = T.StructType([T.StructField("row", T.LongType()), T.StructField("runs", T.ArrayType(_RUN))])
_RUNS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("item_id", pa.string())]))


def shared_runs(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """One row per document row: doc_id, n_words and the runs it shares with items.

    A run has its first word, its end (exclusive) and the item's id as text.
    """
    rows = picked(docs, doc_id=id_col, text=text_col)
    items = picked(items, item=item_col, text=item_text_col).dropna()
    size = _item_words(items)
    joined = size > most_broadcast
    if joined:
        rows, _ = with_row(rows.select("doc_id", "text"))
        rows = rows.withColumnRenamed("_row", "row")
    parts = [] if joined else _parts(items, size)
    key = ["row"] if joined else []

    def run(batches):
        for slab in slabs(batches, "text"):
            words = Words(*text_bytes(slab.column("text")))
            runs: list[list[dict]] = [[] for _ in range(slab.num_rows)]
            for part in parts:
                for own, more in zip(runs, part.value.runs(words)):
                    own += _as_rows(part.value, more)
            yield pa.RecordBatch.from_arrays(
                [
                    *[slab.column(name) for name in key],
                    slab.column("doc_id"),
                    pa.array(np.diff(words.of)),
                    pa.array(runs, _RUNS),
                ],
                [*key, "doc_id", "n_words", "runs"],
            )

    schema = T.StructType(
        [
            *[rows.schema[name] for name in key],
            rows.schema["doc_id"],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(_RUN)),
        ]
    )
    found = map_arrow(rows, run, schema)
    if not joined:
        return found
    runs = _joined_runs(rows.select("row", "text"), items).withColumnRenamed("runs", "more")
    return found.join(runs, "row", "left").select("doc_id", "n_words", F.coalesce("more", "runs").alias("runs"))


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """`docs` without the rows that share a window with an item, all columns."""
    items = picked(items, item=item_col, text=item_text_col).dropna()
    size = _item_words(items)
    if size > most_broadcast:
        rows, row = with_row(docs)
        found = _joined_runs(picked(rows, row=row, text=text_col), items)
        return without(rows, row, found.select(F.col("row").alias(row)))
    parts = _parts(items, size)
    text_col = plain_name(text_col)

    def run(batches):
        for slab in slabs(batches, text_col):
            words = Words(*text_bytes(slab.column(text_col)))
            clean = np.ones(slab.num_rows, bool)
            for part in parts:
                clean &= [not runs for runs in part.value.runs(words)]
            yield slab.filter(pa.array(clean))

    return map_arrow(docs, run, docs.schema)
