"""Near-duplicate lines by an exact set-similarity join.

A line's tokens are its different runs of `K` words (all its words as one run,
if it has fewer). Two lines match if the Jaccard similarity of their token sets
is `SIMILARITY` or more; of lines that match, the later one goes, where lines
are in the order of document id, row and line number. Matches are judged on
the input: a line goes if any earlier line matches it. Equal lines match.

Tokens are ordered by rarity (how many lines have them, counted by hash
bucket, then the hash). Of n tokens, lines that match share one among the
first n - ceil(s n) + 1 of the larger line and the first
n - ceil(2 s n / (1 + s)) + 1 of the smaller one (prefix filter); the smaller
has at least s times the larger's tokens (length filter); and what is left
after the places of the shared token must still suffice (positional filter).
What passes is verified on the whole sets, so no match is missed or invented.

Lines of equal words, by 128 bits of hashes, are one node. The words of the
nodes that have a candidate are read from the texts again, by these hashes, so
that the words of all lines are never stored.

Counting by bucket changes only the order, never the result. A token shared by
more than `SMALL` lines' prefixes is compared with the earliest line first;
only lines that don't go by that are compared with further lines, in blocks
that grow by `GROWTH`. So a common line in many variants costs a comparison
each, not the square of their number.

Lines without words (empty lines, rulers of signs) always stay. A null text
has no lines. A null id sorts after all others; repeated rows are in the order
of their rows, so all their lines but the first's go. An empty table gives an
empty result. Texts are split at line feeds and keep all other characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterprep.functions.columns import column
from clusterprep.llm.arrays import Words, grams, mix, powers, slabs, text_bytes
from clusterprep.llm.bucket_counts import bucket_counts, bucket_of
from clusterprep.llm.rows import BROADCAST_ROWS, map_arrow, picked, small, unused, with_row
from clusterprep.session import (
    cut_lineage,
    discard,
    fresh_path,
    read_written,
    release_shuffles,
    write_parts,
)

K = 5
SIMILARITY = 0.8
SMALL = 16
GROWTH = 16
COMMON = 4096  # lines, by bucket, from which on a token's postings are not counted in one task
BUCKETS = 1 << 20  # of the token counts: 4 MB when broadcast
_COMMON = (1 << 16) - 1  # counts from here on are alike
_LINE, _PREFIX, _TEXT = range(3)
_PAIRS = 1024  # verified together


class Lines:
    """Words of a slab's texts by line.

    Lines are numbered through the slab; `counts` has the lines of each text,
    `line_of` the line of each word, `sizes` the words of each line and `of`
    the first one (n + 1 values). `own` are the lines with words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        texts = len(offsets) - 1
        feeds = np.flatnonzero(data == 10)
        self.counts = np.diff(np.searchsorted(feeds, offsets)) + 1
        self.words = words = Words(data, offsets)
        text_of = np.repeat(np.arange(texts), np.diff(words.of))
        # Each text starts a line, and so does the byte after each line feed.
        self.line_of = np.searchsorted(feeds, words.start) + text_of
        self.sizes = np.bincount(self.line_of, minlength=int(self.counts.sum()))
        self.of = np.concatenate([[0], np.cumsum(self.sizes)])
        self.own = np.flatnonzero(self.sizes)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the words, in their order, of each line that has any."""
        hashes, starts = self.words.hash, self.of[self.own]
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.arange(len(hashes)) - np.repeat(starts, self.sizes[self.own])
        count = int(self.sizes.max())
        a = np.add.reduceat(hashes * powers(count)[place], starts)
        b = np.add.reduceat(hashes * powers(count, down=True)[place], starts)
        return a.view(np.int64), b.view(np.int64)


def _tokens(
    hashes: np.ndarray, line_of: np.ndarray, sizes: np.ndarray, of: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Line and token of all runs of words, the whole lines of fewer than `K` words last."""
    codes = grams(hashes, K)
    inside = np.flatnonzero(line_of[: len(codes)] == line_of[K - 1 :][: len(codes)])
    line, token = [line_of[inside]], [codes[inside]]
    for length in range(1, K):
        short = np.flatnonzero(sizes == length)
        if len(short):
            line.append(short)
            token.append(grams(hashes, length)[of[short]])
    return np.concatenate(line), np.concatenate(token)


class LineTokens(Lines):
    """The tokens of the lines too: `line` and `token` list them in text order, repeated ones too."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        super().__init__(data, offsets)
        self.line, self.token = _tokens(self.words.hash, self.line_of, self.sizes, self.of)

    def ordered(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Line and token of the different tokens by line, the rarest first.

        The order is by count (up to `_COMMON`), then by the token itself.
        """
        rare = np.minimum(counts[_bucket(self.token)], _COMMON).astype(np.uint64)
        line = self.line.astype(np.uint64)
        high = self.token >> np.uint64(32)
        if len(self.counts) and int(self.counts.sum()) < 1 << 16:
            # Line, count and the upper half of the token in one number: a fast sort.
            key = (line << np.uint64(48)) | (rare << np.uint64(32)) | high
            by = np.argsort(key)
            key, token = key[by], self.token[by]
            if not ((key[1:] == key[:-1]) & (token[1:] != token[:-1])).any():
                return self._different(by)
        return self._different(np.lexsort((self.token, rare, line)))

    def _different(self, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        line, token = self.line[by], self.token[by]
        new = np.ones(len(by), bool)
        new[1:] = (line[1:] != line[:-1]) | (token[1:] != token[:-1])
        return line[new], token[new]


def _whole(share):
    """The whole number of tokens that a share means, safe from rounding up too far."""
    return np.ceil(share - 1e-9).astype(np.int64)


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return bucket_of(tokens, BUCKETS)


def token_counts(rows: DataFrame) -> np.ndarray:
    """How often lines have a token of each bucket."""
    return bucket_counts(rows, lambda slab: LineTokens(*text_bytes(slab.column("text"))).token, BUCKETS)


def _lines(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """Rows of three kinds: a line with words (without its document), its prefix, and a text.

    A text's size is its lines. Of a prefix, `rare` tokens come before the common ones.
    """
    shared = rows.sparkSession.sparkContext.broadcast(counts)
    names = ["lid", "row", "doc_id", "line", "a", "b", "size", "prefix", "rare", "kind"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        lid = TaskContext.get().partitionId() << 40
        for slab in slabs(batches, "text"):
            found = LineTokens(*text_bytes(slab.column("text")))
            text = np.repeat(np.arange(slab.num_rows), found.counts)
            number = np.arange(len(text)) - np.repeat(np.cumsum(found.counts) - found.counts, found.counts)
            line, token = found.ordered(shared.value)
            begin = np.flatnonzero(np.diff(line, prepend=-1))
            size = np.diff(np.append(begin, len(line)))
            own = found.own  # each has a token
            a, b = found.keys()
            probe = size - _whole(SIMILARITY * size) + 1
            at = np.repeat(begin - (np.cumsum(probe) - probe), probe) + np.arange(probe.sum())
            ends = pa.array(np.concatenate([[0], np.cumsum(probe)]), pa.int32())
            prefix = pa.ListArray.from_arrays(ends, pa.array(token[at].view(np.int64)))
            # The rarest come first, so the common ones are the last of a prefix.
            below = np.concatenate([[0], np.cumsum(shared.value[_bucket(token[at])] < COMMON)])
            rare = np.diff(below[np.concatenate([[0], np.cumsum(probe)])])

            def sent(kind, where, line, numbers, prefix=None, rare=None):
                count = len(where)
                named = kind != _LINE
                columns = [
                    pa.array(np.arange(lid, lid + count)),
                    slab.column("row").take(pa.array(where)),
                    slab.column("doc_id").take(pa.array(where, mask=None if named else np.ones(count, bool))),
                    pa.array(line, pa.int32()),
                    *map(pa.array, numbers[:2]),
                    pa.array(numbers[2], pa.int32()),
                    pa.nulls(count, pa.list_(pa.int64())) if prefix is None else prefix,
                    pa.nulls(count, pa.int32()) if rare is None else pa.array(rare, pa.int32()),
                    pa.array(np.full(count, kind), pa.int32()),
                ]
                return pa.RecordBatch.from_arrays(columns, names)

            texts = np.arange(slab.num_rows)
            none = np.zeros(slab.num_rows, np.int64)
            where = text[own]
            yield sent(_LINE, where, number[own], (a, b, size))
            yield sent(_PREFIX, where, number[own], (a, b, size), prefix, rare)
            yield sent(_TEXT, texts, none - 1, (none, none, found.counts))
            lid += len(where)

    schema = T.StructType(
        [
            T.StructField("lid", T.LongType()),
            T.StructField("row", T.LongType()),
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("line", T.IntegerType()),
            T.StructField("a", T.LongType()),
            T.StructField("b", T.LongType()),
            T.StructField("size", T.IntegerType()),
            T.StructField("prefix", T.ArrayType(T.LongType())),
            T.StructField("rare", T.IntegerType()),
            T.StructField("kind", T.IntegerType()),
        ]
    )
    return map_arrow(rows, run, schema)


def _words(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, first, words): the words' hashes of the lines of the nodes.

    Few nodes, as counted, are sent to the tasks, which then leave other lines
    out before the join.
    """
    few = nodes.count() <= BROADCAST_ROWS
    wanted = None
    if few:
        sent = np.unique(nodes.select("a").toArrow()["a"].to_numpy())
        wanted = rows.sparkSession.sparkContext.broadcast(sent)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for slab in slabs(batches, "text"):
            found = Lines(*text_bytes(slab.column("text")))
            a, b = found.keys()
            short = (found.words.hash >> np.uint64(32)).astype(np.uint32)
            # Every word is in a line of `own`, so the lines' words follow each other.
            borders = np.append(found.of[found.own], len(short)) * 4
            words = pa.Array.from_buffers(
                pa.binary(), len(a), [None, pa.py_buffer(borders.astype(np.int32)), pa.py_buffer(short)]
            )
            by = np.lexsort((b, a))
            taken = np.ones(len(by), bool)
            # Equal lines are sent once a slab.
            taken[1:] = (np.diff(a[by]) != 0) | (np.diff(b[by]) != 0)
            if wanted is not None and len(wanted.value):
                at = np.searchsorted(wanted.value, a[by])
                taken &= wanted.value[np.minimum(at, len(wanted.value) - 1)] == a[by]
            lines = pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), words], ["a", "b", "words"])
            yield lines.take(pa.array(by[taken]))

    found = map_arrow(rows.select("text"), run, "a long, b long, words binary")
    # Equal lines have equal words, so any of them will do.
    found = found.join(F.broadcast(nodes) if few else nodes, ["a", "b"])
    return found.groupBy("node").agg(F.any_value("first").alias("first"), F.any_value("words").alias("words"))


def _tokens_needed(part: float, size: Column) -> Column:
    """`_whole` as a column."""
    return F.ceil(part * size - 1e-9)


def _may_match(x: str, y: str) -> Column:
    """Prefix, length and positional filters on two rows that share a token."""
    size_x, size_y = F.col(f"{x}.size"), F.col(f"{y}.size")
    place_x, place_y = F.col(f"{x}.place"), F.col(f"{y}.place")
    indexed = place_x < size_x - _tokens_needed(2 * SIMILARITY / (1 + SIMILARITY), size_x) + 1
    long_enough = (size_x <= size_y) & (size_x >= SIMILARITY * size_y - 1e-9)
    left = 1 + F.least(size_x - place_x - 1, size_y - place_y - 1)
    return indexed & long_enough & (left >= _tokens_needed(SIMILARITY / (1 + SIMILARITY), size_x + size_y))


def _either(x: str, y: str) -> Column:
    return (F.col(f"{x}.node") != F.col(f"{y}.node")) & (_may_match(x, y) | _may_match(y, x))


def _pairs(x: DataFrame, y: DataFrame) -> DataFrame:
    """Candidate pairs (a < b) of rows of two frames that share a token."""
    joined = x.alias("x").join(y.alias("y"), F.col("x.token") == F.col("y.token"))
    joined = joined.filter(_either("x", "y"))
    return joined.select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
    ).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    """The nodes of the pairs, perhaps several times."""
    return pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node")))


def _matches(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(gone, by): the later and the earlier line of each pair that matches."""
    words = cut_lineage(words.join(small(_ends(pairs).distinct()), "node"), "words")
    left = words.select(F.col("node").alias("a"), F.col("words").alias("left"), F.col("first").alias("x"))
    right = words.select(F.col("node").alias("b"), F.col("words").alias("right"), F.col("first").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select(
        F.when(F.col("x") < F.col("y"), F.col("b")).otherwise(F.col("a")).alias("gone"),
        F.when(F.col("x") < F.col("y"), F.col("a")).otherwise(F.col("b")).alias("by"),
        "left",
        "right",
    )

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, _PAIRS):
                some = batch.slice(start, _PAIRS)
                equal = jaccard(some.column("left"), some.column("right")) >= SIMILARITY - 1e-9
                yield some.select(["gone", "by"]).filter(pa.array(equal))

    matched = cut_lineage(map_arrow(joined, run, "gone long, by long"), "matches")
    discard(words)
    return matched


def _row_tokens(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and token of lines given by their words' 32-bit hashes."""
    raw = np.frombuffer(b"".join(words.to_pylist()), np.uint32).astype(np.uint64)
    sizes = pc.binary_length(words).to_numpy() // 4
    of = np.concatenate([[0], np.cumsum(sizes)])
    return _tokens(raw, np.repeat(np.arange(len(sizes)), sizes), sizes, of)


def jaccard(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Similarity of the token sets of each two lines, given by their words' hashes."""
    pairs, (rows, tokens) = len(left), _row_tokens(left)
    more_rows, more = _row_tokens(right)
    is_right = np.arange(len(tokens) + len(more)) >= len(tokens)
    rows, tokens = np.concatenate([rows, more_rows]), np.concatenate([tokens, more])
    # Row and token in one number: a fast sort.
    key = tokens + mix(rows)
    by = np.argsort(key)
    if ((key[by][1:] == key[by][:-1]) & (rows[by][1:] != rows[by][:-1])).any():
        by = np.lexsort((tokens, rows))
    row, token = rows[by], tokens[by]
    new = np.ones(len(by), bool)
    new[1:] = (row[1:] != row[:-1]) | (token[1:] != token[:-1])
    group, own = np.cumsum(new) - 1, is_right[by]
    sides = np.zeros((2, int(new.sum())), bool)
    sides[0, group[~own]] = True
    sides[1, group[own]] = True
    both = np.bincount(row[new][sides.all(axis=0)], minlength=pairs)
    return both / np.bincount(row[new], minlength=pairs)


def later_matches(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(gone, by) for every node that an earlier one matches, perhaps several times."""
    tokens = F.posexplode("prefix").alias("place", "token")
    with_common = sets.filter(F.col("rare") < F.size("prefix"))
    # Postings of at most COMMON lines are counted where they meet, the others before they do.
    members = F.count(F.lit(1)).over(Window.partitionBy("token")).alias("members")
    rare = sets.select("node", "size", "rare", tokens).filter("place < rare")
    rare = rare.select("node", "size", "place", "token", members).filter("members > 1")
    common = with_common.select("node", "size", "rare", tokens).filter("place >= rare").drop("rare")
    several = common.groupBy("token").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    met = cut_lineage(rare.unionByName(common.join(small(several), "token")), "met")
    release_shuffles(rows.sparkSession)
    few = met.filter(F.col("members") <= SMALL)
    pairs = cut_lineage(_pairs(few, few), "pairs")
    large = cut_lineage(met.filter(F.col("members") > SMALL), "large")
    discard(met)
    nodes = _ends(pairs).unionAll(large.select("node")).distinct()
    nodes = cut_lineage(sets.select("node", "a", "b", "first").join(nodes, "node"), "nodes")
    words = cut_lineage(_words(rows, nodes), "words")
    discard(nodes)
    found = [_matches(pairs, words)]
    discard(pairs)
    if not large.isEmpty():
        found += _large_matches(large, words, sets)
    discard(large, words)
    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    return every.distinct()


def _large_matches(large: DataFrame, words: DataFrame, sets: DataFrame) -> list[DataFrame]:
    """Matches among the lines of tokens that many lines share."""
    ordered = large.join(sets.select("node", "first"), "node")
    leaders = ordered.groupBy("token").agg(
        F.min(F.struct("first", "node", "size", "place")).alias("m"), F.max("members").alias("most")
    )
    leaders = cut_lineage(leaders.select("token", "m.node", "m.size", "m.place", "most"), "leaders")
    most = leaders.agg(F.max("most")).first()[0]
    # A row's block: the first holds one row of a token, each further GROWTH times more.
    drawn = F.pmod(F.xxhash64("token", "node"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    block = F.floor(F.log(float(GROWTH), F.greatest(drawn * F.col("members"), F.lit(1.0))))
    blocks = cut_lineage(large.withColumn("block", block), "blocks")
    pairs = cut_lineage(_pairs(leaders, blocks), "pairs")
    found = [_matches(pairs, words)]
    discard(leaders, pairs)
    waiting, number, done = blocks, 0, []
    while GROWTH**number <= most:
        gone = found[-1].select(F.col("gone").alias("node")).distinct()
        waiting = cut_lineage(waiting.join(gone, "node", "left_anti"), "waiting")
        discard(*done)
        done = [waiting]
        if waiting.isEmpty():
            break
        pairs = cut_lineage(_pairs(blocks.filter(F.col("block") == number), waiting), "pairs")
        found.append(_matches(pairs, words))
        discard(pairs)
        number += 1
    discard(blocks, *done)
    return found


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None
) -> DataFrame:
    """One row per row of `docs`: row, doc_id, n_lines, and the numbers of the lines to remove."""
    columns = {"doc_id": id_col, "text": text_col} | ({"row": row_col} if row_col else {})
    rows = picked(docs, **columns)
    if not row_col:
        rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("row", "doc_id", "text")
    path = fresh_path(docs.sparkSession, "lines")
    every = _lines(rows, token_counts(rows))
    write_parts(every, path, "kind")

    def written(kind: int, *columns: str) -> DataFrame:
        return read_written(docs.sparkSession, path, every.select(*columns).schema, ("kind", kind))

    lines = written(_LINE, "lid", "row", "line", "a", "b")
    prefixes = written(_PREFIX, "lid", "row", "doc_id", "line", "a", "b", "size", "prefix", "rare")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "line")
    # What all lines of a set share rides along with the first of them.
    first = F.min(F.struct(place.alias("first"), F.col("lid").alias("node"), "size", "prefix", "rare"))
    sets = prefixes.groupBy("a", "b").agg(first.alias("m"), F.count(F.lit(1)).alias("lines"))
    sets = sets.select("a", "b", "m.*", "lines")
    sets = cut_lineage(sets, "sets")
    discard(prefixes)
    gone = later_matches(rows, sets).select(F.col("gone").alias("node")).distinct()
    gone = cut_lineage(gone.withColumn("gone", F.lit(True)), "gone")
    # The only line of a set stays, unless an earlier line matches it.
    judged = sets.select("a", "b", "node", "lines").join(small(gone), "node", "left")
    judged = judged.filter((F.col("lines") > 1) | F.col("gone")).drop("lines")
    judged = cut_lineage(judged, "judged")
    dropped = (
        lines.join(small(judged), ["a", "b"])
        .filter((F.col("lid") != F.col("node")) | F.col("gone"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("line")).alias("removed"))
    )
    texts = written(_TEXT, "row", "doc_id", "size")
    texts = texts.select("row", "doc_id", F.col("size").cast("long").alias("n_lines"))
    return texts.join(dropped, "row", "left").select(
        "row", "doc_id", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed")
    )


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the repeated lines; texts that lose none, null ones too, stay as they are."""
    rows, row = with_row(docs)
    gone = unused(rows, "_gone")
    found = repeated_lines(rows, id_col, text_col, row).filter(F.size("removed") > 0)
    dropped = found.select(F.col("row").alias(row), F.col("removed").alias(gone))
    text = column(text_col)
    kept = F.filter(F.split(text, "\n", -1), lambda line, n: ~F.array_contains(F.col(gone), n))
    clean = F.when(F.col(gone).isNull(), text).otherwise(F.array_join(kept, "\n"))
    kept_columns = [clean.alias(c) if c == text_col else column(c) for c in docs.columns]
    return rows.join(dropped, row, "left").select(*kept_columns)
