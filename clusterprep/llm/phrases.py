"""Phrases whose words come together more often than apart, from sorted count streams.

Texts are lower-cased (A to Z), cut into pieces at `.,;:!?` and line breaks, and
those into words at spaces and tabs. From every word on, a window of up to
`max_words` words of its piece is taken. Equal windows of a slab of text are one
row with a count. The windows are sorted once, in prefix order: each phrase is
the start of some windows, which lie next to each other, so one pass over the
sorted stream counts the phrases of all lengths. Every part of a phrase is at
least as frequent as the phrase, so only phrases of `min_count` occurrences go on.

These phrases are then kept as a stream in prefix order and as one in suffix
order. In prefix order a phrase follows its own first words, so a pass with a
stack of the open phrases, at most `max_words` deep, meets each phrase in step
with the counts of all its first parts, and each open phrase with its extensions
to the right; in suffix order it does so with the last parts and extensions to
the left. No count is looked up in a hash table.

Streams are dealt out in ranges of the whole order, not by a first word, so a
word or phrase that a third of all rows hold spreads over tasks. A phrase whose
windows, or an open phrase whose extensions, lie on both sides of a border is
put together from the parts: at most `max_words` for each border and side. The
borders of the windows' ranges come from a sample (about `SAMPLED` windows a range, in
all about `MOST_SAMPLED` at most, from `TEXTS_SAMPLED` of the texts), which decides where rows go and never what is counted.

All windows take part, at any size of the corpus: what is shuffled is a row for
each different window of a slab, sorted, so that neighbours share their
beginnings and compress well.

A null language is `und`; a null text is empty. Texts may be of any length.
Repeated rows are counted as often as they occur. Ties of score and count are in
the byte order of the phrases. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterprep.llm.arrays import LOWER, slabs, text_bytes
from clusterprep.llm.rows import map_arrow, picked, small
from clusterprep.session import checkpointed, cut_lineage

SLAB = 1 << 20  # bytes of text whose windows are counted together
RANGES = 8  # for each shuffle partition
SAMPLED = 40
MOST_SAMPLED = 1_000_000
TEXTS_SAMPLED = 0.02
UNKNOWN = "und"
DEALT = 64  # parts of a language that are ranked on their own before all together

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _PIECE_END.copy()
_APART[[0x20, 0x09]] = True


class Pieces:
    """Words of the texts of one slab: their number in `words`, their piece and language."""

    def __init__(self, slab: pa.RecordBatch):
        data, offsets = text_bytes(slab.column("text"))
        data = LOWER[data]
        inside = ~_APART[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        borders = offsets[1:-1]
        borders = borders[borders < len(data)]
        first[borders] = inside[borders]
        start = np.flatnonzero(first)
        letters = np.concatenate([[0], np.cumsum(inside)])
        ends = np.append(letters[start], letters[-1]).astype(np.int32)
        texts = pa.Array.from_buffers(
            pa.string(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data[inside].tobytes())]
        )
        coded = texts.dictionary_encode()
        self.words: pa.StringArray = coded.dictionary
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.searchsorted(offsets, start, side="right") - 1
        self.piece = np.cumsum(_PIECE_END[data])[start] + text
        langs = slab.column("lang").dictionary_encode()
        self.langs: pa.StringArray = langs.dictionary
        self.lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]


def _pieces(batches) -> Iterator[Pieces]:
    """The rows in slabs; short ones are joined up to the size of a slab."""
    waiting, size = [], 0
    for slab in slabs(batches, "text", SLAB):
        waiting.append(slab)
        size += slab.nbytes
        if size >= SLAB:
            yield Pieces(_joined(waiting))
            waiting, size = [], 0
    if waiting:
        yield Pieces(_joined(waiting))


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _names(max_words: int) -> list[str]:
    return [f"w{k}" for k in range(max_words)]


def _schema(max_words: int, *more: str) -> str:
    return ", ".join(["lang string", *[f"{name} string" for name in _names(max_words)], *more])


# A window's key: the language and words, each with a zero byte behind it but the
# last. Zeros and ones in words are two bytes, so keys are in the order of the words.
_ESCAPES = (("\x01", "\x01\x02"), ("\x00", "\x01\x01"))


def _escaped(words: pa.Array) -> pa.Array:
    for plain, escaped in _ESCAPES:
        words = pc.replace_substring(words, plain, escaped)
    return words


def _unescaped(words: pa.Array) -> pa.Array:
    for plain, escaped in reversed(_ESCAPES):
        words = pc.replace_substring(words, escaped, plain)
    return words


def _in_order(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Different values in byte order, and the place of each there."""
    words = _escaped(words)
    by = pc.sort_indices(words.cast(pa.binary())).to_numpy()
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    return words.take(pa.array(by)), place


def _counted(found: Pieces, max_words: int) -> tuple[pa.Array, np.ndarray]:
    """Keys of the different windows of a slab in order, and how often they occur."""
    count = len(found.word)
    langs, lang_place = _in_order(found.langs)
    words, word_place = _in_order(found.words)
    # Two bits more than the places need, so that 0 can stand for no word.
    bits = max(1, len(words)).bit_length()
    window = np.zeros((max_words, count), np.int64)
    window[0] = word_place[found.word] + 1
    for k in range(1, max_words):
        same = found.piece[k:] == found.piece[:-k]
        window[k, : count - k][same] = window[0, k:][same]
    # As many words as fit are compared as one number.
    each = max(1, (62 - len(langs).bit_length()) // bits)
    keys = []
    number = lang_place[found.lang]
    room = each
    for column in window:
        if not room:
            keys.append(number)
            number, room = np.zeros(count, np.int64), 62 // bits
        number = (number << bits) | column
        room -= 1
    keys.append(number)
    by = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
    new = np.ones(count, bool)
    if count:
        new[1:] = False
        for key in keys:
            key = key[by]
            new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    at = by[first]
    columns = [langs.take(pa.array(lang_place[found.lang[at]]))]
    for column in window:
        column = column[at]
        columns.append(words.take(pa.array(column - 1, mask=column == 0)))
    keys = pc.binary_join_element_wise(*columns, "\x00", null_handling="skip")
    return keys, np.diff(np.append(first, count))


def _borders(rows: DataFrame, max_words: int, ranges: int) -> list[bytes]:
    """Keys that part the windows into about equal ranges."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = min(SAMPLED * ranges, MOST_SAMPLED)
    # About 6 bytes a word. A share of all texts is read, or all of a small table.
    words = max(1, size / 6)
    share = min(1.0, max(TEXTS_SAMPLED, 1_000_000 / words))
    drawn_of = min(1.0, wanted / (share * words))

    def run(batches):
        rng = np.random.default_rng(TaskContext.get().partitionId())
        for found in _pieces(batches):
            keys, _ = _counted(found, max_words)
            keys = keys.filter(pa.array(rng.random(len(keys)) < drawn_of))
            yield pa.RecordBatch.from_arrays([keys.cast(pa.binary())], ["key"])

    drawn = map_arrow(rows.sample(share, seed=1), run, "key binary")
    keys = sorted(row["key"] for row in drawn.toLocalIterator())
    borders = {bytes(keys[len(keys) * n // ranges]) for n in range(1, ranges)} if keys else set()
    return sorted(borders)


def _windows(rows: DataFrame, max_words: int, borders: list[bytes]) -> DataFrame:
    """Keys of the different windows of each slab, their counts and ranges."""
    shared = rows.sparkSession.sparkContext.broadcast(borders)

    def run(batches):
        for found in _pieces(batches):
            keys, times = _counted(found, max_words)
            keys = keys.cast(pa.binary())
            ends, at = [], 0
            for border in shared.value:
                at = bisect_left(_Keys(keys), border, at)
                ends.append(at)
            ranges = np.repeat(np.arange(len(ends) + 1), np.diff([0, *ends, len(keys)]))
            for start in range(0, len(keys), 50_000):
                part = slice(start, start + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [keys[part], pa.array(times[part], pa.int32()), pa.array(ranges[part], pa.int32())],
                    ["key", "times", "range"],
                )
        pa.default_memory_pool().release_unused()

    return map_arrow(rows, run, "key binary, times int, range int")


class _Keys:
    """The keys as a sequence for `bisect`."""

    def __init__(self, keys: pa.Array):
        self._keys = keys

    def __len__(self) -> int:
        return len(self._keys)

    def __getitem__(self, at: int) -> bytes:
        return self._keys[at].as_py()


class _Counter:
    """Counts of the phrases of one size in a range of windows in prefix order.

    A phrase at either end of the range may go on in the next one, so it is
    sent as a part, whatever its count. `add` and `finish` give (phrases, counts,
    whether they are parts), a phrase being its language and words.
    """

    def __init__(self, size: int, least: int):
        self.size, self._least = size, least
        self._open: tuple | None = None  # the last phrase and its count so far
        self._starts = False  # whether that phrase began the range
        self._begun = False

    def add(self, windows: pa.RecordBatch, times: np.ndarray, filled: np.ndarray, equal: np.ndarray):
        """`filled` marks windows long enough, `equal` those whose phrase the window before has."""
        began, self._begun = self._begun, True
        new = np.flatnonzero(filled & ~equal)
        if not len(new):
            if self._open:
                yield self._closed()
            return
        sums = np.add.reduceat(np.where(filled, times, 0), new)
        starts = not began and new[0] == 0
        if self._open:
            if self._open[0] == self._phrase(windows, new[0]):
                sums[0] += self._open[1]
                starts = self._starts
                self._open = None
            else:
                yield self._closed()
        if filled[-1]:
            self._open = (self._phrase(windows, new[-1]), int(sums[-1]))
            self._starts = starts and len(new) == 1
            new, sums = new[:-1], sums[:-1]
        if starts and len(new):
            yield self._rows(windows, new[:1]), sums[:1], True
            new, sums = new[1:], sums[1:]
        kept = sums >= self._least
        if kept.any():
            yield self._rows(windows, new[kept]), sums[kept], False

    def finish(self):
        if self._open:
            self._starts = True
            yield self._closed()

    def _phrase(self, windows: pa.RecordBatch, row: int) -> tuple:
        return tuple(column[int(row)].as_py() for column in windows.columns[: self.size + 1])

    def _rows(self, windows: pa.RecordBatch, rows: np.ndarray) -> list[pa.Array]:
        return [column.take(pa.array(rows)) for column in windows.columns[: self.size + 1]]

    def _closed(self):
        (phrase, count), self._open = self._open, None
        counts = np.array([count])
        whole = not self._starts and count < self._least
        columns = [pa.array([word] if not whole else [], pa.string()) for word in phrase]
        return columns, counts[: 0 if whole else 1], self._starts


def _phrase_counts(windows: DataFrame, max_words: int, min_count: int) -> DataFrame:
    """All phrases of `min_count` or more occurrences, single words too: lang, w0, w1, ..., f.

    A language has a row without words, whose f is the number of all its words.
    """
    names = ["lang", *_names(max_words)]

    def run(batches):
        totals: dict[str, int] = {}
        counters, current = [], None

        def sent(size, columns, counts, part):
            nulls = [pa.nulls(len(counts), pa.string())] * (max_words - size)
            columns = [_unescaped(column) for column in columns]
            flags = pa.array(np.full(len(counts), part))
            return pa.RecordBatch.from_arrays(
                [*columns, *nulls, pa.array(counts.astype(np.int64)), flags], [*names, "f", "part"]
            )

        def finished():
            for counter in counters:
                for found in counter.finish():
                    yield sent(counter.size, *found)

        for batch in batches:
            numbers = batch.column("range").to_numpy()
            stops = [*np.flatnonzero(numbers[1:] != numbers[:-1]) + 1, len(numbers)]
            start = 0
            for stop in map(int, stops):
                if stop == start:
                    continue
                if numbers[start] != current:
                    yield from finished()
                    counters = [_Counter(size, min_count) for size in range(1, max_words + 1)]
                    current = numbers[start]
                words = _split(batch.column("key")[start:stop], names)
                times = batch.column("times")[start:stop].to_numpy().astype(np.int64)
                _add_up(totals, words.column(0), times)
                equal = np.ones(stop - start, bool)
                equal[0] = False
                equal[1:] &= _same(words.column(0))
                for counter, column in zip(counters, words.columns[1:]):
                    equal[1:] &= _same(column)
                    filled = column.is_valid().to_numpy(zero_copy_only=False)
                    for found in counter.add(words, times, filled, equal):
                        yield sent(counter.size, *found)
                start = stop
        yield from finished()
        if totals:
            langs = _unescaped(pa.array(list(totals), pa.string()))
            yield sent(0, [langs], np.array(list(totals.values())), True)

    partitions = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = windows.repartition(partitions, "range").sortWithinPartitions("key")
    found = cut_lineage(map_arrow(ordered, run, _schema(max_words, "f long", "part boolean")), "counts")
    parts = found.filter("part").groupBy(*names).agg(F.sum("f").alias("f"))
    whole = found.filter("NOT part").select(*names, "f")
    words = F.filter(F.array(*_names(max_words)), lambda w: w.isNotNull())
    every = whole.unionAll(parts.filter((F.col("f") >= min_count) | F.col("w0").isNull()))
    return cut_lineage(every.select("lang", words.alias("words"), "f"), "phrases")


def _split(keys: pa.Array, names: list[str]) -> pa.RecordBatch:
    """The language and words of keys as columns, null where a window is shorter."""
    lists = pc.split_pattern(keys.cast(pa.string()), "\x00")
    ends = np.asarray(lists.offsets)
    size = np.diff(ends)
    columns = [
        lists.values.take(pa.array(ends[:-1] + k, mask=size <= k)) for k in range(len(names))
    ]
    return pa.RecordBatch.from_arrays(columns, names)


def _add_up(totals: dict[str, int], langs: pa.Array, times: np.ndarray) -> None:
    coded = langs.dictionary_encode()
    sums = np.bincount(coded.indices.to_numpy(), weights=times, minlength=len(coded.dictionary))
    for lang, count in zip(coded.dictionary.to_pylist(), sums):
        totals[lang] = totals.get(lang, 0) + int(count)


def _same(column: pa.Array) -> np.ndarray:
    """Whether each value but the first equals the one before; nulls equal nothing."""
    if len(column) < 2:
        return np.zeros(0, bool)
    return pc.equal(column[1:], column[:-1]).fill_null(False).to_numpy(zero_copy_only=False)


class _Open:
    """A phrase that later rows of the stream may extend."""

    __slots__ = ("lang", "key", "f", "row", "tied")

    def __init__(self, lang: str, key: list[str], f: int, row: tuple | None):
        self.lang, self.key, self.f, self.row, self.tied = lang, key, f, row, False

    def starts(self, lang: str, key: list[str]) -> bool:
        return self.lang == lang and len(self.key) < len(key) and key[: len(self.key)] == self.key


def _walk(rows: Iterator[tuple], stack: list[_Open], backwards: bool) -> Iterator[tuple[_Open, list[int]]]:
    """Rows (lang, words, f, ...) in order, each with the counts of the phrases that it extends.

    `stack` holds the open phrases; what is left of it at the end stays open. A
    row comes when it is closed, and is then `tied` if an extension is as frequent.
    """
    counts: dict[int, list[int]] = {}
    for row in rows:
        lang, words, f = row[:3]
        key = words[::-1] if backwards else words
        while stack and not stack[-1].starts(lang, key):
            top = stack.pop()
            yield top, counts.pop(id(top), [])
        if stack and len(stack[-1].key) == len(key) - 1 and stack[-1].f == f:
            stack[-1].tied = True
        top = _Open(lang, key, f, row)
        counts[id(top)] = [x.f for x in stack]
        stack.append(top)
    for top in list(stack):
        yield top, counts.pop(id(top), [])


def _with_parts(phrases: DataFrame, max_words: int, backwards: bool, counts: str, tied: str) -> DataFrame:
    """The phrases with the counts of their first (or last) parts, from one word on, and `tied`.

    A phrase is tied if one more word after (or before) it comes with it always.
    """
    session = phrases.sparkSession
    order = F.reverse("words") if backwards else F.col("words")
    keys = [F.get(order, F.lit(k)).alias(f"_k{k}") for k in range(max_words)]
    names = ["lang", *[f"_k{k}" for k in range(max_words)]]
    partitions = int(session.conf.get("spark.sql.shuffle.partitions"))
    dealt = phrases.select("*", *keys).repartitionByRange(partitions, *names).sortWithinPartitions(*names)
    dealt = checkpointed(dealt.select(*phrases.columns))

    def rows(batches):
        for batch in batches:
            yield from zip(*[column.to_pylist() for column in batch.columns])

    def edges(batches):
        """A partition's first phrase and those left open at its end."""
        first, stack = [], []

        def noted(stream):
            for row in stream:
                if not first:
                    first.append((row[0], row[1][::-1] if backwards else row[1], row[2]))
                yield row

        for _ in _walk(noted(rows(batches)), stack, backwards):
            pass
        found = first + [(x.lang, x.key, x.f) for x in stack]
        number = TaskContext.get().partitionId()
        columns = [pa.array([number] * len(found), pa.int32()), *map(pa.array, zip(*found))] if found else []
        if found:
            yield pa.RecordBatch.from_arrays(columns, ["number", "lang", "key", "f"])

    ends: dict[int, list[tuple]] = {}
    for row in map_arrow(dealt, edges, "number int, lang string, key array<string>, f long").toLocalIterator():
        ends.setdefault(row["number"], []).append((row["lang"], row["key"], row["f"]))
    before: dict[int, list[tuple]] = {}  # phrases open where a partition begins
    still: list[tuple] = []
    for number in sorted(ends):
        (lang, key, _), *own = ends[number]
        before[number] = [x for x in still if _Open(*x, None).starts(lang, key)]
        lang, key, _ = own[-1]
        still = [x for x in before[number] if _Open(*x, None).starts(lang, key)] + own
    shared = session.sparkContext.broadcast(before)
    types = [session_field.dataType for session_field in phrases.schema.fields]
    out = T.StructType(
        [T.StructField(name, kind) for name, kind in zip(phrases.columns, types)]
        + [T.StructField(counts, T.ArrayType(T.LongType())), T.StructField(tied, T.BooleanType())]
        + [T.StructField("_again", T.BooleanType())]
    )

    def run(batches):
        stack = [_Open(*x, None) for x in shared.value.get(TaskContext.get().partitionId(), [])]
        kinds, done = None, []

        def typed():
            nonlocal kinds
            for batch in batches:
                kinds = [column.type for column in batch.columns]
                yield batch

        def sent():
            columns = [pa.array(c, k) for c, k in zip(zip(*done), kinds + [pa.list_(pa.int64()), pa.bool_(), pa.bool_()])]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, out.names)

        for top, parts in _walk(rows(typed()), stack, backwards):
            if top.row is not None:
                done.append((*top.row, parts, top.tied, False))
            elif top.tied:
                words = top.key[::-1] if backwards else top.key
                rest = [None] * (len(kinds) - 3)
                done.append((top.lang, words, top.f, *rest, None, True, True))
            if len(done) >= 10_000:
                yield sent()
        if done:
            yield sent()

    found = cut_lineage(map_arrow(dealt, run, out), "parts")
    # Phrases that a border parts from a tied extension: at most max_words for each partition.
    again = found.filter("_again").select("lang", "words", F.lit(True).alias("_more")).distinct()
    whole = found.filter("NOT _again").join(F.broadcast(again), ["lang", "words"], "left")
    return whole.select(
        *phrases.columns, counts, (F.col(tied) | F.col("_more").isNotNull()).alias(tied)
    )


def _scored(candidates: DataFrame) -> DataFrame:
    """a, l, r and score of each candidate's lowest cut; whole numbers of any size in between."""

    def run(batches):
        for batch in batches:
            cuts = []
            columns = [batch.column(name).to_pylist() for name in ("f", "n", "starts", "ends")]
            for a, n, starts, ends in zip(*columns):
                options = zip(starts, reversed(ends))
                cuts.append(min(((1000 * a * n // (x * y), x, y) for x, y in options), key=lambda c: c[0]))
            score, x, y = zip(*cuts) if cuts else ([], [], [])
            numbers = [batch.column("f"), *[pa.array(c, pa.int64()) for c in (x, y)], batch.column("n")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("words"), *numbers, pa.array(score, pa.int64())],
                ["lang", "words", "a", "l", "r", "n", "score"],
            )

    schema = "lang string, words array<string>, a long, l long, r long, n long, score long"
    return map_arrow(candidates, run, schema)


def mine_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    max_words: int = 5,
    min_count: int = 100,
    top: int = 2000,
) -> DataFrame:
    """Each language's first `top` phrases of 2 to `max_words` words: lang, rank, phrase, a, l, r, n, score.

    a is the phrase's count, n that of all words of the language, l and r the
    counts of the parts before and after its lowest-scoring cut, and score
    floor(1000 a n / (l r)). Phrases inside a longer one of the same count are left out.
    """
    rows = picked(docs, text=text_col, lang=lang_col)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    rows = rows.select("text", lang.alias("lang"))
    ranges = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    windows = _windows(rows, max_words, _borders(rows, max_words, ranges))
    counted = _phrase_counts(windows, max_words, min_count)
    totals = counted.filter("size(words) = 0").select("lang", F.col("f").alias("n"))
    phrases = counted.filter("size(words) > 0")
    phrases = _with_parts(phrases, max_words, False, "starts", "goes_on")
    phrases = _with_parts(phrases, max_words, True, "ends", "comes_before")
    candidates = phrases.filter("size(words) > 1 AND NOT goes_on AND NOT comes_before")
    scored = _scored(candidates.join(small(totals), "lang").select("lang", "words", "f", "n", "starts", "ends"))
    scored = scored.withColumn("phrase", F.array_join("words", " ")).drop("words")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    dealt = F.pmod(F.xxhash64("phrase"), F.lit(DEALT)).alias("part")
    some = Window.partitionBy("lang", "part").orderBy(*order)
    first = scored.select("*", dealt).withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
