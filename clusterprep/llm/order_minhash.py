"""Near-duplicates by order MinHash, verified by banded alignment.

The k-mers of a text are its runs of `K` words (all its words, if it has
fewer), labelled with their occurrence number, so that repeats count. Each of
`BANDS` hash functions samples the `ELL` labelled k-mers of least hash and
keeps them in their text order; texts with the same ordered sample are
candidates. Order matters, so moved blocks lower the chance to meet, as they
lower the edit similarity. Texts of at most `SHORT` k-mers take another, exact
route: they and all texts that can match one meet by every k-mer of their
prefix, the n - ceil(s n) + 1 rarest. Texts of similarity s share one. How rare
k-mers are is counted before, by hash bucket, over texts of up to `COUNTED`
characters; that only orders them, and any order finds all links, but in this
one a footer that unrelated texts share is in no prefix.

A candidate pair is verified by alignment: the longest common subsequence of
the labelled k-mers, of which each occurs once, restricted to the diagonal band
that a similarity of `SIMILARITY` allows. Similarity is matched / (all -
matched); links have `SIMILARITY` or more. Classes are the connected components
of the links.

Texts of equal words are one node throughout. All pairs of a bucket of similar
size are candidates, and every candidate is verified, so `n_links` counts all
links that the samples find. Buckets of at most `SMALL` nodes give pairs as rows.
A larger bucket is dealt into blocks of about `BLOCK` nodes or `BLOCK_KMERS`
k-mers; each two of its blocks are one row, in which a task compares all their
nodes, and only counts of links and a tree of each linked group leave it. Nodes
that meet in several large buckets are compared in the one of the least key. So
no task gets a whole bucket and no table grows with the square of its nodes; the
comparisons do, as each link is counted. Two longer texts of similarity 0.8 whose
common k-mers keep their order share a sample of 4 with a chance of 0.397 (at 50
k-mers in all) to 0.41 per band: all 24 bands miss them at most once in 180,000 cases.

Null texts and texts without words are alone in their class. A null id sorts
after all others. Repeated rows are in one class. Ties in the choice of the
kept row go to the smallest id, then the first row. An empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterprep.llm.arrays import Words, grams, mix, slabs, text_bytes
from clusterprep.llm.bucket_counts import bucket_counts, bucket_of
from clusterprep.llm.components import components
from clusterprep.llm.rows import map_arrow, picked, small, with_row, without
from clusterprep.session import cut_lineage, discard

K = 5
BANDS = 24
ELL = 4
SIMILARITY = 0.8
SHORT = 40
BUCKETS = 1 << 20  # of the counts of short texts' k-mers: 4 MB when broadcast
COUNTED = 2000
SMALL = 32
BLOCK = 256
BLOCK_KMERS = 1 << 17
_WIDE = 1 << 18  # hash values held at a time

_SEEDS = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
_ODD = mix(np.arange(101, BANDS + 101, dtype=np.uint64)) | np.uint64(1)


def labelled_kmers(words: np.ndarray) -> np.ndarray:
    """Hash of each k-mer with its occurrence number, in text order; all are different."""
    if not len(words):
        return np.zeros(0, np.uint64)
    codes = grams(words.astype(np.uint64), min(K, len(words)))
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    first = np.ones(len(codes), bool)
    first[1:] = ranked[1:] != ranked[:-1]
    if not first.all():
        starts = np.flatnonzero(first)
        number = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
        codes[order] = mix(ranked + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return codes


def ordered_samples(kmers: np.ndarray) -> np.ndarray:
    """For each band a 64-bit key of the sample."""
    most = min(ELL, len(kmers))
    together = max(1, _WIDE // len(kmers))
    picks = []
    for start in range(0, BANDS, together):
        hashed = (kmers[None, :] ^ _SEEDS[start : start + together, None]) * _ODD[start : start + together, None]
        if most < len(kmers):
            at = np.argpartition(hashed, most - 1, axis=1)[:, :most]
        else:
            at = np.broadcast_to(np.arange(most), hashed.shape)
        picks.append(at)
    ordered = kmers[np.sort(np.concatenate(picks), axis=1)]
    code = _SEEDS.copy()
    for column in ordered.T:
        code = code * np.uint64(0xD1342543DE82EF95) + column
    return mix(code).view(np.int64)


def meeting_keys(kmers: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The keys by which a text meets others: its samples, its prefix, or both."""
    size, keys = len(kmers), []
    if size > SHORT:
        keys.append(ordered_samples(kmers))
    if _meets_by_prefix(size):
        needed = int(np.ceil(SIMILARITY * size - 1e-9))
        mixed = mix(kmers)
        rarest = np.lexsort((mixed, counts[bucket_of(mixed, len(counts))]))
        keys.append(mixed[rarest[: size - needed + 1]].view(np.int64))
    return np.concatenate(keys)


def _meets_by_prefix(size: int) -> bool:
    return SIMILARITY * size <= SHORT


def kmer_counts(docs: DataFrame) -> np.ndarray:
    """How often texts that meet by their prefix have a k-mer of each bucket."""

    def values(slab):
        words = Words(*text_bytes(slab.column("text")))
        found = [np.zeros(0, np.uint64)]
        for n in range(slab.num_rows):
            own = words.hash[words.of[n] : words.of[n + 1]]
            if _meets_by_prefix(len(own) - K + 1):
                found.append(labelled_kmers((own >> np.uint64(32)).astype(np.uint32)))
        return mix(np.concatenate(found))

    return bucket_counts(docs.filter(F.length("text") <= COUNTED), values, BUCKETS)


def alignment(left: np.ndarray, right: np.ndarray) -> float:
    """Similarity of two runs of labelled k-mers by their best alignment inside the band."""
    total = len(left) + len(right)
    if not len(left) or not len(right):
        return 0.0
    order = np.argsort(right)
    at = np.minimum(np.searchsorted(right, left, sorter=order), len(right) - 1)
    places = order[at]
    found = np.flatnonzero(right[places] == left)
    places = places[found]
    # A match further off the diagonal leaves too many k-mers unmatched.
    band = (1 - SIMILARITY) / (1 + SIMILARITY) * total
    near = np.abs(places - found) <= band
    places = places[near]
    matched = len(places)
    if matched / (total - matched) >= SIMILARITY and (np.diff(places) <= 0).any():
        matched = _increasing(places)
    return matched / (total - matched)


def _increasing(places: np.ndarray) -> int:
    """Length of the longest increasing subsequence."""
    tails: list[int] = []  # least end of an increasing run of each length
    for place in places.tolist():
        n = bisect_left(tails, place)
        tails[n : n + 1] = [place]
    return len(tails)


def signatures(docs: DataFrame) -> DataFrame:
    """Of (row, doc_id, text) rows: row, doc_id, same, size, keys, words.

    `same` is equal for texts of equal words, `size` the number of k-mers.
    """
    counts = docs.sparkSession.sparkContext.broadcast(kmer_counts(docs))

    def run(batches):
        for slab in slabs(batches, "text"):
            words = Words(*text_bytes(slab.column("text")))
            same, sizes, keys, kept = [], [], [], []
            rows = slab.column("row").to_pylist()
            for n in range(slab.num_rows):
                own = words.hash[words.of[n] : words.of[n + 1]]
                if not len(own):
                    same.append(b"row" + int(rows[n]).to_bytes(13, "little"))
                    sizes.append(0)
                    keys.append([])
                    kept.append(b"")
                    continue
                short = (own >> np.uint64(32)).astype(np.uint32)
                kmers = labelled_kmers(short)
                same.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                sizes.append(len(kmers))
                keys.append(meeting_keys(kmers, counts.value))
                kept.append(short.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    slab.column("row"),
                    slab.column("doc_id"),
                    pa.array(same, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(kept, pa.binary()),
                ],
                ["row", "doc_id", "same", "size", "keys", "words"],
            )

    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            docs.schema["doc_id"],
            T.StructField("same", T.BinaryType()),
            T.StructField("size", T.IntegerType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
            T.StructField("words", T.BinaryType()),
        ]
    )
    return map_arrow(docs, run, schema)


# A node is numbered by its first row, below a rank that puts nodes of many copies first.
_ROW_BITS = 53
_MOST_COPIES = 1023


def _nodes(signed: DataFrame) -> DataFrame:
    """One row per text of different words: same, node, copies and its first row."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    rank = F.lit(_MOST_COPIES) - F.least(F.col("copies") - 1, F.lit(_MOST_COPIES))
    return (
        signed.groupBy("same")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("row").alias("least"), first.alias("first"))
        .select("same", "copies", "first", (F.shiftleft(rank, _ROW_BITS) + F.col("least")).alias("node"))
    )


def _row_of(node: str):
    return F.col(node).bitwiseAND((1 << _ROW_BITS) - 1)


def _similar_size(left: str, right: str):
    return F.least(left, right) >= SIMILARITY * F.greatest(left, right)


def _met(keyed: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Candidate pairs of the small buckets, and the nodes of large ones with their buckets.

    Of a large bucket its key and its number of blocks are given. Pairs that also
    share a large bucket are left to it.
    """
    buckets = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.sum("size").alias("kmers")
    )
    buckets = cut_lineage(buckets.filter("members > 1"), "buckets")
    met = cut_lineage(keyed.join(buckets, "key"), "met")
    is_large = F.col("members") > SMALL
    pairs = cut_lineage(_all_pairs(met.filter(~is_large)).distinct(), "pairs")
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("kmers") / BLOCK_KMERS))
    buckets_of = F.array_sort(F.collect_list(F.struct("key", blocks.alias("blocks"))))
    large = met.filter(is_large).groupBy("node").agg(buckets_of.alias("buckets"))
    large = cut_lineage(large, "large")
    discard(buckets, met)
    if large.isEmpty():
        discard(large)
        return pairs, None
    keys = large.select("node", F.col("buckets.key").alias("keys"))
    left = keys.select(F.col("node").alias("a"), F.col("keys").alias("left"))
    right = keys.select(F.col("node").alias("b"), F.col("keys").alias("right"))
    both = pairs.join(left, "a", "left").join(right, "b", "left")
    rest = both.filter(~F.coalesce(F.arrays_overlap("left", "right"), F.lit(False)))
    rest = cut_lineage(rest.select("a", "b"), "pairs")
    discard(pairs)
    return rest, large


def _all_pairs(few: DataFrame) -> DataFrame:
    """All pairs of similar size in buckets of at most SMALL nodes."""
    members = F.array_sort(F.collect_list(F.struct("node", "size")))
    firsts = few.groupBy("key").agg(members.alias("m")).select("m", F.posexplode("m").alias("i", "x"))
    rest = F.slice("m", F.col("i") + 2, F.size("m"))
    pairs = firsts.select("x", F.explode(rest).alias("y")).filter(_similar_size("x.size", "y.size"))
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _verified(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs whose texts align with SIMILARITY or more."""
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node")))
    nodes = ends.distinct()
    nodes = cut_lineage(nodes.select("node", _row_of("node").alias("row")), "involved")
    words = cut_lineage(signed.select("row", "words").join(small(nodes), "row").drop("row"), "words")
    left = words.select(F.col("node").alias("a"), F.col("words").alias("left"))
    right = words.select(F.col("node").alias("b"), F.col("words").alias("right"))

    def run(batches):
        known: dict[int, np.ndarray] = {}

        def kmers(node, raw):
            if node not in known:
                if len(known) >= 64:
                    known.clear()
                known[node] = labelled_kmers(np.frombuffer(raw.as_buffer(), np.uint32))
            return known[node]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            left, right = batch.column("left"), batch.column("right")
            linked = [
                alignment(kmers(a[n], left[n]), kmers(b[n], right[n])) >= SIMILARITY
                for n in range(batch.num_rows)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    linked = map_arrow(pairs.join(left, "a").join(right, "b"), run, "a long, b long")
    linked = cut_lineage(linked, "links")
    discard(nodes, words)
    return linked


class _Block:
    """Nodes of a block with their k-mers as numbers, and the keys of their large buckets."""

    def __init__(self, members: pa.StructArray, kmers: list[np.ndarray], codes: np.ndarray):
        self.node = members.field("node").to_numpy()
        self.sizes = np.array([len(k) for k in kmers])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.codes = codes
        keys = members.field("keys")
        self.keys = keys.flatten().to_numpy()
        self.of = np.repeat(np.arange(len(self.node)), keys.value_lengths().to_numpy())


def _blocks(members: list[pa.StructArray]) -> tuple[list[_Block], int]:
    """The blocks, and how many different k-mers they have."""
    kmers = [
        [labelled_kmers(np.frombuffer(raw.as_buffer(), np.uint32)) for raw in block.field("words")]
        for block in members
    ]
    every, codes = np.unique(np.concatenate([k for own in kmers for k in own]), return_inverse=True)
    parts = np.split(codes, np.cumsum([sum(map(len, own)) for own in kmers])[:-1])
    return [_Block(*three) for three in zip(members, kmers, parts)], len(every)


def _block_links(key: int, members: list[pa.StructArray]) -> tuple[np.ndarray, np.ndarray]:
    """Linked nodes (a, b) of two blocks, or of one, of the bucket `key`.

    Pairs that share a large bucket of a smaller key are left to that one.
    """
    blocks, different = _blocks(members)
    left, right = blocks[0], blocks[-1]
    place = np.full(different, -1)
    smaller = right.keys < key
    theirs, owner = right.keys[smaller], right.of[smaller]
    found = [], []
    for n, node in enumerate(left.node):
        size = left.sizes[n]
        possible = np.minimum(size, right.sizes) >= SIMILARITY * np.maximum(size, right.sizes)
        if left is right:
            possible[: n + 1] = False
        possible[owner[np.isin(theirs, left.keys[left.of == n])]] = False
        others = np.flatnonzero(possible)
        if not len(others):
            continue
        own = left.codes[left.starts[n] : left.starts[n + 1]]
        place[own] = np.arange(size)
        linked = others[_aligned(place, size, right, others)]
        place[own] = -1
        found[0].append(np.full(len(linked), node))
        found[1].append(right.node[linked])
    if not found[0]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found[0]), np.concatenate(found[1])


def _aligned(place: np.ndarray, size: int, block: _Block, others: np.ndarray) -> np.ndarray:
    """Which of a block's nodes reach SIMILARITY by `alignment` with a text of k-mers at `place`."""
    sizes = block.sizes[others]
    first = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(others)), sizes)
    own = np.arange(len(of)) - first[of]
    places = place[block.codes[block.starts[others][of] + own]]
    total = size + sizes
    band = (1 - SIMILARITY) / (1 + SIMILARITY) * total
    near = np.flatnonzero((places >= 0) & (np.abs(places - own) <= band[of]))
    places, of = places[near], of[near]
    matched = np.bincount(of, minlength=len(others))
    linked = matched / (total - matched) >= SIMILARITY
    falls = (np.diff(places) <= 0) & (of[1:] == of[:-1])
    for n in np.unique(of[1:][falls]):
        if linked[n]:
            most = _increasing(places[np.searchsorted(of, n) : np.searchsorted(of, n + 1)])
            linked[n] = most / (total[n] - most) >= SIMILARITY
    return linked


class _Groups:
    """Links counted by node, and joined to groups."""

    def __init__(self):
        self.links: dict[int, int] = {}
        self.root: dict[int, int] = {}

    def top(self, node: int) -> int:
        root = self.root
        while root[node] != node:
            root[node] = node = root[root[node]]
        return node

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        nodes, counts = np.unique(np.concatenate([a, b]), return_counts=True)
        for node, count in zip(nodes.tolist(), counts.tolist()):
            self.links[node] = self.links.get(node, 0) + count
            self.root.setdefault(node, node)
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = self.top(x), self.top(y)
            if x != y:
                self.root[max(x, y)] = min(x, y)

    def batch(self) -> pa.RecordBatch:
        """Each linked node, the least one of its group, and its links; then starts anew."""
        nodes = list(self.links)
        columns = nodes, [self.top(n) for n in nodes], list(self.links.values())
        self.__init__()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "n"])


def _large_links(large: DataFrame, signed: DataFrame) -> DataFrame:
    """(a, b, n) of the pairs that share a large bucket: a node, one of its group, some of its links."""
    rows = large.withColumn("row", _row_of("node"))
    wide = signed.select("row", "words").join(rows, "row")
    member = F.struct("node", F.col("buckets.key").alias("keys"), "words")
    wide = wide.select("node", member.alias("member"), F.explode("buckets").alias("bucket"))
    wide = wide.select("node", "member", "bucket.key", "bucket.blocks")
    wide = wide.withColumn("block", F.pmod(F.xxhash64("key", "node"), F.col("blocks")))
    blocks = wide.groupBy("key", "block", "blocks").agg(F.collect_list("member").alias("members"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    ends = blocks.select("key", "block", "members", other)
    twos = ends.groupBy(
        "key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")
    ).agg(F.collect_list("members").alias("blocks"))
    # A block without nodes leaves the other one alone in its row.
    whole = (F.size("blocks") == 2) | (F.col("x") == F.col("y"))

    def run(batches):
        groups = _Groups()
        for batch in batches:
            for key, two in zip(batch.column("key").to_pylist(), batch.column("blocks")):
                groups.add(*_block_links(key, [two.values[n].values for n in range(len(two))]))
                if len(groups.links) > _WIDE:
                    yield groups.batch()
        yield groups.batch()

    linked = map_arrow(twos.filter(whole).select("key", "blocks"), run, "a long, b long, n long")
    return cut_lineage(linked, "links")


def near_links(signed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between nodes of similarity SIMILARITY or more, as rows (a, b, n).

    The components of (a, b) are those of the links, and each link adds 1 to the
    sum of n of both its nodes; a row with b = a only adds to that sum.
    """
    least = nodes.select("node", _row_of("node").alias("row"))
    # As many rows on both sides as there are texts: never a broadcast.
    sampled = signed.select("row", "size", "keys").filter("size > 0").join(least.hint("merge"), "row")
    sampled = cut_lineage(sampled.select("node", "size", "keys"), "sampled")
    pairs, large = _met(sampled.select("node", "size", F.explode("keys").alias("key")))
    discard(sampled)
    links = _verified(pairs, signed)
    discard(pairs)
    one = F.lit(1).cast("long").alias("n")
    every = links.select("a", "b", one).unionAll(
        links.select(F.col("b").alias("a"), F.col("b"), one)
    )
    if large is None:
        return every
    return every.unionAll(_large_links(large, signed))


def near_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None
) -> DataFrame:
    """One row per row of `docs`: row, doc_id, class_id, class_size, n_links, kept.

    `class_id` is the smallest id of the class, whose row is the one kept;
    `n_links` counts the verified links of the row's text to other texts.
    """
    columns = {"doc_id": id_col, "text": text_col} | ({"row": row_col} if row_col else {})
    rows = picked(docs, **columns)
    if not row_col:
        rows = rows.withColumn("row", F.monotonically_increasing_id())
    signed = cut_lineage(signatures(rows.select("row", "doc_id", "text")), "signatures")
    nodes = cut_lineage(_nodes(signed), "nodes")
    links = near_links(signed, nodes)
    degree = links.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links"))
    labelled = (
        nodes.join(components(links), "node", "left")
        .join(degree, "node", "left")
        .select(
            "same",
            "copies",
            "first",
            F.coalesce("root", "node").alias("root"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        )
    )
    labelled = cut_lineage(labelled, "labelled")
    classes = labelled.groupBy("root").agg(
        F.min("first").alias("first"), F.sum("copies").alias("class_size")
    )
    classes = cut_lineage(classes, "classes")
    labelled = labelled.select("same", "n_links", "root").join(classes, "root")
    labelled = cut_lineage(labelled.select("same", "n_links", "first", "class_size"), "labelled")
    return (
        signed.select("row", "doc_id", "same")
        .join(labelled, "same")
        .select(
            "row",
            "doc_id",
            F.col("first.doc_id").alias("class_id"),
            "class_size",
            "n_links",
            (F.col("row") == F.col("first.row")).alias("kept"),
        )
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each class, and all its columns."""
    rows, row = with_row(docs)
    dropped = near_classes(rows, id_col, text_col, row).filter(~F.col("kept"))
    return without(rows, row, dropped.select(F.col("row").alias(row)))
