"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become pieces of at most `capacity` tokens. Full pieces are sequences
already. The others are dealt by hash into blocks of about `BLOCK` pieces, and
each block is packed by `ISLANDS` populations that evolve apart, as rows of a
DataFrame: a child takes whole well-filled bins from one parent, loses the
other parent's bins that hold any of the same pieces, and best-fits the pieces
displaced by that. After each epoch the best packing of an island moves to the
next island of its block (a join of islands). A block stops early once it has
as few bins as its tokens need.

The emptiest bins of each block (a tenth of them at most) are dissolved and
their pieces pooled into new blocks, level by level, until one block is left;
so blocks do not each end with a half-empty bin. Every piece is placed exactly
once, and each task holds a few blocks at a time, whatever the input's size.

Null texts are empty: a single end id. Repeated rows are packed like any other
rows. An empty table gives an empty result. Equal input files give equal
packings: all random choices follow from the block, island and epoch.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterprep.llm.rows import map_arrow
from clusterprep.llm.token_pieces import token_pieces
from clusterprep.session import cut_lineage

CAPACITY = 2048
BLOCK = 2000
ISLANDS = 3
POPULATION = 6
EPOCHS = 2
CHILDREN = 12  # per island and epoch
REPACKED = 0.1  # share of a block's bins that may be dissolved into the next level
STATES_PER_TASK = 8


class Packing:
    """Bins of piece numbers, with the room left in each."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []

    def add(self, members: list[int], room: int) -> None:
        self.bins.append(members)
        self.room.append(room)

    def best_fit(self, pieces: list[int], lengths: list[int]) -> None:
        """Place pieces in order, each into the fullest bin that holds it, or a new one."""
        by_room: dict[int, list[int]] = {}
        rooms = 0  # bit r is set if a bin has room r
        for number, room in enumerate(self.room):
            if room:
                by_room.setdefault(room, []).append(number)
                rooms |= 1 << room
        for piece in pieces:
            need = lengths[piece]
            enough = rooms >> need
            if enough:
                room = need + (enough & -enough).bit_length() - 1
                number = by_room[room].pop()
                if not by_room[room]:
                    rooms ^= 1 << room
            else:
                room, number = self.capacity, len(self.bins)
                self.add([], room)
            self.bins[number].append(piece)
            room -= need
            self.room[number] = room
            if room:
                by_room.setdefault(room, []).append(number)
                rooms |= 1 << room

    def cost(self) -> tuple[int, int]:
        """Fewer bins are better, then fuller ones beside emptier ones."""
        return len(self.bins), -sum(room * room for room in self.room)

    def as_numbers(self, pieces: int) -> bytes:
        """Bin number of each piece."""
        numbers = np.zeros(pieces, np.int32)
        for number, members in enumerate(self.bins):
            numbers[members] = number
        return numbers.tobytes()

    @classmethod
    def from_numbers(cls, numbers: bytes, lengths: list[int], capacity: int) -> Packing:
        bins = np.frombuffer(numbers, np.int32).tolist()
        packing = cls(capacity)
        for _ in range(max(bins, default=-1) + 1):
            packing.add([], capacity)
        for piece, number in enumerate(bins):
            packing.bins[number].append(piece)
            packing.room[number] -= lengths[piece]
        return packing


def crossover(mother: Packing, father: Packing, lengths: list[int], rng: random.Random) -> Packing:
    """Inject well-filled bins of the father, drop bins that share a piece, best-fit the rest."""
    order = sorted(range(len(father.bins)), key=father.room.__getitem__)
    filled = order[: len(order) // 2 + 1]
    chosen = rng.sample(filled, max(1, len(filled) // 3))
    child = Packing(mother.capacity)
    taken: set[int] = set()
    for number in chosen:
        child.add(list(father.bins[number]), father.room[number])
        taken.update(father.bins[number])
    displaced: list[int] = []
    for members, room in zip(mother.bins, mother.room):
        if taken.isdisjoint(members):
            child.add(list(members), room)
        else:
            displaced += [piece for piece in members if piece not in taken]
    _mutate(child, displaced, rng)
    displaced.sort(key=lengths.__getitem__, reverse=True)
    child.best_fit(displaced, lengths)
    return child


def _mutate(packing: Packing, displaced: list[int], rng: random.Random) -> None:
    """Dissolve the emptiest bin and a few others."""
    if len(packing.bins) < 4:
        return
    numbers = {max(range(len(packing.bins)), key=packing.room.__getitem__)}
    numbers.update(rng.sample(range(len(packing.bins)), 3))
    for number in sorted(numbers, reverse=True):
        displaced += packing.bins.pop(number)
        packing.room.pop(number)


def first_packing(lengths: list[int], capacity: int, rng: random.Random, disorder: float) -> Packing:
    """Best fit in decreasing order, each length blurred by up to the share `disorder`."""
    keys = [length * (1 - disorder * rng.random()) for length in lengths]
    packing = Packing(capacity)
    packing.best_fit(sorted(range(len(lengths)), key=keys.__getitem__, reverse=True), lengths)
    return packing


def evolve(population: list[Packing], lengths: list[int], rng: random.Random, children: int) -> list[Packing]:
    """The population after some children, best first; each replaces the worst if it is better."""
    least = -(-sum(lengths) // population[0].capacity)
    population.sort(key=Packing.cost)
    for _ in range(children):
        if len(population[0].bins) <= least:
            break
        mother, father = rng.sample(population, 2)
        child = crossover(mother, father, lengths, rng)
        if child.cost() < population[-1].cost():
            population[-1] = child
            population.sort(key=Packing.cost)
    return population


_STATE = "block long, island int, keys array<long>, lengths array<int>, population array<binary>, guest binary, bins int, spread double"


def _states(batch: pa.RecordBatch):
    for n in range(batch.num_rows):
        yield from batch.slice(n, 1).to_pylist()


def _evolve_rows(capacity: int, epoch: int, batches):
    for batch in batches:
        populations, costs = [], []
        for state in _states(batch):
            lengths = state["lengths"]
            rng = random.Random(f"{state['block']}/{state['island']}/{epoch}")
            if state["population"]:
                known = state["population"][:-1] + [state["guest"] or state["population"][-1]]
                population = [Packing.from_numbers(p, lengths, capacity) for p in known]
            else:
                blur = [0.0, *[0.05 * (1 + state["island"]) * n for n in range(1, POPULATION)]]
                population = [first_packing(lengths, capacity, rng, b) for b in blur]
            population = evolve(population, lengths, rng, CHILDREN)
            populations.append([p.as_numbers(len(lengths)) for p in population])
            costs.append(population[0].cost())
        columns = [batch.column(name) for name in ("block", "island", "keys", "lengths")]
        population = pa.array(populations, pa.list_(pa.binary()))
        best = pa.array([p[0] for p in populations], pa.binary())
        bins = pa.array([c[0] for c in costs], pa.int32())
        spread = pa.array([float(c[1]) for c in costs], pa.float64())
        names = ["block", "island", "keys", "lengths", "population", "guest", "bins", "spread"]
        yield pa.RecordBatch.from_arrays([*columns, population, best, bins, spread], names)


def _placed_rows(capacity: int, last: bool, batches):
    """A row per piece: block, bin, key, offset, and whether its bin is to be packed again."""
    names = ["block", "bin", "key", "length", "offset", "loose"]
    for batch in batches:
        for state in _states(batch):
            lengths, keys = state["lengths"], state["keys"]
            packing = Packing.from_numbers(state["best"], lengths, capacity)
            again = 0 if last else int(len(packing.bins) * REPACKED) + 1
            emptiest = sorted(range(len(packing.bins)), key=packing.room.__getitem__, reverse=True)[:again]
            loose = {number for number in emptiest if packing.room[number]}
            rows = []
            for number, members in enumerate(packing.bins):
                at = 0
                for piece in members:
                    rows.append((state["block"], number, keys[piece], lengths[piece], at, number in loose))
                    at += lengths[piece]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_()]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)


def pack_level(pieces: DataFrame, capacity: int, level: int, blocks: int) -> DataFrame:
    """Pack (key, length) rows in so many blocks; see `_placed_rows` for the columns."""
    states = -(-blocks * ISLANDS // STATES_PER_TASK)
    dealt = F.pmod(F.xxhash64(F.lit(level), "key"), F.lit(blocks)).cast("long")
    members = F.sort_array(F.collect_list(F.struct("key", F.col("length").cast("int").alias("length"))))
    islands = (
        pieces.groupBy(dealt.alias("block"))
        .agg(members.alias("members"))
        .select(
            "block",
            F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
            F.col("members.key").alias("keys"),
            F.col("members.length").alias("lengths"),
            F.array().cast("array<binary>").alias("population"),
            F.lit(None).cast("binary").alias("guest"),
            F.lit(None).cast("int").alias("bins"),
            F.lit(None).cast("double").alias("spread"),
        )
    )
    for epoch in range(EPOCHS):
        spread = islands.repartition(states, "block", "island")
        evolved = map_arrow(spread, lambda b, e=epoch: _evolve_rows(capacity, e, b), _STATE)
        islands = cut_lineage(evolved, "islands")
        if epoch < EPOCHS - 1:
            elite = islands.select(
                "block", ((F.col("island") + 1) % ISLANDS).alias("island"), "guest"
            )
            islands = islands.drop("guest").join(elite, ["block", "island"]).select(*islands.columns)
    best = islands.groupBy("block").agg(
        F.min_by(
            F.struct("keys", "lengths", F.col("guest").alias("best")),
            F.struct("bins", "spread", "island"),
        ).alias("of")
    )
    return map_arrow(
        best.select("block", "of.*"),
        lambda b: _placed_rows(capacity, blocks == 1, b),
        "block long, bin long, key long, length int, offset long, loose boolean",
    )


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """(key, sequence_id, offset) of written (key, length) rows with unique keys."""
    full = pieces.filter(F.col("length") >= capacity)
    done = [full.select("key", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    rest = pieces.filter(F.col("length") < capacity).select("key", "length")
    count, level = rest.count(), 0
    blocks = -(-count // block)
    while count:
        level += 1
        placed = cut_lineage(pack_level(rest, capacity, level, blocks), "packed")
        # Keys are at least 0, so sequences of packed bins get numbers below 0.
        sequence = -(
            F.lit(level).cast("long") * (1 << 57) + F.col("block") * (1 << 20) + F.col("bin") + 1
        )
        done.append(placed.filter("NOT loose").select("key", sequence.alias("sequence_id"), "offset"))
        rest = placed.filter("loose").select("key", "length")
        count = rest.count()
        # Half the blocks at most: very small pieces may all have been in bins to be dissolved.
        blocks = min(-(-count // block), max(1, blocks // 2))
    every = done[0]
    for more in done[1:]:
        every = every.unionAll(more)
    return every


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    pieces = cut_lineage(token_pieces(docs, vocabulary, capacity, id_col, text_col, with_ids), "pieces")
    return pieces.join(pack_pieces(pieces, capacity), "key").drop("key")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences of `pack_documents(..., with_ids=True)`: ids, lengths and documents.

    A sequence holds at most `capacity` tokens, so its pieces are few.
    """
    members = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    ids = F.aggregate("m.ids", F.lit(b""), lambda all_, more: F.concat(all_, more))
    return (
        packed.groupBy("sequence_id")
        .agg(members.alias("m"))
        .select(
            "sequence_id",
            ids.alias("ids"),
            F.col("m.length").alias("lengths"),
            F.col("m.doc_id").alias("doc_ids"),
            F.col("m.piece").alias("pieces"),
        )
    )
