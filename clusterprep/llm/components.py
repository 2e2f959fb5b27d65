"""Connected components of a graph of integer nodes, as joins and minima.

Alternates two steps until the edges stop changing: every node's larger
neighbours are linked to its least neighbour, then its smaller ones. The graph
becomes a star around the least node of each component in a number of rounds
that grows with the logarithm of its size. Minima are combined per task. The
edges of a node with very many neighbours (a root late in the rounds) never
meet in one task: where an edge needs its node's minimum, the minima of hubs are
broadcast, and only the others are joined by a shuffle. A hub has more than
`HUB` edges and more than its share of `BROADCAST_ROWS`, so there are at most that
many hubs, by arithmetic; if there are no more nodes than that, all are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterprep.llm.rows import BROADCAST_ROWS
from clusterprep.session import cut_lineage, discard

HUB = 1000


def components(edges: DataFrame, most: int = BROADCAST_ROWS, hub: int = HUB) -> DataFrame:
    """(node, root) for every node of the (a, b) edges but the roots; root is the least node."""
    current = cut_lineage(_oriented(edges), "edges")
    state = _fingerprint(current)
    while state[0]:
        last = current
        # Each edge counts for two nodes at most.
        hubs_from = -1 if 2 * state[0] <= most else max(hub, 2 * state[0] // most)
        current = cut_lineage(_small_star(_large_star(last, hubs_from), hubs_from), "edges")
        discard(last)
        before, state = state, _fingerprint(current)
        if state == before:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node to the smaller one."""
    return edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).filter("a <> b").distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame, hubs_from: int) -> DataFrame:
    """The edges with the least neighbour m of their node a; -1 broadcasts all minima."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree"))
    hubs = F.broadcast(least.filter(F.col("degree") > hubs_from).drop("degree"))
    found = edges.join(hubs, "a")
    if hubs_from < 0:
        return found
    rest = least.filter(F.col("degree") <= hubs_from).drop("degree")
    return found.unionAll(edges.join(hubs, "a", "left_anti").join(rest, "a"))


def _large_star(edges: DataFrame, hubs_from: int) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    larger = _with_least(both, hubs_from).filter("b > a")
    return _oriented(larger.select(F.col("b").alias("a"), F.least("a", "m").alias("b")))


def _small_star(edges: DataFrame, hubs_from: int) -> DataFrame:
    found = _with_least(edges, hubs_from)
    linked = found.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(linked.unionAll(found.select("a", F.col("m").alias("b"))))
