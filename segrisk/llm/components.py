"""Connected components of links by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrisk.session import stored


#: Links (1.6 MB) that one task may join.
FEW = 100_000


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least node of the component of every node of the links."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "component"]
    )


def _towards_least(edges: DataFrame, larger: bool) -> DataFrame:
    """Every node links its larger (or smaller) neighbours to the least of its neighbours and itself."""
    both = edges if not larger else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if larger:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter("a > b").distinct()


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) of every node of links (a, b).

    Each round is written to the shared folder, which cuts the lineage. Stars end
    as they are; a round at least shortens every longer path, so the number of
    rounds grows with the logarithm of the longest one. Minima combine before
    the shuffle, and a node with very many links is split by the skew join. Up
    to ``FEW`` links, a number that is measured, need no rounds: one task joins them.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    edges = stored(edges, "links")
    state = _digest(edges)
    if state[0] <= FEW:
        return edges.coalesce(1).mapInArrow(_union, "node long, component long")
    while True:
        edges = stored(_towards_least(_towards_least(edges, True), False), "links")
        before, state = state, _digest(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _digest(edges: DataFrame) -> tuple:
    """Number of distinct links and the sum of their hashes: equal for equal tables."""
    low = F.col("h").bitwiseAND(F.lit((1 << 40) - 1))
    high = F.shiftrightunsigned("h", 40)
    hashed = edges.select(F.xxhash64("a", "b").alias("h"))
    return tuple(hashed.agg(F.count("h"), F.sum(low), F.sum(high)).first())
