"""Connected components of an undirected graph by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import pin

EDGES_AT_ONCE = 1 << 16


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the same components: those of a task become stars, some hundred thousand edges at a time."""

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = [np.concatenate([batch.column(k).to_numpy() for batch in held]) for k in (0, 1)]
        nodes, place = np.unique(np.concatenate(ends), return_inverse=True)
        a, b = np.split(place, 2)
        root, before = np.arange(len(nodes)), None
        while not np.array_equal(root, before):
            before = root.copy()
            least = np.minimum(before[a], before[b])
            np.minimum.at(root, before[a], least)
            np.minimum.at(root, before[b], least)
            while not np.array_equal(root, root[root]):
                root = root[root]
        leaf = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[root[leaf]]), pa.array(nodes[leaf])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= EDGES_AT_ONCE:
                yield stars(held)
                held = []
        if held:
            yield stars(held)

    return edges.mapInArrow(run, "a bigint, b bigint")


def _around(edges: DataFrame) -> DataFrame:
    """(u, m, top, up): the smallest of a node and its neighbours, the largest smaller one, and whether any is larger."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    return both.groupBy("u").agg(
        F.least(F.min("v"), F.col("u")).alias("m"), F.max(F.when(F.col("v") < F.col("u"), F.col("v"))).alias("top"), F.max(F.col("v") > F.col("u")).alias("up")
    )


def _large_star(edges: DataFrame, around: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    linked = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).join(around.select("u", "m"), "u")
    return linked.select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = pin(down.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "stars")
    return (
        down.join(least, "u")
        .select(F.col("m").alias("a"), F.col("v").alias("b"))
        .union(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
        .filter("a <> b")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b); root is the smallest node it can reach.

    Loops, repeated edges and edges in both directions are allowed; an empty frame gives an empty
    frame. Tasks contract the edges they have before any are exchanged. Each round is pinned in the shared
    folder, and the rounds end when every node but the roots has one neighbour, its root. A node with many
    neighbours is met by partial aggregates and by joins whose large side can be split; no group is collected.
    """
    edges = edges.filter("a <> b").select(
        F.least("a", "b").cast("bigint").alias("a"), F.greatest("a", "b").cast("bigint").alias("b")
    )
    edges = pin(_contracted(edges), "edges")
    # As many tasks as there are shares of edges.
    tasks = 1 + edges.count() // EDGES_AT_ONCE
    edges = pin(_contracted(edges.coalesce(tasks)), "edges")
    while True:
        around = pin(_around(edges).coalesce(tasks), "stars")
        if not around.filter("top <> m or (top is not null and up)").limit(1).count():
            return around.select(F.col("u").alias("node"), F.col("m").alias("root"))
        edges = pin(_large_star(edges, around).distinct(), "edges")
        edges = pin(_small_star(edges).distinct(), "edges")
