"""Connected components of an edge table by alternating star contraction.

No step gathers the edges of one node: minima come from partial aggregates and
edges are rewritten by joins, so a hub of any degree is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import discard, map_arrow, materialize, regrouped

#: Nodes that one task holds before it writes its forest out and starts anew.
FOREST_NODES = 1_000_000


class Forest:
    """Union-find whose root is the smallest node."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = parent.setdefault(x, x)
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a < b:
            self.parent[b] = a
        elif b < a:
            self.parent[a] = b

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        for a, b in zip(left.tolist(), right.tolist()):
            self.union(a, b)

    def drain(self) -> pa.RecordBatch:
        """Star edges (node, root) of what was added; the forest is empty then."""
        nodes = [x for x in self.parent if self.find(x) != x]
        roots = [self.parent[x] for x in nodes]
        self.parent = {}
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["src", "dst"])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in regrouped(batches):
        forest.add(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False))
        if len(forest.parent) > FOREST_NODES:
            yield forest.drain()
    yield forest.drain()


def _is_star(edges: DataFrame) -> bool:
    """True if every node has one role and every leaf one centre."""
    roles = edges.select(F.col("src").alias("n"), F.col("dst").alias("c")).unionByName(
        edges.select(F.col("dst").alias("n"), F.lit(None).cast("long").alias("c"))
    )
    bad = (
        roles.groupBy("n")
        .agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("c").alias("out"), F.count("*").alias("all"))
        .where("lo <> hi OR (out > 0 AND out < all)")
    )
    return bad.limit(1).count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """Component of each node that an edge touches.

    ``edges`` has long columns src, dst; self loops, repeats and either
    direction are allowed, null ends are dropped. Returns (node, component),
    component being the smallest node reachable, itself included. An empty
    edge table gives an empty result.
    """
    clean = edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst")
    current = materialize(map_arrow(clean, _contract, "src long, dst long"))
    while not _is_star(current):
        both = current.select(F.col("src").alias("u"), F.col("dst").alias("v")).unionByName(
            current.select(F.col("dst").alias("u"), F.col("src").alias("v"))
        )
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(least, "u")
        small = pairs.select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("src"), F.col("m").alias("dst")
        ).distinct()
        following = materialize(small)
        discard(current)
        current = following
    leaves = current.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    centres = current.select(F.col("dst").alias("node"), F.col("dst").alias("component"))
    return leaves.unionByName(centres).distinct()
