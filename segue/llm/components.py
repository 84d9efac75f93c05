"""Connected components of a graph of links, by rounds of joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segue.session import stash


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that a link names; component is the smallest node reachable.

    Large-star and small-star rounds: each node hands its neighbours over to the smallest one it knows, until every node
    hangs on the smallest of its component. Rounds grow with the logarithm of the longest path. Smallest neighbours are
    aggregates, so a hub is summed before the shuffle, and the joins by node can be split where a hub is hot. Each
    round is written to the shared folder. Links may repeat and may lie in either direction; NULL ends count for nothing.
    """
    whole = links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = whole.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
    edges = stash(edges.where("low < high").distinct(), "links")
    state = None
    while True:
        # large star: every neighbour above a node moves to the node's smallest neighbour, or to the node itself
        both = edges.unionByName(edges.select(F.col("high").alias("low"), F.col("low").alias("high"))).select(F.col("low").alias("u"), F.col("high").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("m").alias("low"), F.col("v").alias("high"))
        large = large.where("low < high").distinct()
        # small star: every node and its smaller neighbours move to the smallest of these
        small = large.groupBy("high").agg(F.min("low").alias("m"))
        moved = large.join(small, "high")
        moved = moved.select(F.explode(F.array(
            F.struct(F.col("m").alias("low"), F.col("low").alias("high")), F.struct(F.col("m").alias("low"), F.col("high")),
        )).alias("e")).select("e.*").where("low < high").distinct()
        edges = stash(moved, "links")
        # a sum of hashes tells whether a round has changed any edge
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(roots)


class Forest:
    """Union-find over the numbers 0..n-1 of one task's rows, fed with arrays of links."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        found = self.parent[at]
        while True:
            above = self.parent[found]
            if np.array_equal(above, found):
                self.parent[at] = found
                return found
            found = above

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the trees of a[i] and b[i]; links inside one tree, most of a dense group's, cost no loop."""
        if not len(a):
            return
        a, b = self.roots(a), self.roots(b)
        apart = a != b
        size = len(self.parent)
        pairs = np.unique(np.minimum(a, b)[apart] * size + np.maximum(a, b)[apart])
        for x, y in zip((pairs // size).tolist(), (pairs % size).tolist(), strict=True):
            x, y = self.root(x), self.root(y)
            self.parent[max(x, y)] = min(x, y)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(root, node) for every node that is not a root: enough links to hold each tree together."""
        nodes = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return self.roots(nodes), nodes
