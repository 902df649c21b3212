"""Connected components of a link table, and of the links inside one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import cut


class Forest:
    """Groups of numbers below ``n`` under links given in arrays; the smallest number of a group is its root."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        found = self.parent[at]
        while True:
            higher = self.parent[found]
            if np.array_equal(higher, found):
                self.parent[at] = found
                return found
            found = higher

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def all_roots(self) -> np.ndarray:
        return self.roots(np.arange(len(self.parent)))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """The smallest node of each linked node's group: ``a, b`` (any orderable type) to ``node, root``.

    Alternates large-star and small-star steps: every node hands its larger neighbours, then its smaller ones, to the
    smallest it knows, until no link changes. A step is two minimum aggregations, which combine before the shuffle, and
    joins that adaptive execution may split, so a node with very many links is no group of its own. Each round is
    written to shared storage; the driver sees a count and a checksum.

    Links of a node to itself and links with a null are ignored; repeated links and either order are fine. Nodes without
    a link are not in the result.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), "a", "b")
    edges = edges.filter("a IS NOT NULL AND b IS NOT NULL AND u <> v").select("u", "v").distinct()
    edges, mark = cut(edges, name), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(moved.union(least).distinct(), name)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == mark:
            break
        mark = now
    # Every link now goes from a node to its root.
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.union(edges.select(F.col("u").alias("node"), F.col("v").alias("root")))
