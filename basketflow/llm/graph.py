"""Connected components of an edge table, and of the links found inside one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import Stages


class LocalRoots:
    """Components among n local nodes; every node's root is the smallest node of its component.

    Union-find over whole rows of links: a link walks and shortens the paths of its own nodes only.
    """

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def _roots_of(self, nodes: np.ndarray) -> np.ndarray:
        up = self.parent[nodes]
        while True:
            higher = self.parent[up]
            if np.array_equal(higher, up):
                return up
            self.parent[nodes] = up = higher

    def link(self, node: int, others: np.ndarray) -> None:
        nodes = np.append(others, node)
        roots = self._roots_of(nodes)
        self.parent[roots] = self.parent[nodes] = roots.min()

    @property
    def root(self) -> np.ndarray:
        return self._roots_of(np.arange(len(self.parent)))

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """A spanning star of every component: (node, root)."""
        root = self.root
        nodes = np.flatnonzero(root != np.arange(len(root)))
        return nodes, root[nodes]


def components(edges: DataFrame, stages: Stages, name: str = "components") -> DataFrame:
    """(node, root): the smallest node that edges (a, b) connect a node to; nodes without edges are absent.

    Alternating large-star and small-star rounds (Kiveris et al., 2014). A hub is reduced to its
    smallest neighbour by a combined aggregate, and the joins have one row per node on one side, so
    a skewed hub can be split. Each round is a stage table; null ends are dropped.
    """
    hi_lo = edges.where("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    current, before, turn = stages.write(hi_lo, f"{name}-0"), None, 0
    while True:
        both = current.union(current.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        turn += 1
        new = stages.write(small.union(least.select("hi", "m")).distinct(), f"{name}-{turn}")
        stages.drop(f"{name}-{turn - 1}")
        stamp = tuple(new.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(hi, lo))")).first())
        if stamp == before:
            return new.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        current, before = new, stamp
