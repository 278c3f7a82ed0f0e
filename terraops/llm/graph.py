"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraops.llm.common import with_figures, written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b: long) that is linked: root is the smallest node it reaches.

    Roots themselves are left out, as are loops; repeated edges count once. Every round is written to the
    shared folder, so plans stay short and a lost executor costs one round at most. Only sums come to the
    driver, and the edges of a node with very many are not met in one task. The number of rounds grows with the
    logarithm of the number of nodes.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n"))
        large = with_figures(both, least, "u", 2 * state[0]).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        moved = with_figures(large, lowest, "a", state[0]).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(moved.union(lowest.select("a", "m")).distinct(), "edges")
        state, before = _state(edges), state
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


class Forest:
    """Groups of the rows of one task, joined as links are found; each is known by its smallest row."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = k = self.parent[self.parent[k]]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def join_all(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins a[k] with b[k] for all k: first one link of each b, then what these have not joined yet."""
        first = np.unique(b, return_index=True)[1]
        for i, j in zip(a[first].tolist(), b[first].tolist(), strict=True):
            self.join(i, j)
        roots = self.roots()
        open_ = roots[a] != roots[b]
        for i, j in np.unique(np.stack([roots[a[open_]], roots[b[open_]]], 1), axis=0).tolist():
            self.join(i, j)

    def roots(self) -> np.ndarray:
        return np.array([self.find(k) for k in range(len(self.parent))], np.int64)
