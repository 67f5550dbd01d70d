"""Approximate nearest neighbours: a vantage-point tree for each shard.

A node splits its rows at the median distance to a vantage point and keeps the range of distances on either side. By the triangle inequality
a side can hold nothing nearer than its range is from d(q, vantage); a side, or a whole shard by its pivot and radius, is skipped when factor times that gap
exceeds the k-th distance so far. Factor 1 is exact search; a greater one skips more. In many dimensions without clusters all distances are alike, and a
factor that still finds nine in ten skips little; the README gives both figures. Zero vectors take no part besides those that vectors.py leaves out.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors

LEAF = 64
FACTOR = 5.0


@dataclass
class VPTree:
    ids: np.ndarray
    points: np.ndarray
    nodes: list  #: (rows,) of a leaf, or (vantage row, [(low, high, child), ...])
    computed: int = 0


def distances(points: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - q) ** 2).sum(-1))


def build(ids: np.ndarray, matrix: np.ndarray, longest2: float = 0.0, leaf: int = LEAF) -> VPTree:
    points = matrix.astype(np.float64)
    tree = VPTree(ids, points, [])
    rng = np.random.default_rng(len(ids))

    def load(rows: np.ndarray) -> int:
        at = len(tree.nodes)
        if len(rows) <= leaf:
            tree.nodes.append((rows,))
            return at
        tree.nodes.append(None)
        # the vantage point with the widest spread of distances among a few
        tries = rng.choice(rows, min(5, len(rows)), replace=False)
        some = points[rng.choice(rows, min(100, len(rows)), replace=False)]
        vantage = max(tries, key=lambda r: distances(some, points[r]).std())
        d = distances(points[rows], points[vantage])
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        sides = [(float(d[part[0]]), float(d[part[-1]]), load(np.sort(rows[part]))) for part in (order[:half], order[half:])]
        tree.nodes[at] = (int(vantage), sides)
        return at

    load(np.arange(len(ids)))
    return tree


def find(tree: VPTree, query_id: int, query: np.ndarray, k: int, so_far: float | None = None, factor: float = FACTOR) -> tuple[np.ndarray, np.ndarray]:
    q = query.astype(np.float64)
    slack = 1e-9 * (1.0 + float(np.sqrt((q**2).sum())))
    best_ids, best, limit = np.zeros(0, np.int64), np.zeros(0), np.inf if so_far is None else so_far
    heap: list[tuple[float, int]] = [(0.0, 0)]
    while heap and heap[0][0] * factor <= limit + slack:
        least, at = heapq.heappop(heap)
        node = tree.nodes[at]
        if len(node) == 1:
            d = distances(tree.points[node[0]], q)
            tree.computed += len(d)
            ids = tree.ids[node[0]]
            keep = (ids != query_id) & (d <= limit)
            if keep.any():
                best_ids, best = np.concatenate([best_ids, ids[keep]]), np.concatenate([best, d[keep]])
                order = np.lexsort((best_ids, best))[:k]
                best_ids, best = best_ids[order], best[order]
                if len(best) == k:
                    limit = min(limit, float(best[-1]))
            continue
        to = float(distances(tree.points[node[0]], q))
        tree.computed += 1
        for low, high, child in node[1]:
            gap = max(least, low - to, to - high)
            if gap * factor <= limit + slack:
                heapq.heappush(heap, (gap, child))
    return best_ids, best


def nearest(df: DataFrame, *, k: int = 10, factor: float = FACTOR, query_every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int | None = None) -> DataFrame:
    """The k nearest rows found for each query row: query_id, rank, vec_id, score (Euclidean distance)."""
    rows = (
        df.where(vectors.finite(vector_col))
        .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vector_col, lambda x: x.cast("double")).alias("v"))
        .where(F.exists("v", lambda x: x != 0))
    )
    search = lambda tree, query_id, query, k, so_far: find(tree, query_id, query, k, so_far, factor)
    return vectors.search(rows, k, build, search, query_every, "double", ascending=True, distance=lambda scores, q2, longest2: scores, relax=factor, shard_rows=shard_rows)
