"""Exact top-k by inner product: M-trees with best-first search.

Vectors become integers, floor(1024 * x). A further coordinate that lifts all vectors to one length turns the greatest inner product
into the least Euclidean distance, so a metric tree serves: |q - o|^2 = |q|^2 + L^2 - 2 q.o. Pages hold up to PAGE entries;
a routing entry has a pivot, a covering radius and its distance to the page's own pivot. A page is opened in order of its least possible distance;
before a distance is computed, |d(q, parent) - d(entry, parent)| - radius must be within the k-th distance. Bounds get a slack above their rounding
error, and scores are exact: in doubles where no partial sum can pass 2**53, else as Python's integers. A score that a long can't hold raises OverflowError.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors

PAGE = 256
SCALE = 1024
EXACT = 2.0**53


@dataclass
class Page:
    leaf: bool
    rows: np.ndarray  #: of the matrix: pivots, or the objects of a leaf
    parent: np.ndarray  #: their distances to the page's own pivot
    radii: np.ndarray = field(default_factory=lambda: np.zeros(0))
    children: list[int] = field(default_factory=list)


@dataclass
class MTree:
    ids: np.ndarray
    ints: np.ndarray  #: int64 where doubles can't hold them
    norm2: float
    pages: list[Page]
    computed: int = 0  #: distances computed in searches


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - to) ** 2).sum(-1))


def build(ids: np.ndarray, matrix: np.ndarray, longest2: float | None = None, page: int = PAGE) -> MTree:
    """Bulk load: seeds share out the rows of a page that is too full, until all fit. longest2: the squared length to lift to, the rows' own greatest by default."""
    points = matrix.astype(np.float64)
    norm2 = max(float((points**2).sum(1).max()), longest2 or 0.0)
    lifted = vectors.lifted(points, norm2)
    tree = MTree(ids, points if norm2 < EXACT else matrix.astype(np.int64), norm2, [])
    rng = np.random.default_rng(len(ids))

    def load(rows: np.ndarray, pivot: np.ndarray | None) -> int:
        own = (lambda r: distances(lifted[r], pivot)) if pivot is not None else (lambda r: np.zeros(len(r)))
        at = len(tree.pages)
        if len(rows) <= page:
            tree.pages.append(Page(True, rows, own(rows)))
            return at
        tree.pages.append(Page(False, rows[:0], np.zeros(0)))
        seeds = np.sort(rng.choice(rows, min(page, -(-len(rows) // (page // 2))), replace=False))
        to_seeds = np.stack([distances(lifted[rows], lifted[s]) for s in seeds], 1)
        nearest = to_seeds.argmin(1)
        if np.bincount(nearest).max() == len(rows):
            nearest = np.arange(len(rows)) * len(seeds) // len(rows)
        radii, kept, children = [], [], []
        for i, s in enumerate(seeds):
            mine = nearest == i
            if mine.any():
                radii.append(to_seeds[mine, i].max())
                kept.append(s)
                children.append(load(rows[mine], lifted[s]))
        kept = np.array(kept)
        tree.pages[at] = Page(False, kept, own(kept), np.array(radii), children)
        return at

    load(np.arange(len(ids)), None)
    return tree


def products(ints: np.ndarray, query: np.ndarray, bound2: float) -> np.ndarray:
    """Exact inner products; bound2: of the product of both squared lengths."""
    if bound2 < EXACT**2 and ints.dtype == np.float64:
        return ints @ query.astype(np.float64)
    exact = ints.astype(np.int64).astype(object) @ query.astype(np.int64).astype(object)
    if any(abs(x) >= 2**63 for x in exact):
        raise OverflowError("an inner product is beyond the range of a long")
    return exact.astype(np.int64)


def find(tree: MTree, query_id: int, query: np.ndarray, k: int, so_far: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The k best of the tree; so_far: the k-th best score known, below which nothing is wanted."""
    q = query.astype(np.float64)
    q2 = float((q**2).sum())
    slack = 1e-6 * (1.0 + np.sqrt(q2 + tree.norm2))
    to = lambda scores: np.sqrt(np.maximum(q2 + tree.norm2 - 2 * scores.astype(np.float64), 0))
    best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.float64 if tree.ints.dtype == np.float64 else np.int64)
    limit = np.inf if so_far is None else float(to(np.float64(so_far)))
    heap: list[tuple[float, int, float]] = [(0.0, 0, -1.0)]
    while heap and heap[0][0] <= limit + slack:
        _, at, to_parent = heapq.heappop(heap)
        page = tree.pages[at]
        near = np.arange(len(page.rows))
        if to_parent >= 0:
            near = np.flatnonzero(np.abs(to_parent - page.parent) - (0 if page.leaf else page.radii) <= limit + slack)
        scores = products(tree.ints[page.rows[near]], query, q2 * tree.norm2)
        tree.computed += len(near)
        if page.leaf:
            ids = tree.ids[page.rows[near]]
            keep = ids != query_id
            if len(best) == k:
                keep &= scores >= best[-1]
            if keep.any():
                best_ids, best = np.concatenate([best_ids, ids[keep]]), np.concatenate([best, scores[keep]])
                order = np.lexsort((best_ids, -best))[:k]
                best_ids, best = best_ids[order], best[order]
                if len(best) == k:
                    limit = min(limit, float(to(best[-1])))
        else:
            d = to(scores)
            least = np.maximum(d - page.radii[near], 0)
            for i in np.flatnonzero(least <= limit + slack):
                heapq.heappush(heap, (float(least[i]), page.children[near[i]], float(d[i])))
    return best_ids, best.astype(np.int64)


def top_k(df: DataFrame, *, k: int = 10, query_every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int | None = None) -> DataFrame:
    """The k greatest inner products of each query row with all other rows: query_id, rank, vec_id, score."""
    whole = df.where(vectors.finite(vector_col)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("v")
    )
    far = lambda scores, q2, longest2: np.sqrt(np.maximum(q2 + longest2 - 2 * scores, 0))
    return vectors.search(whole, k, build, find, query_every, "long", ascending=False, distance=far, shard_rows=shard_rows)
