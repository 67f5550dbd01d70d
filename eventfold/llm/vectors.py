"""Searches of a stated set of queries against all vectors: shards of bounded bytes around pivots, an index each, queries in blocks.

Some rows are pivots (a bounded number, by a hash of their ids). Every row goes to its nearest pivot; a pivot's rows are dealt to as many shards as
their bytes ask for, so one crowded place doesn't make a large shard. A shard's index is built by one task and kept as one row beside the shard's covering radius.
First each query searches one shard of its nearest pivot, which gives a limit for its k-th score; then it meets only those other shards that,
by the triangle inequality, may hold something within the limit (where there is one shard, that is all). Queries travel in blocks, those of one pivot together, each only to shards that its own limit lets it enter; groups of a shard and
some blocks (salted) are joined, and the best of all shards are merged by a rank that is limited before it is shuffled. No task holds more than a shard and
BLOCKS_A_GROUP blocks, whatever the number of rows.

Distances are Euclidean. A search for greatest inner products lifts the rows by one more coordinate to the greatest length L of all rows: then
|q - o|^2 = |q|^2 + L^2 - 2 q.o, so the nearest are those of the greatest product.

Defined results for both searches: vectors that are null or hold null or non-finite components take no part; vectors of different lengths don't
meet; a repeated row (same id, same vector) counts once; of queries with equal ids but different vectors the least vector is searched;
candidates with the query's id are left out; ties go to smaller ids; fewer candidates give fewer rows; an empty table
gives none; further columns are ignored. Of more than k + 1 equal vectors those with the smallest ids are indexed, which is exact for k nearest.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store

SHARD_BYTES = 4 << 20
BLOCK_BYTES = 128 << 10
BLOCKS_A_GROUP = 64
MAX_PIVOTS = 256
PIVOT_BYTES = 8 << 20


def finite(c: str) -> Column:
    return F.col(c).isNotNull() & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x) for x in column.to_numpy()])


@dataclass
class Space:
    """What is known of the vectors of one length: how many, the greatest squared length (0 unless lifted) and the pivots."""

    n: int
    longest2: float
    pivots: np.ndarray
    shard_rows: int
    block_rows: int

    def to_pivots(self, points: np.ndarray, lift: bool) -> np.ndarray:
        """Distances of points to all pivots; with lift, points are rows and not queries."""
        if self.longest2 and lift:
            points = lifted(points, self.longest2)
        elif self.longest2:
            points = np.hstack([points, np.zeros((len(points), 1))])
        return np.stack([np.sqrt(((points - p) ** 2).sum(1)) for p in self.pivots], 1)


def lifted(points: np.ndarray, longest2: float) -> np.ndarray:
    points = points.astype(np.float64)
    return np.hstack([points, np.sqrt(np.maximum(longest2 - (points**2).sum(1), 0))[:, None]])


def spaces(held: DataFrame, lift: bool, shard_rows: int | None) -> dict[int, Space]:
    """By length of vectors: a few numbers and at most MAX_PIVOTS rows (and PIVOT_BYTES) each."""
    long2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    out = {}
    for r in held.groupBy("dim").agg(F.count("*").alias("n"), F.max(long2).alias("longest2")).collect():
        dim, n = r["dim"], r["n"]
        rows = shard_rows or max(SHARD_BYTES // (8 * max(dim, 1)), 64)
        many = max(1, min(-(-n // rows), MAX_PIVOTS, PIVOT_BYTES // (8 * max(dim, 1))))
        picked = held.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id", F.lit(11)), "vec_id").limit(many).select("v").collect()
        pivots = np.array([p["v"] for p in picked], np.float64).reshape(len(picked), dim)
        longest2 = float(r["longest2"]) if lift else 0.0
        out[dim] = Space(n, longest2, lifted(pivots, longest2) if longest2 else pivots, rows, max(BLOCK_BYTES // (8 * max(dim, 1)), 16))
    return out


def near(rows: DataFrame, known: dict[int, Space], lift: bool) -> DataFrame:
    """rows (vec_id, v, dim) with the number of their nearest pivot and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            pivot, away = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                v = batch.column("v").take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).reshape(len(own), dim).astype(np.float64)
                d = known[dim].to_pivots(v, lift)
                pivot[own] = d.argmin(1)
                away[own] = d[np.arange(len(own)), pivot[own]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot), pa.array(away)], names=[*batch.schema.names, "pivot", "away"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, pivot int, away double")


def search(
    vectors: DataFrame,
    k: int,
    build: Callable[[np.ndarray, np.ndarray, float], object],
    find: Callable[[object, int, np.ndarray, int, float | None], tuple[np.ndarray, np.ndarray]],
    query_every: int,
    score_type: str,
    ascending: bool,
    distance: Callable[[np.ndarray, float, float], np.ndarray],
    relax: float = 1.0,
    shard_rows: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score for rows whose vec_id is divisible by query_every.

    vectors: vec_id long, v array. build(ids, matrix, longest2) makes an index; find(index, query id, query, k, score so far or None) gives ids and scores of its
    best, k at most. distance(scores, |q|^2, longest2) are the distances that scores stand for; a shard is skipped if relax times its least distance is beyond the limit.
    """
    lift = not ascending
    rows = vectors.select("vec_id", "v", F.size("v").alias("dim")).where("vec_id is not null")
    same = Window.partitionBy("v").orderBy("vec_id")
    held = store.cut(rows.dropDuplicates(["vec_id", "v"]).withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).drop("nth"), "vectors")
    known = spaces(held, lift, shard_rows)
    if not known:
        return held.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast(score_type).alias("score"))
    queries = rows.where(F.col("vec_id") % query_every == 0).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    asked = store.cut(near(queries, known, False).drop("away"), "vector-queries")
    dealt = store.cut(near(held, known, lift), "vectors-near")
    per_pivot = dealt.groupBy("dim", "pivot").agg(F.count("*").alias("n"))  # MAX_PIVOTS rows a length at most
    sizes = F.create_map(*[x for d, s in known.items() for x in (F.lit(d), F.lit(s.shard_rows))])
    shards = dealt.join(F.broadcast(per_pivot), ["dim", "pivot"]).withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / sizes[F.col("dim")]).cast("long")).cast("int"))

    def built(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id")
        index = build(part["vec_id"].to_numpy(), matrix(part["v"]), known[key[0]].longest2)
        return pd.DataFrame({"dim": [key[0]], "pivot": [key[1]], "chunk": [key[2]], "radius": [part["away"].max()], "data": [pickle.dumps(index, 5)]})

    indexes = store.cut(shards.groupBy("dim", "pivot", "chunk").applyInPandas(built, "dim int, pivot int, chunk int, radius double, data binary"), "vector-indexes")
    reach = {(r["dim"], r["pivot"]): (r["radius"], r["chunks"]) for r in indexes.groupBy("dim", "pivot").agg(F.max("radius").alias("radius"), F.count("*").alias("chunks")).collect()}
    n_salts = max(1, -(-asked.count() // (min(s.block_rows for s in known.values()) * BLOCKS_A_GROUP)))

    def may_pass(dim: int, points: np.ndarray, limits: np.ndarray, pivots: range | list[int]) -> np.ndarray:
        """By query and pivot, whether its shards may hold something within the limit (NaN: none yet)."""
        d = known[dim].to_pivots(points, False)[:, list(pivots)]
        radius = np.array([reach.get((dim, p), (-np.inf, 0))[0] for p in pivots])
        slack = 1e-6 * (1 + d + radius)
        return (radius >= 0) & (np.isnan(limits)[:, None] | ((d - radius) * relax <= limits[:, None] + slack))

    def blocked(first: bool) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
        def block(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            dim, pivot, at = key
            part = part.sort_values("vec_id")
            raw, limits = matrix(part["v"]), part["limit"].to_numpy(np.float64)
            points = raw.astype(np.float64)
            far = distance(limits, (points**2).sum(1), known[dim].longest2)
            ids = part["vec_id"].to_numpy()
            some = lambda own: pickle.dumps((ids[own], raw[own], limits[own]), 5)
            if first:
                return pd.DataFrame({"dim": [dim], "pivot": [pivot], "chunk": [0], "salt": [at % n_salts], "data": [some(slice(None))]}) if (dim, pivot) in reach else pd.DataFrame(columns=BLOCK)
            passes, to = may_pass(dim, points, far, range(len(known[dim].pivots))), []
            for p in np.flatnonzero(passes.any(0)).tolist():
                data = some(passes[:, p])  # a query goes only where its own bound lets it
                to += [(p, c, data) for c in range(reach[dim, p][1]) if (p, c) != (pivot, 0)]
            return pd.DataFrame({"dim": dim, "pivot": [x[0] for x in to], "chunk": [x[1] for x in to], "salt": (at + pivot) % n_salts, "data": [x[2] for x in to]})

        return block

    def met(key: tuple, own: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        for data in own["data"]:
            index = pickle.loads(data)
            for raw in queries["data"]:
                ids, asked_for, so_far = pickle.loads(raw)
                points = asked_for.astype(np.float64)
                ok = may_pass(key[0], points, distance(so_far, (points**2).sum(1), known[key[0]].longest2), [key[1]])[:, 0]
                for i in np.flatnonzero(ok):
                    found, scores = find(index, int(ids[i]), asked_for[i], k, None if np.isnan(so_far[i]) else so_far[i])
                    out.append((np.full(len(found), ids[i]), found, scores))
        cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [[], [], []]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), cols, strict=True)))

    def step(queries: DataFrame, first: bool) -> DataFrame:
        per = F.create_map(*[x for d, s in known.items() for x in (F.lit(d), F.lit(s.block_rows))])
        counts = asked.groupBy("dim", "pivot").agg(F.count("*").alias("n"))
        placed = queries.join(F.broadcast(counts), ["dim", "pivot"]).withColumn("at", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / per[F.col("dim")]).cast("long")).cast("int")).drop("n")
        blocks = placed.groupBy("dim", "pivot", "at").applyInPandas(blocked(first), "dim int, pivot int, chunk int, salt int, data binary")
        own = indexes.where("chunk = 0") if first else indexes
        own = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1)))).drop("radius")
        keys = ["dim", "pivot", "chunk", "salt"]
        return own.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInPandas(met, f"query_id long, vec_id long, score {score_type}")

    order = Window.partitionBy("query_id").orderBy(F.col("score") if ascending else F.desc("score"), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    none = F.lit(None).cast("double")
    everywhere = step(asked.withColumn("limit", none), True)
    if all(sum(chunks for (d, _), (_, chunks) in reach.items() if d == dim) == 1 for dim in known):  # the first shard is the only one
        return ranked(everywhere).select("query_id", "rank", "vec_id", "score")
    one = store.cut(everywhere, "vector-first")
    last = one.groupBy("query_id").agg((F.max("score") if ascending else F.min("score")).alias("worst"), F.count("*").alias("found")).where(F.col("found") == k)
    limited = asked.join(last, asked["vec_id"] == last["query_id"], "left").select("vec_id", "v", "dim", "pivot", F.col("worst").cast("double").alias("limit"))
    return ranked(one.unionByName(step(limited, False))).select("query_id", "rank", "vec_id", "score")


BLOCK = ["dim", "pivot", "chunk", "salt", "data"]
