"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the copies that each of its documents gets on average. The whole part of that is
taken at once; the fractions are rounded in pairs: of two fractional documents a random one gains and the other loses, words
staying equal in sum, until one is 0 or 1. Rows of a source are dealt to buckets of bounded size by a hash of
all their columns, so rows that share an id or have none spread; each bucket leaves one fractional document at most, and the left-overs of up to FAN buckets meet in the next level of a
tree, until a source has one left, which is rounded alone. Documents above 1 / 256 of their source are settled first, octave by octave of sizes, and the smaller ones
make good what rounding a last large one gains or loses. So a source's taken words differ from its target by less than a small document where it has many, and by less than its largest always.

Chance comes from hashes of rows and a seed, so reruns agree whatever the partitions. Defined results: a null or empty text
has size 0 and isn't taken; a null source is a source of its own, the last in order; rows with equal ids are documents of
their own; the copies of rows that are equal in all columns, maps included, differ by one at most; an empty table gives no rows; further columns only tell rows apart.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import store

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BUCKET_ROWS = 2048
FAN = 256
OCTAVES = 8
CHUNK = 1 << 12


def size_of(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """A rank from 0 by code point, null last, for a table with one row for each source: range partitions counted apart, then numbered."""
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = store.cut(
        sources.repartitionByRange(n, F.col("source").isNull(), F.col("source"))
        .withColumn("part", F.spark_partition_id()),
        "mix-sources",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("part").count().withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).select("part", "base")
    within = Window.partitionBy("part").orderBy(F.col("source").isNull(), F.col("source"))
    return dealt.withColumn("nth", F.row_number().over(within) - 1).join(base, "part").select("source", "source_size", "n_docs", (F.col("base") + F.col("nth")).alias("rank"))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Each source's target: share of all words by weight; what a source can't take goes to the others by weight, until none has too much.

    The level rises only, so the loop ends; a round reads the small table of sources and brings back a few numbers.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = store.cut(ranked(sources).withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(most)), "mix-targets")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, n_full = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= F.col("most")
        got = table.agg(
            F.sum(full.cast("long")).alias("n"),
            F.sum(F.when(full, F.col("most")).otherwise(0.0)).alias("capped"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not got["open"] or got["n"] == n_full:
            break
        n_full, level = got["n"], (share * total - got["capped"]) / got["open"]
    return table.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("most"))).select("source", "source_size", "n_docs", "rank", "target")


def mixed_bits(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chance(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """Numbers in [0, 1) by two keys."""
    with np.errstate(over="ignore"):
        x = mixed_bits(a + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed + 1))
        x = mixed_bits(x ^ mixed_bits(b + np.uint64(0x9E3779B97F4A7C15)))
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def pivot(p: np.ndarray, w: np.ndarray, keys: np.ndarray, seed: int) -> np.ndarray:
    """Probabilities rounded to 0 and 1 but for one at most, sum of p * w as before. Neighbours pair up; what is fractional then pairs up again."""
    p, live, level = p.copy(), np.flatnonzero((p > 0) & (p < 1)), seed
    while len(live) > 1:
        i, j = live[: len(live) // 2 * 2 : 2], live[1::2]
        ratio = w[j] / w[i]
        up, down = np.minimum(1 - p[i], p[j] * ratio), np.minimum(p[i], (1 - p[j]) * ratio)
        rises = chance(keys[i], keys[j], level) * (up + down) < down
        fills, drains = 1 - p[i] <= p[j] * ratio, p[i] <= (1 - p[j]) * ratio
        a = np.where(rises, np.where(fills, 1.0, p[i] + up), np.where(drains, 0.0, p[i] - down))
        b = np.where(rises, np.where(fills, p[j] - up / ratio, 0.0), np.where(drains, p[j] + down / ratio, 1.0))
        p[i], p[j] = np.clip(a, 0, 1), np.clip(b, 0, 1)
        live, level = live[(p[live] > 0) & (p[live] < 1)], level + 1
    return p


def settle_large(rows: pd.DataFrame, seed: int = 0) -> pd.DataFrame:
    """Rounds a source's large documents, from the largest octave of sizes down; what the last one of an octave gains or loses in rounding, all smaller documents make good.

    rows: those above 1 / 2**OCTAVES of the source, so 2**OCTAVES at most. Column pool is the probability that is left for the rest.
    """
    rows = rows.sort_values(["size", "key", "row_id"], ascending=[False, True, True], kind="stable")
    size, keys = rows["size"].to_numpy().astype(np.float64), rows["key"].to_numpy().astype(np.uint64)
    p, pool, rest = rows["p"].to_numpy().copy(), float(rows["p"].iloc[0]), float(rows["source_size"].iloc[0])
    octave = np.floor(np.log2(rest / size)).astype(int)
    for o in np.unique(octave):
        own = np.flatnonzero(octave == o)
        rest -= size[own].sum()
        p[own] = pivot(np.full(len(own), pool), size[own], keys[own], seed + 31 * int(o))
        for i in own[(p[own] > 0) & (p[own] < 1)]:
            to = float(chance(keys[i : i + 1], keys[i : i + 1], seed + 99)[0] < p[i])
            if rest > 0.5:
                pool = min(max(pool + (p[i] - to) * size[i] / rest, 0.0), 1.0)
            p[i] = to
    return rows.assign(p=p, pool=pool)


def _round_groups(seed: int, last: bool):
    """For applyInPandas: rounds a bucket; in the last level also the one that is left."""

    def f(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "size", "row_id"], kind="stable")
        keys = rows["key"].to_numpy().astype(np.uint64)
        p = pivot(rows["p"].to_numpy(), rows["size"].to_numpy().astype(np.float64), keys, seed)
        if last:
            p = np.where((p > 0) & (p < 1), (chance(keys, keys, seed + 99) < p).astype(np.float64), p)
        return rows.assign(p=p)

    return f


def row_key(docs: DataFrame, seed: int) -> F.Column:
    """A number by all columns of a row, of which chance is made; equal rows are interchangeable."""
    return F.xxhash64(F.unhex(store.row_digest(docs)), F.lit(seed))


def copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 7) -> DataFrame:
    """doc_id, source, size, source_size, target, digest (store.row_digest), n and copies: what the mix takes of n equal rows together. Large rows may have several entries."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), size_of(text_col).alias("size"), F.unhex(store.row_digest(docs)).alias("digest"), row_key(docs, seed).alias("key"))
    sizes = store.cut(rows.groupBy("doc_id", "source", "size", "digest", "key").agg(F.count("*").alias("n")), "mix-sizes")
    aims = store.cut(targets(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs")), weights, share, most), "mix-aims")
    mean = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    deep = (
        sizes.join(aims.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left")
        .withColumn("whole", F.floor(mean).cast("long"))
        .withColumn("p", F.when(F.col("size") > 0, mean - F.col("whole")).otherwise(0.0))
        .withColumn("bucket", F.pmod(F.shiftrightunsigned("key", 8), F.ceil(F.col("n_docs") / BUCKET_ROWS).cast("long")))
        .withColumn("row_id", F.monotonically_increasing_id())
        .select("doc_id", "source", "size", "source_size", "target", "digest", "n", "whole", "key", "p", "bucket", "rank", "row_id")
    )
    open_ = (F.col("p") > 0) & (F.col("p") < 1)
    large = open_ & (F.col("size") * 2**OCTAVES > F.col("source_size"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in deep.schema)
    deep = store.cut(deep, "mix-deep")
    # rows of a large size are few in their source, equal ones too: each stands for itself
    lone = deep.where(large).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).withColumns({"n": F.lit(1).cast("long"), "key": F.xxhash64("key", "nth")}).drop("nth")
    settled = store.cut(lone.groupBy("rank").applyInPandas(lambda rows: settle_large(rows, seed), f"{fields}, pool double"), "mix-large")
    pools = settled.groupBy("rank").agg(F.min("pool").alias("pool"))
    each = F.when(open_, F.coalesce("pool", "p")).otherwise(F.col("p")) * F.col("n")
    deep = deep.where(~large).join(pools, "rank", "left").withColumn("all", each).withColumns({"whole": F.col("whole") * F.col("n") + F.floor("all"), "p": F.col("all") - F.floor("all")}).select(*deep.columns)
    most_buckets = aims.agg(F.max(F.ceil(F.col("n_docs") / BUCKET_ROWS))).first()[0] or 1
    state, done, level = deep, [settled.drop("pool")], 0
    while True:
        last = most_buckets <= 1
        state = store.cut(state.groupBy("rank", "bucket").applyInPandas(_round_groups(seed + 1000 * level, last), deep.schema), "mix-level")
        if last:
            done.append(state)
            break
        done.append(state.where(~open_))
        state = state.where(open_).withColumn("bucket", F.floor(F.col("bucket") / FAN).cast("long"))
        most_buckets, level = -(-most_buckets // FAN), level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + F.col("p").cast("long")).otherwise(F.lit(0).cast("long")))


def spread(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as column times says, numbered from 0 in column nth. What a row gives beyond CHUNK is dealt out before it is made."""
    last = F.col(times) - 1
    few = rows.where(F.col(times).between(1, CHUNK)).withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    chunks = rows.where(F.col(times) > CHUNK).withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(CHUNK).cast("long"))))
    dealt = chunks.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return few.unionByName(dealt.withColumn("nth", F.explode(F.sequence("_from", F.least(last, F.col("_from") + CHUNK - 1)))).drop("_from"))


def mix_table(docs: DataFrame) -> DataFrame:
    """A row for each document; of n equal rows that have c copies, c mod n have one more than the others."""
    taken = spread(copies(docs), "n")
    own = F.floor(F.col("copies") / F.col("n")) + (F.col("nth") < F.col("copies") % F.col("n")).cast("long")
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * own).alias("taken"))


def repeat(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, **how) -> DataFrame:
    """The rows of docs, each as often as the mix takes it. Equal rows are sent once, with the copies of all of them."""
    took = copies(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed, **how).groupBy(F.col("digest").alias("_digest")).agg(F.sum("copies").alias("_copies"))
    took = store.cut(took.where("_copies > 0"), "mix-took")
    rows = docs.withColumn("_digest", F.unhex(store.row_digest(docs))).dropDuplicates(["_digest"])
    few = rows.join(took.where(F.col("_copies") <= CHUNK), "_digest").withColumn("_again", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int")))).select(*docs.columns)
    many = took.where(F.col("_copies") > CHUNK)
    return few if many.isEmpty() else few.unionByName(spread(rows.join(many, "_digest"), "_copies").select(*docs.columns))
