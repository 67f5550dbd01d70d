"""Similarity self-join on word n-grams with adaptive multi-match prefixes, and its connected components.

Words are runs of bytes other than ASCII white space, ASCII letters in lower case; a document's set is its distinct n-word shingles as 64-bit hashes (two of a
hundred million shingles agree by chance with a probability of about 3 in 10,000), and equal sets are one node from the start. A node's name is a 64-bit hash of its set; names that two
different sets have, as a second hash tells, are given up for the second hash.

Order. Shingles go from rare to frequent by a counting sketch of all shingles (a fixed number of cells, at most 2**MAX_BITS, so small enough to give to every task;
it decides costs, never results), then by hash. Sets that share at least o of their n shingles share l of their first n - o + l. A document's l is raised, and its prefix
lengthened, with the estimated number of candidates its prefix meets (COSTS); a pair must share as many prefix shingles as the smaller of its two l before it is verified.

Star phase. Within a shingle's postings only the document in which the shingle comes first stands as candidate to all others: a linear number of pairs, and as that document
has the fewest shingles of its own it is the middle of its group. Verified links make components. Full phase. Postings with one component
are settled, whatever their size. An entry is dropped if its place shows that it can't reach the required overlap with the smallest set of the posting; the remaining
pairs of different components that share enough prefix shingles, and whose parity bits allow the overlap, are verified by exact intersection. Links found there join components. So every two sets at or above
the threshold end in one component, while a group of copies costs its size and not its square. classes does so. joined returns every link: it leaves out the star phase, and
no pair is settled by another.

Defined results: null, empty and white-space texts have empty sets, which link with nothing, not with each other; fewer words than n make one shingle; rows with a null id are
returned with a null component; rows with equal ids are documents of their own (the id counts in each one's component); repeated rows come back as often as they were; further columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store, words
from .components import components

SLICE = 1 << 14
MIN_BITS, MAX_BITS = 18, 24
COSTS = (64, 1024, 16384)
FAN = 256
FILTER_BITS = 1 << 24
WINDOW = 12
PARITIES = 8
HOT = 16
_BITS = [f"bits_{i}_" for i in range(PARITIES)]
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_SPACE = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r "))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, sorted."""
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    edge = np.flatnonzero(np.diff(~_SPACE[data], prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return [np.zeros(0, np.uint64)] * len(texts)
    with np.errstate(over="ignore"):
        h = mixed(words.hashes(data, starts, ends) + (ends - starts).astype(np.uint64))
        rolled = h.copy()
        for k in range(1, n):
            rolled[: len(h) - k] = rolled[: len(h) - k] * np.uint64(0x9E3779B97F4A7C15) + h[k:]
        rolled = mixed(rolled)
    limits = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])).tolist()
    out, at = [], 0
    for end in limits:
        if end - at >= n:
            x = np.sort(rolled[at : end - n + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif end > at:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[at:end].tobytes(), 1)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        at = end
    return out


@dataclass(frozen=True)
class Names:
    """Names of sets: a hash of some bits (fewer than 64 in tests only), or for those that clash the second hash."""

    bits: int = 64
    clashing: frozenset[int] = frozenset()

    def both(self, hashes: np.ndarray) -> tuple[int, int]:
        data = hashes.tobytes()
        return (xxhash.xxh3_64_intdigest(data) >> 64 - self.bits) - (1 << 63), xxhash.xxh3_64_intdigest(data, 0x5EED) - (1 << 63)

    def __call__(self, hashes: np.ndarray) -> int:
        first, second = self.both(hashes)
        return second if first in self.clashing else first


def _batches(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, int, list[bytes], list[np.ndarray]]]:
    texts = [t or b"" for t in batch.column("text").to_pylist()]
    for a, b in words.pieces(list(map(len, texts)), 1 << 20):
        yield a, b, texts[a:b], shingle_sets(texts[a:b], n)


def parities(hashes: np.ndarray) -> list[int]:
    """64 * PARITIES bits, each the parity of the shingles that fall to it: two sets differ in as many shingles at least as their bits do."""
    odd = np.bincount((hashes & np.uint64(64 * PARITIES - 1)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").tolist()


def survey(rows: DataFrame, n: int, bits: int, named: Names) -> DataFrame:
    """A row (doc_id, node, second, n, parities) for each document, and rows (slice, part, counts) of the sketch."""
    names = ["doc_id", "node", "second", "n", *_BITS, "slice", "part", "counts"]
    own = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * PARITIES]
    more = [pa.int32(), pa.int64(), pa.binary()]
    shift = np.uint64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.sole("sketch", object)  # what other operators keep in this worker goes
        cells = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for a, b, _, sets in _batches(batch, n):
                np.add.at(cells, np.concatenate(sets) >> shift, 1)
                size, odd, both = list(map(len, sets)), [parities(s) for s in sets], list(map(named.both, sets))
                cols = [batch.column("doc_id")[a:b], *[pa.array([x[i] for x in both], pa.int64()) for i in (0, 1)], pa.array(size, pa.int32())]
                cols += [pa.array([x[i] for x in odd], pa.int64()) for i in range(PARITIES)]
                yield pa.RecordBatch.from_arrays(cols + [pa.nulls(b - a, k) for k in more], names=names)
        part = TaskContext.get().partitionId()
        for a in range(0, len(cells), 64 * SLICE):
            held = [(i, cells[i * SLICE : (i + 1) * SLICE]) for i in range(a // SLICE, min(a + 64 * SLICE, len(cells)) // SLICE)]
            held = [(i, zstandard.compress(c.astype("<u4").tobytes(), 1)) for i, c in held if c.any()]
            cols = [pa.nulls(len(held), k) for k in own] + [pa.array([h[0] for h in held], pa.int32()), pa.array([part] * len(held), pa.int64()), pa.array([h[1] for h in held], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return rows.mapInArrow(run, f"doc_id long, node long, second long, n int, {', '.join(b + ' long' for b in _BITS)}, slice int, part long, counts binary")


def levels(sketch: DataFrame, bits: int, total: int) -> np.ndarray:
    """How frequent the shingles of each cell are, of total ones: 0 for what may be chance, else twice the binary logarithm of the count. One byte a cell reaches the driver."""
    mean = total / (1 << bits)

    def add(last: bool):
        def f(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            cells = np.zeros(SLICE, np.int64)
            for c in part["counts"]:
                cells += np.frombuffer(zstandard.decompress(c), "<u4")
            data = np.minimum(cells, 2**32 - 1).astype("<u4")
            if last:
                data = np.where(cells > mean + 4 * np.sqrt(mean) + 1, np.minimum(2 * np.log2(np.maximum(cells, 1)) + 1, 255), 0).astype(np.uint8)
            return pd.DataFrame({"slice": [key[0]], "part": [key[1]], "counts": [zstandard.compress(data.tobytes(), 1)]})

        return f

    for divide in (FAN, 1 << 62):
        sketch = sketch.withColumn("part", F.expr(f"part div {divide}")).groupBy("slice", "part").applyInPandas(add(divide > FAN), "slice int, part long, counts binary")
    out = np.zeros(1 << bits, np.uint8)
    for r in sketch.select("slice", "counts").toLocalIterator():  # 2**bits cells at most
        out[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(zstandard.decompress(r["counts"]), np.uint8)
    return out


def least_overlap(n: int, top: int, base: int) -> int:
    """Of a set of n with any set at least as similar as top / base."""
    return -(-n * top // base)


def prefix(hashes: np.ndarray, level: np.ndarray, top: int, base: int) -> tuple[np.ndarray, int]:
    """The prefix from rare to frequent, and l."""
    own = level[(hashes >> np.uint64(64 - int(np.log2(len(level))))).astype(np.int64)]
    order = np.lexsort((hashes, own))
    need = least_overlap(len(hashes), top, base)
    first = order[: len(hashes) - need + 1]
    cost = float(np.sum(np.where(own[first] > 0, 2.0 ** (own[first].astype(float) / 2), 0)))
    l = min(1 + sum(cost > c for c in COSTS), max(need, 1))  # noqa: E741
    return hashes[order[: len(hashes) - need + l]], l


def postings(rows: DataFrame, n: int, level: np.ndarray, top: int, base: int, named: Names) -> DataFrame:
    """token, node, n, pos, l for the prefixes; equal sets once per task."""
    held = rows.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        level = held.value
        for batch in batches:
            out: list[tuple] = []
            for _, _, _, sets in _batches(batch, n):
                for s in sets:
                    node = named(s)
                    if len(s) and node not in seen:
                        seen.add(node)
                        p, l = prefix(s, level, top, base)  # noqa: E741
                        out.append((p.view(np.int64), node, len(s), l))
            if out:
                n_each = [len(o[0]) for o in out]
                spread = lambda i, k: pa.array(np.repeat(np.array([o[i] for o in out], k), n_each))  # noqa: B023, E731
                pos = np.concatenate([np.arange(x, dtype=np.int32) for x in n_each])
                cols = [pa.array(np.concatenate([o[0] for o in out])), spread(1, np.int64), spread(2, np.int32), pa.array(pos), spread(3, np.int32)]
                yield pa.RecordBatch.from_arrays(cols, names=["token", "node", "n", "pos", "l"])

    return rows.mapInArrow(run, "token long, node long, n int, pos int, l int")


def id_filter(ids: DataFrame) -> np.ndarray:
    """Bits set for the ids of a table: tells most other ids apart, in a fixed number of bytes."""
    size = FILTER_BITS // 64

    def gather(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(size, bool)
        bits[part["bit"].to_numpy()] = True
        return pd.DataFrame({"slice": [key[0]], "data": [np.packbits(bits).tobytes()]})

    h = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    spread = ids.select(F.floor(h / size).cast("int").alias("slice"), (h % size).cast("int").alias("bit")).distinct()
    out = np.zeros(FILTER_BITS, bool)
    for r in spread.groupBy("slice").applyInPandas(gather, "slice int, data binary").toLocalIterator():
        out[r["slice"] * size : (r["slice"] + 1) * size] = np.unpackbits(np.frombuffer(r["data"], np.uint8))
    return np.packbits(out)


def texts_of(rows: DataFrame, ids: DataFrame, n: int, named: Names) -> DataFrame:
    """node, data (the text, compressed) for documents whose id is in ids, and for a few more."""
    held = rows.sparkSession.sparkContext.broadcast(id_filter(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = held.value, set()
        for batch in batches:
            at = batch.column("bit").to_numpy()
            mine = batch.filter(pa.array((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1))
            for _, _, texts, sets in _batches(mine, n):
                new = {k: t for s, t in zip(sets, texts, strict=True) if len(s) and (k := named(s)) not in seen}
                seen.update(new)
                cols = [pa.array(list(new), pa.int64()), pa.array([zstandard.compress(t, 1) for t in new.values()], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["node", "data"])

    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).cast("int")
    found = rows.where("doc_id is not null").select(bit.alias("bit"), "text").mapInArrow(run, "node long, data binary")
    return found.groupBy("node").agg(F.first("data").alias("data"))


def verify(pairs: DataFrame, texts: DataFrame, n: int, top: int, base: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[int, np.ndarray] = OrderedDict()

        def shingles(node: int, data: bytes) -> np.ndarray:
            if node not in recent:
                recent[node] = shingle_sets([zstandard.decompress(data)], n)[0]
                if len(recent) > 256:
                    recent.popitem(last=False)
            recent.move_to_end(node)
            return recent[node]

        for batch in batches:
            good = []
            for a, b, x, y in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "x", "y")], strict=True):
                s, t = shingles(a, x), shingles(b, y)
                both = len(np.intersect1d(s, t, assume_unique=True))
                good.append(base * both >= top * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    x = texts.select(F.col("node").alias("a"), F.col("data").alias("x"))
    y = texts.select(F.col("node").alias("b"), F.col("data").alias("y"))
    return pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _apart(x: str, y: str) -> Column:
    """How many parity bits differ."""
    out = F.lit(0)
    for b in _BITS:
        out = out + F.bit_count(F.col(x + b).bitwiseXOR(F.col(y + b)))
    return out


def _join(docs: DataFrame, n: int, top: int, base: int, id_col: str, text_col: str, every: bool, name_bits: int = 64) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, node, n), nodes, links and labels: all links with every, else as many as hold the components together."""
    spark = docs.sparkSession
    store.small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    bits = min(max(int(np.ceil(np.log2(max(docs.count(), 1) * 32))), MIN_BITS), MAX_BITS)
    named = Names(name_bits)
    found = store.cut(survey(rows, n, bits, named), "jaccard-survey")
    level = levels(found.where("slice is not null").select("slice", "part", "counts"), bits, found.agg(F.sum("n")).first()[0] or 0)
    several = found.where("n > 0 and doc_id is not null").groupBy("node").agg(F.min("second").alias("low"), F.max("second").alias("high")).where("low < high")
    clashing = frozenset(r["node"] for r in several.select("node").collect())  # of 10**10 sets some three are expected
    if clashing:
        named = Names(name_bits, clashing)
        found = found.withColumn("node", F.when(F.col("node").isin(*clashing), F.col("second")).otherwise(F.col("node")))
    own = found.where("node is not null").select("doc_id", "node", "n")
    nodes = store.cut(found.where("n > 0 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), *[F.first(b).alias(b) for b in _BITS]), "jaccard-nodes")

    ratio = F.lit(top / (top + base))
    need = lambda x, y: F.ceil(ratio * (F.col(x) + F.col(y)) - 1e-6)
    near_size = lambda x, y: F.least(x, y) * base >= F.greatest(x, y) * top
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def alike(pairs: DataFrame) -> DataFrame:
        """Those of pairs (a, b with sizes n, n2) whose parity bits allow the overlap."""
        side = lambda c, tag: nodes.select(F.col("node").alias(c), *[F.col(b).alias(tag + b) for b in _BITS])
        return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").where(F.col("n") + F.col("n2") - _apart("x", "y") >= 2 * need("n", "n2")).select(*pairs.columns)

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        both = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        texts = store.cut(texts_of(rows, both.join(nodes, "node").select(F.col("rep").alias("doc_id")), n, named), f"{name}-texts")
        out = store.cut(verify(pairs, texts, n, top, base), name)
        store.release(texts)
        return out

    # all columns serve both uses, so that the postings are made and dealt out once
    posted = postings(rows.where("doc_id is not null"), n, level, top, base, named).repartition(parts, "token")
    shared = posted.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.min(F.struct("pos", "node", "n", "l")).alias("lead")).where("low < high").select("token", "lead")
    near = posted.join(shared, "token").repartition(parts, "node").dropDuplicates(["node", "pos"])
    place = Window.partitionBy("node").orderBy("pos")
    reach = F.row_number().over(place) - 1 + F.col("n") - F.col("pos")
    entries = store.cut(near.withColumn("reach", reach).select("token", "node", "n", "pos", "l", "reach", F.col("lead.node").alias("lead"), F.col("lead.n").alias("lead_n"), F.col("lead.l").alias("lead_l")), "jaccard-entries")
    del posted, shared, near

    if not every:
        # star phase: the two leaders that a node shares most prefix shingles with
        likely = entries.where((F.col("node") != F.col("lead")) & near_size("n", "lead_n")).groupBy("node", "lead").agg(F.count("*").alias("c"), F.first("n").alias("n"), F.first("lead_n").alias("n2"))
        likely = likely.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("c"), "lead"))).where("r <= 2")
        stars = store.cut(alike(likely.select(F.col("node").alias("a"), F.col("lead").alias("b"), "n", "n2")), "jaccard-stars")
        links = linked(stars, "jaccard-links")
        first = components(links)

    # full phase; with every, each node is a component of its own
    plain = entries.drop("lead", "lead_n", "lead_l")
    marked = plain.withColumn("label", F.col("node")) if every else store.cut(plain.join(first, "node", "left").withColumn("label", F.coalesce("label", "node")), "jaccard-marked")
    small = marked.groupBy("token").agg(F.min("n").alias("least"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("token", "least")
    left = marked.join(small, "token").where(F.col("reach") >= need("n", "least"))
    open_ = left.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")).where("low < high").select("token", "size")
    left = store.cut(left.drop("least").join(open_, "token"), "jaccard-open")
    store.release(entries, marked, *[] if every else [stars])

    def meet(side: DataFrame, more: list[str], condition: Column | None = None) -> DataFrame:
        cols = ["node", "n", "l", "reach", "label", *more]
        other = side.select("token", *[F.col(c).alias(f"2{c}" if c in more else f"{c}2") for c in cols])
        fits = (F.col("node") < F.col("node2")) & (F.col("label") != F.col("label2")) & near_size("n", "n2") & (F.least("reach", "reach2") >= need("n", "n2"))
        met = side.select("token", *cols).join(other, "token").where(fits if condition is None else fits & condition)
        return met.select(F.col("node").alias("a"), F.col("node2").alias("b"), "n", "n2", F.least("l", "l2").alias("l"))

    # in long postings a pair is made only if its parity bits allow it, and only at the first shingle that it shares: earlier ones, up to WINDOW before, are among what both sides carry
    back = Window.partitionBy("node").orderBy("pos").rowsBetween(-WINDOW, -1)
    hot = left.where(F.col("size") > HOT).withColumn("before", F.collect_list("token").over(back)).join(nodes.select("node", *_BITS), "node")
    allowed = (F.col("n") + F.col("n2") - _apart("", "2") >= 2 * need("n", "n2")) & ~F.arrays_overlap("before", "2before")
    met = meet(left.where(F.col("size") <= HOT), []).union(meet(hot, ["before", *_BITS], allowed))
    met = alike(met.groupBy("a", "b").agg(F.first("n").alias("n"), F.first("n2").alias("n2"), F.min("l").alias("l")))
    prefixes = left.groupBy("node").agg(F.collect_list("token").alias("tokens"))
    side = lambda c: prefixes.select(F.col("node").alias(c), F.col("tokens").alias(f"{c}_tokens"))
    enough = F.size(F.array_intersect("a_tokens", "b_tokens")) >= F.col("l")
    pairs = store.cut(met.join(side("a"), "a").join(side("b"), "b").where(enough).select("a", "b"), "jaccard-pairs")
    store.release(left)
    more = linked(pairs, "jaccard-more")
    if every:
        return own, nodes, more, components(more)
    return own, nodes, links.union(more), components(links.union(more)) if more.limit(1).count() else first


def classes(docs: DataFrame, *, words_each: int = 3, top: int = 90, base: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row: sets link at a Jaccard similarity of top / base or more."""
    own, nodes, _, labels = _join(docs, words_each, top, base, id_col, text_col, every=False)
    return _rows(own, _ids(nodes, labels))


def joined(docs: DataFrame, *, words_each: int = 3, top: int = 90, base: int = 100, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The whole join. Links (a, b, a_id, b_id): every two different sets at a similarity of top / base or more once, by their hashes, a < b, and the least id of each
    set's rows. Rows (doc_id, n_shingles, component_id, node, n_links): classes' row with its set and the number of sets that it links with. Its size is that of its links."""
    own, nodes, links, labels = _join(docs, words_each, top, base, id_col, text_col, every=True)
    name = lambda c: nodes.select(F.col("node").alias(c), F.col("rep").alias(f"{c}_id"))
    named = links.join(name("a"), "a").join(name("b"), "b").select("a", "b", "a_id", "b_id")
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count("*").alias("n_links"))
    found = _rows(own, _ids(nodes, labels), "node").join(ends, "node", "left")
    count = F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0)))
    return named, found.select("doc_id", "n_shingles", "component_id", "node", count.alias("n_links"))


def _ids(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """node, component (the least id of its rows)."""
    named = nodes.join(labels, "node").select("node", "label", "rep")
    lowest = named.groupBy("label").agg(F.min("rep").alias("component"))
    member = store.cut(named.join(lowest, "label").select("node", "component"), "jaccard-members")
    # nodes of one row without links need no entry: the row's id is the component's
    id_of = nodes.join(member, "node", "left").where("component is not null or copies > 1").select("node", F.coalesce("component", "rep").alias("component"))
    return store.cut(id_of, "jaccard-ids")


def _rows(own: DataFrame, id_of: DataFrame, *more: str) -> DataFrame:
    """own rows with the component of their node; a node that id_of doesn't name is its only row's."""
    got: Column = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "doc_id"))
    return own.join(id_of, "node", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), got).alias("component_id"), *more)
