"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme-value statistics.

Fit. A bounded sample of labelled rows (max_rows, by hash; equal texts count once) gives the document frequencies of features by class: words
and their prefixes of PREFIXES letters. A feature's weight is its log-odds between the classes with an informative Dirichlet prior (PRIOR
pseudo-documents spread as the feature is spread over both classes) less CAUTION standard deviations; it is used from MIN_WEIGHT on. A word
scores by its own weight if it has one, else by its longest prefix's; any other word scores DRIFT, which keeps passages local. A prefix of which one longer prefix or word makes up more than MOST_OF_ONE says no more than that and isn't used. The table of weights is
bounded by the sample and goes to the executors as a constant.

Scan. One pass over a text's words finds all maximal-scoring segments in linear time: the disjoint passages whose sum can't be raised by moving
an end. With background frequencies p_i, lambda solves sum p_i exp(lambda s_i) = 1 and segment sums S in n words follow an extreme-value law with
E(S) = K n exp(-lambda S); K comes from the clean rows of the sample. A passage is significant at E <= MAX_E.

Score. The significant passages of a text add up (each lambda S - ln(K n)); a text's score is exp(-M exp(-sum)), the chance that none of M clean texts
gets as far by accident. So it rises with the evidence from near 0 to 1; a text without a hit scores exp(-M).

Defined results: null and empty texts score exp(-M) and aren't toxic; with no labelled row of both classes nothing is toxic; rows with null
or repeated ids are scored one by one; conflicting labels of an id or text count as toxic; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (6, 5, 4)
MAX_ROWS = 24_000
PRIOR = 30.0
CAUTION = 2.0
MIN_WEIGHT = 1.5
MOST_OF_ONE = 0.85
DRIFT = -0.05
MAX_E = 0.05
M = 200.0
THRESHOLD = 0.7


@dataclass
class Model:
    weights: dict[str, float]
    lam: float
    k: float

    @property
    def key(self) -> str:
        return hashlib.md5(repr(sorted(self.weights.items())).encode()).hexdigest()

    def word(self, w: str) -> float:
        got = self.weights.get(w)
        if got is None:
            for n in PREFIXES:
                if len(w) > n and (got := self.weights.get(w[:n] + "*")) is not None:
                    return got
            return DRIFT
        return got


def features(text: str) -> set[str]:
    """The words of a text and their prefixes."""
    out = set(WORD.findall(text.lower()))
    return out | {w[:n] + "*" for w in out for n in PREFIXES if len(w) > n}


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, sum) in linear time.

    A stack holds candidates with the cumulative sums before and after them; a new positive run joins all
    candidates back to the one whose left sum is lower, as long as its right sum is below the new one.
    """
    up = scores > 0
    if not up.any():
        return []
    edge = np.flatnonzero(np.diff(up, prepend=False, append=False))
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float, int]] = []  # first, end, left, right, index of the nearest lower-left candidate
    for first, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        left, right = float(total[first]), float(total[end])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((first, end, left, right, j))
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, right - left) for a, b, left, right, _ in stack]


def evidence(model: Model, scores: np.ndarray) -> tuple[list[tuple[int, int, float, float]], float]:
    """The significant passages (first, end, sum, E) and what they add up to."""
    n, out, total, best = len(scores), [], 0.0, 0.0
    for a, b, s in segments(scores):
        gain = model.lam * s - math.log(max(model.k * n, 1e-300))
        best = max(best, gain)
        if gain >= -math.log(MAX_E):
            out.append((a, b, s, math.exp(-gain)))
            total += gain
    return out, max(total, best)


def probability(total: float) -> float:
    return math.exp(-M * math.exp(-min(total, 700.0)))


class Scorer:
    """Scores of white-space-free chunks of text, worked out once for each chunk."""

    def __init__(self, model: Model):
        self.model = model
        self.cache = words.Flat(lambda new: words.flat_lists([self._numbers(w.decode()) for w in new]))
        self.values: list[float] = []
        self.places: dict[float, int] = {}

    def _numbers(self, chunk: str) -> list[int]:
        out = []
        for w in WORD.findall(chunk.lower()):
            s = self.model.word(w)
            if s not in self.places:
                self.places[s] = len(self.values)
                self.values.append(s)
            out.append(self.places[s])
        return out

    def scores(self, texts: list[bytes]) -> list[np.ndarray]:
        split = [t.split() for t in texts]
        flat, n = self.cache.expand(self.cache.look_up([w for ws in split for w in ws]))
        all_ = np.asarray(self.values or [0.0])[flat] if len(flat) else np.zeros(0)
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum([len(ws) for ws in split])]
        return np.split(all_, ends[:-1])


def scorer_of(model: Model) -> Scorer:
    return words.sole(("toxicity", model.key), lambda: Scorer(model))


def fold(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def sample(docs: DataFrame, labels: DataFrame, may_learn: Column | None, max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """text and toxic of up to max_rows labelled rows, those with the least hashes; toxic rows fill half of it at most."""
    known = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull())
    if may_learn is not None:
        known = known.where(may_learn)
    known = known.groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    take = lambda t, n: known.where(F.col("toxic") == t).orderBy(F.xxhash64(id_col), id_col).limit(n)
    chosen = take(1, max_rows // 2).unionByName(take(0, max_rows // 2))  # at most max_rows ids and flags: may be broadcast
    rows = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(chosen), id_col)
    return rows.where("text is not null").groupBy(F.md5("text").alias("m")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))


def signatures(text: str, n: int = 3) -> list[int]:
    """The least hashes of 4-word windows under n orders: near copies mostly share them."""
    ws = [w.encode() for w in text.lower().split()]
    h = np.fromiter(map(zlib.crc32, ws), np.uint64, len(ws))
    if len(h) > 3:
        h = h[:-3] * np.uint64(0x9E3779B1) + h[1:-2] * np.uint64(0x85EBCA77) + h[2:-1] * np.uint64(0xC2B2AE3D) + h[3:]
    return [int((h * np.uint64(2 * i + 3) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(i)).min()) >> 1 if len(h) else 0 for i in range(n)]


def one_of_each(rows: DataFrame) -> DataFrame:
    """Of near copies with one label the first: a passage that was copied often is one piece of evidence, not many."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(zip(*[signatures(t) for t in batch.column("text").to_pylist()], strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([batch.column("m"), batch.column("toxic"), *[pa.array(c, pa.int64()) for c in cols]], names=["m", "toxic", "s0", "s1", "s2"])

    slim = rows.select("m", F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(sign, "m string, toxic int, s0 long, s1 long, s2 long")
    for s in ("s0", "s1", "s2"):
        slim = slim.groupBy(s, "toxic").agg(F.min(F.struct("m", *[x for x in ("s0", "s1", "s2") if x != s])).alias("x")).select("toxic", s, "x.*")
    return rows.join(F.broadcast(slim.select("m")), "m", "left_semi")  # no more ids than the sample has


def fit(rows: DataFrame) -> Model:
    """A model from rows of text and toxic (0 or 1), a bounded number of them."""
    from . import store

    store.small_batches(rows.sparkSession)
    rows = store.cut(rows.select(F.md5("text").alias("m"), "text", F.col("toxic").cast("int").alias("toxic")), "toxicity-rows")
    rows = store.cut(one_of_each(rows), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                held[toxic == 1].update(features(text))
        names = list(held[0] | held[1])
        for a in range(0, len(names), 50_000):
            part = names[a : a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([held[0][x] for x in part], pa.int64()), pa.array([held[1][x] for x in part], pa.int64())], names=["f", "clean", "toxic"])

    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = n.get(0, 0), n.get(1, 0)
    if not n_clean or not n_toxic:
        return Model({}, 1.0, 1.0)
    sums = rows.mapInArrow(count, "f string, clean long, toxic long").groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic >= 2")
    # a word's parent is its longest prefix, a prefix's the next shorter one
    long_ = F.length("f") - F.endswith("f", F.lit("*")).cast("int")
    parent = F.coalesce(*[F.when(long_ > n, F.concat(F.substring("f", 1, n), F.lit("*"))) for n in PREFIXES])
    top = sums.select(parent.alias("f"), "toxic").where("f is not null").groupBy("f").agg(F.max("toxic").alias("top"))
    sums = sums.join(top, "f", "left").where(F.col("top").isNull() | (F.col("top") <= F.col("toxic") * MOST_OF_ONE))
    prior = (F.col("clean") + F.col("toxic")) / F.lit(n_clean + n_toxic) * PRIOR + 0.05
    odds = lambda y, total: F.log((F.col(y) + prior) / (F.lit(total + PRIOR) - F.col(y) + F.lit(0.05)))
    table = (
        sums.withColumn("w", odds("toxic", n_toxic) - odds("clean", n_clean))
        .withColumn("w", F.col("w") - CAUTION * F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior)))
        .where(F.col("w") > MIN_WEIGHT)
        .collect()  # no more than the words of a bounded sample's toxic rows
    )
    weights = {r["f"]: float(r["w"]) for r in table}
    return calibrate(rows, weights)


def calibrate(rows: DataFrame, weights: dict[str, float]) -> Model:
    """lambda from the scores' frequencies in clean rows, K from the segments of clean rows."""
    plain = Model(weights, 1.0, 1.0)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, seen, best = scorer_of(plain), Counter(), []
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for a, b in words.pieces(list(map(len, texts)), 4 << 20):
                for s in scorer.scores(texts[a:b]):
                    values, n = np.unique(s, return_counts=True)
                    seen.update(dict(zip(values.tolist(), n.tolist(), strict=True)))
                    best.append((float(len(s)), max((x[2] for x in segments(s)), default=0.0)))
        data = [(0, v, float(n)) for v, n in seen.items()] + [(1, n, s) for n, s in best]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in data], t) for i, t in enumerate((pa.int32(), pa.float64(), pa.float64()))], names=["kind", "a", "b"])

    got = rows.where("toxic = 0").mapInArrow(look, "kind int, a double, b double").collect()  # as many as the sample's rows and weights
    seen: Counter = Counter()
    for r in got:
        if r["kind"] == 0:
            seen[r["a"]] += r["b"]
    best = [(r["a"], r["b"]) for r in got if r["kind"] == 1]
    lam = solve(seen)
    # log-likelihood of K given lambda: rows over the sum of n exp(-lambda S)
    k = len(best) / max(math.fsum(n * math.exp(-lam * s) for n, s in best), 1e-12)
    return Model(weights, lam, k)


def solve(seen: Counter) -> float:
    """lambda > 0 with sum p_i exp(lambda s_i) = 1; weights that clean rows don't show count as half a word. Where clean words score 0 or more on average there is none: then
    it is 0.001, by which no passage is significant."""
    s = np.array([*seen, 5.0])
    p = np.array([*seen.values(), 0.5], float)
    p /= p.sum()
    f = lambda lam: float((p * np.exp(lam * s)).sum()) - 1
    low, high = 1e-3, 1e-3
    while f(high) < 0 and high < 50:
        high *= 1.5
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return low


def _found(model: Model, scorer: Scorer, texts: list[bytes | None]) -> list[tuple[list, float]]:
    held = [t or b"" for t in texts]
    return [evidence(model, s) for a, b in words.pieces(list(map(len, held)), 1 << 20) for s in scorer.scores(held[a:b])]


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns keep, score, and passages: first and end word, sum and E of each significant one."""
    kinds = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("sum", pa.float64()), ("e", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(model)
        for batch in batches:
            found = _found(model, scorer, batch.column("_text").to_pylist())
            passages = [[{"first": a, "end": b, "sum": s, "e": e} for a, b, s, e in x] for x, _ in found]
            cols = [batch.column(c) for c in keep] + [pa.array([probability(t) for _, t in found], pa.float64()), pa.array(passages, kinds)]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "score", "passages"])

    rows = docs.select(*keep, F.col(text_col).cast("binary").alias("_text"))
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{fields}, score double, passages array<struct<first: int, end: int, sum: double, e: double>>")


def reject(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of docs that aren't toxic, with all their columns."""
    model = fit(sample(docs, labels, fold("doc_id") != 1, max_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(model)
        for batch in batches:
            found = _found(model, scorer, batch.column(text_col).cast(pa.binary()).to_pylist())
            yield batch.filter(pa.array([probability(t) < threshold for _, t in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD, keep: tuple[str, ...] = ("doc_id",), hold_out: bool = True) -> DataFrame:
    """score, passages and predicted for all of docs. With hold_out the rows of fold 1 are not learnt from."""
    model = fit(sample(docs, labels, fold("doc_id") != 1 if hold_out else None, max_rows))
    return score(docs, model, keep=keep).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return classify(docs, labels).select("doc_id", (F.coalesce(fold("doc_id"), F.lit(0)) == 1).alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))
