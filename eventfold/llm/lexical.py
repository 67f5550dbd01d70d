"""Ranked lexical search over a tiered index.

Terms are runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased. A posting's impact is what its term's weight is multiplied by in a score, so it depends on
the document and on two sums over the whole table, which a first pass gathers.

Index: documents go in blocks as they are read, so building it moves nothing. A block's postings of a term stand by falling impact and are cut into tiers: the first
TIERS[0] of them (as a share, FIRST at least), up to TIERS[1], the rest. A row of the index is a tier of a term in a block: the documents, their impacts, and the residual, the highest
impact that lower tiers of that term and block still hold. Rows lie by tier, then term, so that a reader of high tiers skips the pages of lower ones.
A block is BLOCK_DOCS documents or BLOCK_BYTES of text, and no task needs more than one of its blocks.

Search: items go in batches of ITEMS. Tiers up to the t-th give each document of a block a lower bound for an item (what its postings seen so far sum to), and an upper one (what terms in which it
wasn't seen may add by their residuals). The k-th best lower bound over all blocks is the item's bar. A block is done for an item when no residual is left, as its
scores are then exact, or when no upper bound reaches the bar; all other pairs of block and item fall through to the next tier. The last tier leaves no residuals, so all scores given are exact.

Defined results: a null or empty text, or one without a term, matches nothing and isn't counted; an item without terms has no rows; terms of weight 0 add nothing and documents of score 0 aren't given; rows that repeat
a doc_id or an item_id are documents or items of their own; equal scores go by id, null ids last; a null item_id is given back; further columns are ignored.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import store
from .words import _Numbers

TIERS = (1 / 16, 1 / 4)
FIRST = 8
BLOCK_DOCS = 1 << 14
BLOCK_BYTES = 16 << 20
ITEMS = 512
ITEM_TERMS = 1 << 16
HEADER = -1  #: the tier of the row with a block's ids
ROWS = "tier int, block long, term string, df int, residual long, docs binary, impacts binary"
_KINDS = pa.schema([("tier", pa.int32()), ("block", pa.int64()), ("term", pa.string()), ("df", pa.int32()), ("residual", pa.int64()), ("docs", pa.binary()), ("impacts", pa.binary())])

#: Bytes that end a term become a space and A-Z lower case. Beyond ASCII, all bytes of UTF-8 belong to terms.
_TERM_BYTES = bytes(ord(chr(b).lower()) if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(128)) + bytes(range(128, 256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


@dataclass
class Index:
    """rows: what ROWS says. n_docs: documents with a term; n_terms: all their terms."""

    rows: DataFrame
    n_docs: int
    n_terms: int


def _bytes_by_row(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column of which row i holds the next counts[i] values."""
    offsets = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype("<i4").tobytes()), pa.py_buffer(values.tobytes())])


def block_rows(block: int, ids: list, texts: list[bytes], n_docs: int, n_terms: int) -> Iterator[pa.RecordBatch]:
    """The index of a block, from its documents that hold a term."""
    numbers, term, tf, distinct, lengths = _Numbers(), array("i"), array("i"), array("i"), array("q")
    for text in texts:
        found = terms(text)
        counts = Counter(found)
        term.extend(map(numbers.__getitem__, counts))
        tf.extend(counts.values())
        distinct.append(len(counts))
        lengths.append(len(found))
    known = pa.array([x is None for x in ids])
    yield pa.RecordBatch.from_arrays(
        [pa.array([HEADER], pa.int32()), pa.array([block]), pa.array([None], pa.string()), pa.array([None], pa.int32()), pa.array([None], pa.int64()),
         pa.array([np.array([x or 0 for x in ids], "<i8").tobytes()], pa.binary()), pa.array([np.array(known, np.uint8).tobytes()], pa.binary())], schema=_KINDS,
    )
    names = np.array(numbers.new, object)
    by_name = np.argsort(names, kind="stable")
    place = np.empty(len(names), np.int64)
    place[by_name] = np.arange(len(names))
    doc = np.repeat(np.arange(len(ids)), np.asarray(distinct))
    count, m = np.asarray(tf, np.int64), np.array([25 + 75 * n * n_docs // n_terms for n in lengths], np.int64)
    impact = 1_000_000_000 * count // (1000 * count + 8 * m[doc])
    term_at = place[np.asarray(term, np.int64)]
    order = np.argsort(term_at << 20 | ((1 << 20) - 1 - impact), kind="stable")  # an impact is 10**6 at most
    term_at, doc, impact = term_at[order], doc[order].astype("<u2"), impact[order].astype("<u4")
    df = np.bincount(term_at, minlength=len(names))
    start, ends = np.cumsum(df) - df, []
    for share in TIERS:
        ends.append(np.minimum(df, np.maximum(FIRST, np.ceil(df * share).astype(np.int64))))
    ends.append(df)
    nth = np.arange(len(doc)) - np.repeat(start, df)
    labels = pa.array([names[i].decode() for i in by_name], pa.string())
    for tier, end in enumerate(ends):
        before = ends[tier - 1] if tier else np.zeros_like(df)
        own = np.flatnonzero(end > before)
        if not len(own):
            continue
        inside = (nth >= before[term_at]) & (nth < end[term_at])
        more = end < df
        residual = np.where(more, impact[np.minimum(start + end, len(impact) - 1)], 0).astype(np.int64)
        n, size = (end - before)[own], len(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(size, tier, np.int32)), pa.array(np.full(size, block, np.int64)), labels.take(pa.array(own)), pa.array(df[own].astype(np.int32)), pa.array(residual[own]),
             _bytes_by_row(doc[inside], n), _bytes_by_row(impact[inside], n)], schema=_KINDS,
        )


def build(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of all rows of docs, written to the shared folder."""
    store.small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = total = 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                n = len(terms(text))
                some += n > 0
                total += n
        yield pa.RecordBatch.from_pydict({"n_docs": [some], "n_terms": [total]})

    sums = rows.select("text").mapInArrow(count, "n_docs long, n_terms long").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_terms").alias("n_terms")).first()
    n_docs, n_terms = sums["n_docs"] or 0, sums["n_terms"] or 0

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text.translate(_TERM_BYTES).isspace() or not text:
                    continue
                ids.append(key)
                texts.append(text)
                size += len(text)
                if len(ids) == BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield from block_rows(made, ids, texts, n_docs, n_terms)
                    made, ids, texts, size = made + 1, [], [], 0
        if ids:
            yield from block_rows(made, ids, texts, n_docs, n_terms)

    return Index(store.cut(rows.mapInArrow(index, ROWS), "lexical-index"), n_docs, n_terms)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def bounds(rows: pd.DataFrame, wanted: dict[int, dict[str, int]], k: int) -> Iterator[tuple]:
    """For each item of wanted that may match the block: its k best lower bounds (item, doc, low, exact, None), and (item, None, None, exact, the highest upper bound).

    rows: a block's header and its tiers so far, of the terms wanted. wanted: weights times repeats by term, for each item.
    """
    head = rows["tier"].to_numpy() == HEADER
    header = rows[head].iloc[0]
    ids, no_id = np.frombuffer(header["docs"], "<i8"), np.frombuffer(header["impacts"], np.uint8)
    seen: dict[str, tuple[np.ndarray, np.ndarray, int]] = {}
    for term, residual, docs, impacts in rows[~head].sort_values("tier")[["term", "residual", "docs", "impacts"]].itertuples(index=False):
        at, value = np.frombuffer(docs, "<u2"), np.frombuffer(impacts, "<u4").astype(np.int64)
        if term in seen:
            at, value = np.concatenate([seen[term][0], at]), np.concatenate([seen[term][1], value])
        seen[term] = at, value, int(residual)
    low, more = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    for item, weights in wanted.items():
        own = [(w, *seen[t]) for t, w in weights.items() if w and t in seen]
        if not own:
            continue
        unseen = sum(int(w * r) for w, _, _, r in own)
        low[:], more[:] = 0, unseen
        for w, at, value, residual in own:
            low[at] += w * value
            if unseen:
                more[at] += w * (value - residual)
        exact = unseen == 0
        best = np.flatnonzero(low > 0)
        if len(best) > k:
            best = best[low[best] >= np.partition(low[best], len(best) - k)[len(best) - k]]
        best = best[np.lexsort((ids[best], no_id[best], -low[best]))[:k]]
        for d in best.tolist():
            yield item, None if no_id[d] else int(ids[d]), int(low[d]), exact, None
        yield item, None, None, exact, int(low.max() if exact else more.max())


FOUND = "item long, block long, doc_id long, low long, exact boolean, bound long"


def search_batch(index: Index, items: dict[int, Counter], k: int) -> list[DataFrame]:
    """Tables with the exact scores among which are each item's k best. items: terms by number of the item, ITEMS of them at most."""
    spark = index.rows.sparkSession
    every = sorted(set().union(*items.values()))
    named = spark.createDataFrame([(t.decode(),) for t in every], "term string")
    if len(every) <= ITEM_TERMS:  # more only where a single item has more
        named = F.broadcast(named)
    posts = index.rows.where(F.col("tier") > HEADER)
    df = {r["term"]: r["df"] for r in posts.where("tier = 0").join(named, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df")).collect()}  # as many as the batch has terms
    own = {i: {t.decode(): n * weight(index.n_docs, df[t.decode()]) for t, n in c.items() if t.decode() in df} for i, c in items.items()}
    parts, out, open_ = int(spark.conf.get("spark.sql.shuffle.partitions")), [], None
    for tier in range(len(TIERS) + 1):
        seen = index.rows.where((F.col("tier") <= tier) & (F.col("tier") > HEADER)).join(named, "term", "left_semi").unionByName(index.rows.where(F.col("tier") == HEADER))

        def first(rows: pd.DataFrame) -> pd.DataFrame:
            block = int(rows["block"].iloc[0])
            return pd.DataFrame([(i, block, *x) for i, *x in bounds(rows, own, k)], columns=["item", "block", "doc_id", "low", "exact", "bound"]).astype({"doc_id": "Int64", "low": "Int64", "bound": "Int64"})

        def again(rows: pd.DataFrame, left: pd.DataFrame) -> pd.DataFrame:
            block = int(rows["block"].iloc[0]) if len(rows) else 0
            wanted = {i: own[i] for i in left["item"]} if len(rows) else {}
            found = bounds(rows, wanted, k) if wanted else ()
            return pd.DataFrame([(i, block, *x) for i, *x in found], columns=["item", "block", "doc_id", "low", "exact", "bound"]).astype({"doc_id": "Int64", "low": "Int64", "bound": "Int64"})

        if open_ is None:
            made = seen.repartition(parts, "block").groupBy("block").applyInPandas(first, FOUND)
        else:
            some = open_.select("block").distinct()
            made = seen.join(some, "block", "left_semi").groupBy("block").cogroup(open_.groupBy("block")).applyInPandas(again, FOUND)
        found = store.cut(made, f"lexical-tier{tier}")
        out.append(found.where("exact and low is not null").select("item", "doc_id", F.col("low").alias("score")))
        lows = found.where("low is not null").select("item", F.col("low").alias("score"))
        for x in out[:-1]:
            lows = lows.unionByName(x.select("item", "score"))
        nth = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
        bars = {r["item"]: r["score"] for r in lows.withColumn("nth", nth).where(F.col("nth") <= k).where(F.col("nth") == k).collect()}  # one for each item
        bar = spark.createDataFrame([(i, bars.get(i, 1)) for i in items], "item long, bar long")
        open_ = store.cut(found.where("not exact and bound is not null").join(bar, "item").where("bound >= bar").select("item", "block"), "lexical-open")
        if open_.isEmpty():
            break
    return out


def search(index: Index, items: DataFrame, *, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's k highest-scoring documents with a score above 0."""
    spark = items.sparkSession
    stated = store.cut(items.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).withColumn("item", F.monotonically_increasing_id()), "lexical-items")
    found: list[DataFrame] = []
    batch: dict[int, Counter] = {}

    def close() -> None:
        if batch and index.n_docs:
            found.extend(search_batch(index, batch, k))
        batch.clear()

    for r in stated.select("item", "text").toLocalIterator():
        own = Counter(terms(bytes(r["text"])))
        if batch and (len(batch) == ITEMS or sum(map(len, batch.values())) + len(own) > ITEM_TERMS):
            close()
        if own:
            batch[r["item"]] = own
    close()
    if not found:
        return stated.where("false").select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    nth = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    top = every.withColumn("rank", nth).where(F.col("rank") <= k)
    return top.join(stated.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
