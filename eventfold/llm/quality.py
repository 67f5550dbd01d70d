"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model's symbols are UTF-8 bytes and its order is ORDER: a closed alphabet, so no word is out of vocabulary in any language, and codes of 8 * ORDER bits are exact.
The count tables grow with the trusted text (2**(8 * ORDER) codes are possible).

Counting: texts meet the trusted ids in a join; n-gram counts are summed within a task in runs of bounded size, then by (lang, code). Only the counts of full n-grams
are gathered; those of lower orders are numbers of different bytes to the left, which follow from them.
Shards: an n-gram is dealt by the two bytes before its last. Its context and the n-grams of all orders from 3 up that back off from it share these two, so a shard holds
all that they need; counts of counts, and counts of two bytes and of one, are small (65,536 a language at most) and summed over all shards first.
Scoring: documents go in blocks of a language. A block asks each shard for the probabilities of its distinct n-grams; groups of a shard
and a bounded number of blocks (salted) are joined, and the answers meet the block's texts, whose n-grams look them up. One exchange holds blocks and questions for both uses, so
texts move once. No task holds more than a shard and SALT_BLOCKS blocks' questions, or a block with its answers.

Threshold: one trusted document in HOLD_OUT, by checksum of its id, isn't counted (where that leaves a language none of two or more, the one of least checksum). Per
language, excess is log-perplexity over the held-out median, times sqrt(n / (n + EVEN)) for n symbols, as short texts vary more. Its QUANTILE over held-out documents of the
language, or of all languages where it has fewer than FEW, gives each length its limit. Documents above their limit are rejected. With spread, a limit lets at least so many median absolute excesses through; it is
off unless a caller asks for it.

Defined results: null and empty texts have no perplexity and are rejected; a null lang is a language of its own; a document in a language without trusted text has
no perplexity and is kept, as nothing speaks against it; so is one in a language with a single trusted document, which has no threshold; rows with equal or null ids are scored one by one (rows of equal id get a row each); conflicting labels count as trusted if any does.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store, words

BEGIN, END = 2, 3
ORDER = 5
SHARD_CODES = 1 << 19
MIN_SHARDS = 8
RUN_CODES = 1 << 21
BLOCK_DOCS = 2048
BLOCK_BYTES = 2 << 20
HELD_BYTES = 24 << 20
SALT_BLOCKS = 64
QUANTILE = 0.985
EVEN = 1000
SPREAD = 0.0
FEW = 30
HOLD_OUT = 5


def codes(text: bytes, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each byte of a text and at its end, earlier bytes higher."""
    a = np.frombuffer(bytes([BEGIN] * (order - 1)) + text + bytes([END]), np.uint8).astype(np.int64)
    n = len(a) - order + 1
    out = a[:n].copy()
    for i in range(1, order):
        out <<= 8
        out |= a[i : i + n]
    return out


def pack(code: np.ndarray) -> bytes:
    """Rising codes as gaps, by byte planes."""
    gap = np.diff(code, prepend=0).astype("<u8").view(np.uint8).reshape(-1, 8)
    return zstandard.compress(np.ascontiguousarray(gap.T[: (8 * ORDER + 7) // 8]).tobytes(), 3)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape((8 * ORDER + 7) // 8, -1)
    return np.cumsum(sum(p.astype(np.int64) << (8 * i) for i, p in enumerate(planes)))


def shard_of(code: np.ndarray, n_shards: int) -> np.ndarray:
    """By the two bytes before the last."""
    return ((code >> 8 & 0xFFFF) * 40503 >> 4) % n_shards


def row_key() -> Column:
    """Of doc_id, lang and text: rows of one key have one verdict."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("lang"), F.lit("\x00")), F.coalesce(F.col("text"), F.lit("")))


def _texts(docs: DataFrame, keep: list[Column]) -> DataFrame:
    return docs.select(*keep, F.coalesce(F.col("lang"), F.lit("\x00")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def trusted_counts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """lang, code, n over the documents whose doc_id is in trusted."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(1).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(list(map(squeeze, batch.column("text").to_pylist())), pa.binary())], names=["doc_id", "lang", "text"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        size = 0
        loosen = zstandard.ZstdDecompressor().decompress

        def merge(lang: str) -> None:
            code, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
            if lang in sums:
                every = np.concatenate([sums[lang][0], code])
                code, at = np.unique(every, return_inverse=True)
                n = np.bincount(at, np.concatenate([sums[lang][1], n]), len(code)).astype(np.int64)
            sums[lang] = code, n

        def give() -> Iterator[pa.RecordBatch]:
            for lang, (code, n) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code)), pa.array(code), pa.array(n, pa.int64())], names=["lang", "code", "n"])
            sums.clear()

        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held.setdefault(lang, []).append(codes(loosen(data)))
                size += len(held[lang][-1])
                if size > RUN_CODES:
                    size = 0
                    for x in list(held):
                        merge(x)
                    if sum(len(x[0]) for x in sums.values()) > RUN_CODES:
                        yield from give()
        for x in list(held):
            merge(x)
        yield from give()

    small = _texts(docs, [F.col("doc_id")]).where(F.col("doc_id").isNotNull() & (F.length("text") > 0)).mapInArrow(shrink, "doc_id long, lang string, text binary")
    # the trusted ids grow with the corpus: the same join at every size
    return small.join(trusted.hint("merge"), "doc_id", "left_semi").select("lang", "text").mapInArrow(add, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """Of counts of 1, 2 and more, by the counts of counts."""
    y = n1 / (n1 + 2 * n2) if n1 > 0 else 0.5
    each = [i - (i + 1) * y * b / a if a > 0 else 0.5 * i for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(d, 0.05 * i), i - 0.05) for i, d in enumerate(each, 1))


def lower(code: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams one shorter and the number of different bytes before each."""
    return np.unique(code & ((1 << 8 * (order - 1)) - 1), return_counts=True)


@dataclass
class Level:
    """Kneser-Ney estimates of one order by sorted codes and contexts; of what isn't seen, the weight of the context times the order below."""

    code: np.ndarray
    high: np.ndarray
    context: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, code: np.ndarray, n: np.ndarray, d: tuple[float, float, float]) -> Level:
        cut = np.asarray(d)[np.minimum(n, 3) - 1]
        context, at = np.unique(code >> 8, return_inverse=True)
        total = np.bincount(at, n, len(context))
        return cls(code, (n - cut) / total[at], context, np.bincount(at, cut, len(context)) / total)

    def __call__(self, code: np.ndarray, below: np.ndarray) -> np.ndarray:
        return _pick(self.code, self.high, code, 0.0) + _pick(self.context, self.rest, code >> 8, 1.0) * below


def _pick(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


#: What the orders have in common within a language: discounts by order from 3 up, and the probabilities of the second of two bytes, 256 * 256.
Base = tuple[dict[int, tuple[float, float, float]], np.ndarray]


def bases(counts: DataFrame) -> DataFrame:
    """lang, data: a Base for each language, from sums over all shards."""

    def gather(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out = []
        code, n = part["code"].to_numpy(), part["n"].to_numpy()
        order = np.argsort(code)
        code, n = code[order], n[order]
        for k in range(ORDER, 2, -1):
            for i in (1, 2, 3, 4):
                out.append((key[0], k, i, int((n == i).sum())))
            code, n = lower(code, k)
        out += [(key[0], 2, int(c), int(x)) for c, x in zip(code, n, strict=True)]
        return pd.DataFrame(out, columns=["lang", "order", "what", "n"])

    def base(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        many = {k: [0] * 4 for k in range(3, ORDER + 1)}
        for k, i, n in part.loc[part["order"] > 2, ["order", "what", "n"]].itertuples(index=False):
            many[k][i - 1] = n
        two = part[part["order"] == 2].sort_values("what")
        code, n = two["what"].to_numpy(), two["n"].to_numpy()
        one, n1 = lower(code, 2)
        counts_of = lambda x: [int((x == i).sum()) for i in (1, 2, 3, 4)]
        single = Level.of(one, n1, discounts(*counts_of(n1)))
        p1 = single(np.arange(256), np.full(256, 1 / 256))
        p2 = Level.of(code, n, discounts(*counts_of(n)))(np.arange(65536), np.tile(p1, 256))
        return pd.DataFrame({"lang": [key[0]], "data": [pickle.dumps(({k: discounts(*v) for k, v in many.items()}, p2), 5)]})

    parts = counts.groupBy("lang", "shard").applyInPandas(gather, "lang string, order int, what long, n long").groupBy("lang", "order", "what").agg(F.sum("n").alias("n"))
    return parts.groupBy("lang").applyInPandas(base, "lang string, data binary")


def probabilities(base: Base, code: np.ndarray, n: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Of the wanted n-grams by a shard's counts, which are sorted by code; wanted ones fall to the shard."""
    d, p2 = base
    levels = []
    for k in range(ORDER, 2, -1):
        levels.append((k, Level.of(code, n, d[k]) if len(code) else None))
        code, n = lower(code, k)
    out = p2[wanted & 0xFFFF]
    for k, level in reversed(levels):
        if level is not None:
            out = level(wanted & ((1 << 8 * k) - 1), out)
    return out


BLOCKS = "lang string, shard int, block long, data binary"
TEXT = -1  #: the shard of rows that hold a block's documents


def _own(text: bytes) -> np.ndarray:
    return codes(text) if text else np.zeros(0, np.int64)


def blocks(docs: DataFrame, n_shards: int) -> DataFrame:
    """Documents by lang in blocks: a row with the documents of each, and rows with the distinct n-grams that fall to each shard."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.sole("blocks", object)  # what other operators keep in this worker goes
        made = TaskContext.get().partitionId() << 32
        held: dict[str, list] = {}
        size: dict[str, int] = {}

        def close(lang: str) -> pa.RecordBatch:
            nonlocal made
            rows = held.pop(lang)
            size.pop(lang)
            asked = np.unique(np.concatenate([_own(r[2]) for r in rows]))
            shard = shard_of(asked, n_shards)
            order = np.argsort(shard, kind="stable")
            ends = np.searchsorted(shard[order], np.arange(n_shards + 1))
            out = [(TEXT, zstandard.compress(pickle.dumps(rows, 5), 3))] + [(s, pack(asked[order[ends[s] : ends[s + 1]]])) for s in range(n_shards) if ends[s] < ends[s + 1]]
            cols = [pa.array([lang] * len(out)), pa.array([x[0] for x in out], pa.int32()), pa.array([made] * len(out), pa.int64()), pa.array([x[1] for x in out], pa.binary())]
            made += 1
            return pa.RecordBatch.from_arrays(cols, names=["lang", "shard", "block", "data"])

        for batch in batches:
            for key, row, lang, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "row_key", "lang", "text")], strict=True):
                held.setdefault(lang, []).append((key, row, text))
                size[lang] = size.get(lang, 0) + len(text) + 100
                if len(held[lang]) >= BLOCK_DOCS or size[lang] >= BLOCK_BYTES:
                    yield close(lang)
                elif sum(size.values()) >= HELD_BYTES:  # many languages
                    yield close(max(size, key=size.get))
        for lang in sorted(held):
            yield close(lang)

    return _texts(docs, [F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key")]).mapInArrow(cut, BLOCKS)


def perplexities(docs: DataFrame, counts: DataFrame, n_shards: int, base: DataFrame) -> DataFrame:
    """doc_id, row_key, lang, n_symbols, perplexity for every row of docs. counts: lang, code, n, shard."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks(docs, n_shards).repartition(parts, "block")
    # not a condition that is pushed below the exchange, which would make two of it
    here = lambda wanted: wanted | (F.spark_partition_id() < 0)
    texts, asked = dealt.where(here(F.col("shard") == TEXT)), dealt.where(here(F.col("shard") != TEXT))
    # languages of more documents than the blocks of a group may have (a block holds BLOCK_BYTES or BLOCK_DOCS); a language that isn't named has one salt
    size = F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 100) / BLOCK_BYTES + F.count("*") / BLOCK_DOCS
    many = docs.groupBy(F.coalesce("lang", F.lit("\x00")).alias("lang")).agg(F.ceil(size / SALT_BLOCKS).alias("salts")).where("salts > 1")
    busy = {r["lang"]: r["salts"] for r in many.collect()}
    salts = F.coalesce(F.create_map(*[F.lit(x) for kv in busy.items() for x in kv])[F.col("lang")], F.lit(1)) if busy else F.lit(1)

    def answer(key: tuple, model: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        own = model["data"].dropna()
        raw = model[model["data"].isna()].sort_values("code")
        code, n = raw["code"].to_numpy(np.int64), raw["n"].to_numpy(np.int64)
        out = []
        if len(own):
            wanted = [unpack(x) for x in questions["data"]]
            ends = np.cumsum([0, *map(len, wanted)])
            found = np.log(probabilities(pickle.loads(own.iloc[0]), code, n, np.concatenate(wanted))) if wanted else np.zeros(0)
            out = [(key[1], block, zstandard.compress(found[a:b].astype("<f4").tobytes(), 1)) for block, a, b in zip(questions["block"], ends[:-1], ends[1:], strict=True)]
        return pd.DataFrame(out, columns=["shard", "block", "data"])

    def total(key: tuple, texts: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        own = texts.iloc[0]
        rows = pickle.loads(zstandard.decompress(own["data"]))
        each = [_own(r[2]) for r in rows]
        n = np.array(list(map(len, each)), np.int64)
        parts = parts.sort_values("shard")
        sums = np.full(len(rows), np.nan)
        if len(parts):
            asked, at = np.unique(np.concatenate(each), return_inverse=True)
            del each
            order = np.argsort(shard_of(asked, n_shards), kind="stable")
            logs = np.empty(len(asked))
            logs[order] = np.concatenate([np.frombuffer(zstandard.decompress(x), "<f4") for x in parts["data"]])  # as many as were asked for, or this fails
            sums[n > 0] = np.add.reduceat(logs[at], (np.cumsum(n) - n)[n > 0])
        with np.errstate(all="ignore"):
            ppl = np.exp(-sums / n)
        ids = pd.array([r[0] for r in rows], "Int64")
        return pd.DataFrame({"doc_id": ids, "row_key": [r[1] for r in rows], "lang": own["lang"], "n_symbols": n, "perplexity": pd.array(np.where(np.isnan(ppl), 0, ppl), "Float64")}).assign(perplexity=lambda d: d["perplexity"].mask(np.isnan(ppl)))

    salt = lambda c: F.pmod(F.xxhash64(c), salts).cast("int")
    none = lambda kind: F.lit(None).cast(kind)
    left = counts.select("lang", "shard", "code", "n", none("binary").alias("data"))
    left = left.unionByName(base.select("lang", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"), none("long").alias("code"), none("long").alias("n"), "data"))
    left = left.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    keys = ["lang", "shard", "salt"]
    answers = left.groupBy(*keys).cogroup(asked.withColumn("salt", salt("block")).groupBy(*keys)).applyInPandas(answer, "shard int, block long, data binary")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(total, "doc_id long, row_key long, lang string, n_symbols long, perplexity double").withColumn("lang", F.when(F.col("lang") != "\x00", F.col("lang")))


def _checksum(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def held_out(id_col: str = "doc_id") -> Column:
    return _checksum(id_col) % HOLD_OUT == 0


def trusted_ids(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held of the trusted documents."""
    ids = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    known = store.cut(rows.where("text <> ''").select("doc_id", F.coalesce("lang", F.lit("\x00")).alias("of")).join(ids.hint("merge"), "doc_id").distinct(), "kn-trusted")
    by_lang = known.groupBy("of").agg(F.max(held_out()).alias("any"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min(F.struct(_checksum("doc_id"), "doc_id"))["doc_id"].alias("least"))
    lone = by_lang.where("not any and low < high").select(F.col("least").alias("doc_id")).distinct().withColumn("more", F.lit(True))
    return store.cut(known.select("doc_id").distinct().join(lone, "doc_id", "left").select("doc_id", (held_out() | F.coalesce("more", F.lit(False))).alias("held")), "kn-held")


def limits(tested: DataFrame, quantile: float, spread: float = SPREAD) -> DataFrame:
    """of, middle, reach by language: a text of n symbols may have a log-perplexity of middle + reach * sqrt((n + EVEN) / n)."""
    tested = tested.select(F.coalesce("lang", F.lit("\x00")).alias("of"), "n_symbols", F.log("perplexity").alias("loss"))
    middle = store.cut(tested.groupBy("of").agg(F.percentile_approx("loss", 0.5, 10_000).alias("middle"), F.count("*").alias("tests")), "kn-middle")
    over = store.cut(tested.join(middle, "of").select("of", "middle", "tests", ((F.col("loss") - F.col("middle")) * F.sqrt(F.col("n_symbols") / (F.col("n_symbols") + EVEN))).alias("over")), "kn-over")
    reach = F.percentile_approx("over", quantile, 10_000)
    if spread:
        reach = F.greatest(reach, spread * F.percentile_approx(F.abs("over"), 0.5, 10_000))
    pooled = F.lit(over.agg(reach).first()[0]).cast("double")
    return store.cut(over.groupBy("of", "middle", "tests").agg(reach.alias("own")).select("of", "middle", F.when(F.col("tests") < FEW, pooled).otherwise(F.col("own")).alias("reach")), "kn-limits")


def judge(docs: DataFrame, labels: DataFrame, *, quantile: float = QUANTILE, spread: float = SPREAD, keyed: bool = False) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, threshold, keep for every row of docs; with keyed, row_key as well."""
    store.small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    trusted = trusted_ids(rows, labels)
    counts = store.cut(trusted_counts(rows, trusted.where("not held").select("doc_id")), "kn-counts")
    n_shards = max(MIN_SHARDS, -(-counts.count() // SHARD_CODES))
    two = F.col("code").bitwiseAND(F.lit(0xFFFF00))
    dealt = counts.withColumn("shard", (F.shiftright(F.shiftright(two, 8) * 40503, 4) % n_shards).cast("int"))
    base = store.cut(bases(dealt), "kn-bases")
    store.release()  # the shuffle files so far
    scored = store.cut(perplexities(rows, dealt, n_shards, base), "kn-scores")
    # of equal ids the trusted flag is the same, so a semi join serves
    tested = scored.join(trusted.where("held"), "doc_id", "left_semi").where("perplexity is not null")
    out = scored.join(limits(tested, quantile, spread), F.coalesce(scored["lang"], F.lit("\x00")) == F.col("of"), "left")
    n = F.col("n_symbols")
    out = out.withColumn("threshold", F.when(n > 0, F.exp(F.col("middle") + F.col("reach") * F.sqrt((n + EVEN) / n)))).drop("of", "middle", "reach", *[] if keyed else ["row_key"])
    return out.withColumn("keep", F.when(n == 0, False).otherwise(F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))))
