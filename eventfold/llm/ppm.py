"""Scores of texts by prediction by partial matching: bytes in contexts of up to ORDER bytes.

A text is its words, A-Z lower-cased, joined by one space, then an end: the same event that the base model scores, word by word, from counts.

The trie of byte contexts is kept as sorted codes: a node of depth j is a code of j bytes, its children are the codes one byte longer, and its suffix is a mask away.
A byte is predicted from its longest context that was seen: by (2n - 1) / 2t if it was seen there n of t times, else by an escape of d / 2t, d the number of different bytes seen,
to the context one shorter, where the bytes that the longer one had seen are excluded; below the empty context the bytes that are left are alike. As all that a context has seen its suffixes
have seen too, exclusion needs two numbers of a node: the bytes it has seen, and how often its suffix has seen those.

Counting: a run of texts is counted within a task, then by (word, code) over all tasks; words are counted in the same pass.
Shards: a code is dealt by a hash of the three bytes before its last, which it shares with all its suffixes of four bytes and more. Codes of up to three bytes, 2**24 at most, are summed and broadcast.
Scoring: documents go in blocks of bounded bytes. A block asks each shard for its distinct codes, and shards of words, dealt by checksum, for its distinct words, and keeps its texts as places among those words; questions of a shard go in salted groups
of a bounded number, and the answers (32-bit floats, whole counts) meet the block's texts. One exchange holds texts and questions for both uses. The model is sent once for each salt.

Defined results: a null or empty text, or one of white space, is an end alone; a null id isn't learned from and is held out; rows that repeat an id are scored one by one; further columns are ignored;
without any training text nothing is known, train_tokens is 0 and each byte is one of SYMBOLS.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store, words

ORDER = 5
SHORT = 3  #: bytes of the codes that are broadcast
END = b"\n"  #: ends a text and stands before it; white space within texts is a single space
SYMBOLS = 256 - 4  #: bytes that may occur: all but the other white space
SMOOTH = 0.1
RUN_CODES = 1 << 22
HELD_BYTES = 1 << 21
SHARD_CODES = 1 << 18
SHARD_WORDS = 1 << 17
MIN_SHARDS = 8
BLOCK_BYTES = 3 << 20
BLOCK_DOCS = 1 << 14
GROUP_CODES = 1 << 26
ASK_CODES = 1 << 21
HELD_OUT = 10


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case; the end isn't among them."""
    return text.lower().split()


def codes(lines: list[bytes], order: int = ORDER) -> np.ndarray:
    """For each byte of each line and for its end: that byte, and the order bytes before it above. A line of n bytes gives n + 1 codes."""
    a = np.frombuffer(END * order + (END * order).join(lines) + END, np.uint8).astype(np.int64)
    n = len(a) - order
    out = a[:n].copy()
    for i in range(1, order + 1):
        out <<= 8
        out |= a[i : i + n]
    if len(lines) > 1 and order > 1:  # between two lines all but one of the ends only stand before the second
        ends = np.cumsum([len(x) + order for x in lines[:-1]]) - order
        keep = np.ones(n, bool)
        keep[(ends[:, None] + np.arange(1, order)).ravel()] = False
        out = out[keep]
    return out


def distinct(code: np.ndarray) -> np.ndarray:
    """Distinct codes in order."""
    code = np.sort(code)
    return code[np.diff(code, prepend=-1) != 0]


def merged(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and their sums of n."""
    at, own = pd.factorize(code)
    sums = np.bincount(at, n, len(own)).astype(np.int64)
    order = np.argsort(own)
    return own[order], sums[order]


@dataclass
class Level:
    """The contexts of one length: the codes below them and their counts; of each context the sum, the number of codes, and its suffix's sum over the same bytes."""

    code: np.ndarray
    n: np.ndarray
    context: np.ndarray
    total: np.ndarray
    kinds: np.ndarray
    covered: np.ndarray


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where wanted keys stand among sorted ones, and whether they do."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _pick(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at, known = _find(keys, wanted)
    return np.where(known, values[at], 0) if len(keys) else np.zeros(len(wanted), np.int64)


def shorter(code: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of size bytes without their first: the distinct ones, their counts, and where each went."""
    out, at = np.unique(code & ((1 << 8 * (size - 1)) - 1), return_inverse=True)
    return out, np.bincount(at, n, len(out)).astype(np.int64), at


def levels(code: np.ndarray, n: np.ndarray, longest: int, least: int, base: tuple[np.ndarray, np.ndarray] | None = None) -> list[Level]:
    """From contexts of longest bytes down to least. base: the codes one shorter than the least and their counts, where those aren't all among the suffixes of code."""
    out = []
    for j in range(longest, least - 1, -1):
        context, at = np.unique(code >> 8, return_inverse=True)
        below, count, to = shorter(code, n, j + 1)
        above = _pick(*base, below)[to] if base is not None and j == least else count[to]
        add = lambda w: np.bincount(at, w, len(context)).astype(np.int64)
        out.append(Level(code, n, context, add(n), add(None), add(above)))
        code, n = below, count
    return out


def log10_of(found: list[Level], wanted: np.ndarray) -> np.ndarray:
    """Log10 of the probability of each wanted code's last byte after the bytes before. found: contexts of all lengths, longest first; the last is the empty one."""
    out, left = np.zeros(len(wanted)), np.arange(len(wanted))  # what hasn't been predicted yet
    less, fewer = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
    for i, level in enumerate(found):
        own = wanted[left] & ((1 << 8 * (len(found) - i)) - 1)
        n = _pick(level.code, level.n, own)
        at, seen = _find(level.context, own >> 8)
        total, kinds, covered = (np.where(seen, x[at], 0) if len(x) else np.zeros(len(own), np.int64) for x in (level.total, level.kinds, level.covered))
        hit, escape = n > 0, (n == 0) & (kinds > fewer)
        out[left[hit]] += np.log10((2 * n[hit] - 1) / (2 * (total - less)[hit]))
        out[left[escape]] += np.log10((kinds - fewer)[escape] / (2 * (total - less)[escape]))
        left, less, fewer = left[~hit], covered[~hit], kinds[~hit]
    out[left] -= math.log10(max(SYMBOLS - len(found[-1].code), 1))
    return out


def learned(id_col: str = "doc_id") -> Column:
    """Whether a row teaches: by checksum of its id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_OUT != 0, F.lit(False))


@dataclass
class Model:
    """counts: word or code, n. base: the codes of SHORT bytes and their counts. n_texts: training texts; n_tokens: their words and ends; n_kinds: different ones."""

    counts: DataFrame
    base: Broadcast
    n_texts: int
    n_tokens: int
    n_kinds: int
    n_codes: int
    order: int


def train(docs: DataFrame, *, text_col: str = "text", order: int = ORDER) -> Model:
    """Counts over all rows of docs."""
    spark = docs.sparkSession

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.sole("counts", object)  # what other operators keep in this worker goes
        held: list[bytes] = []
        code, n, size, seen = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, Counter()

        def merge() -> None:
            nonlocal code, n, size
            if held:
                new, m = np.unique(codes(held, order), return_counts=True)
                code, n = merged(np.concatenate([code, new]), np.concatenate([n, m]))
            held.clear()
            size = 0

        def give() -> Iterator[pa.RecordBatch]:
            nonlocal code, n
            k = len(code)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.binary()), pa.array(code), pa.array(n)], names=["word", "code", "n"])
            code, n = code[:0], n[:0]
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.nulls(len(seen), pa.int64()), pa.array(seen.values(), pa.int64())], names=["word", "code", "n"])
            seen.clear()

        for batch in batches:
            for text in batch.column("text").to_pylist():
                own = tokens(text)
                seen.update(own)
                seen[END] += 1  # no word
                held.append(b" ".join(own))
                size += len(held[-1]) + order
                if size > HELD_BYTES:
                    merge()
                    if len(code) + 4 * len(seen) > RUN_CODES:
                        yield from give()
        merge()
        yield from give()

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    counts = store.cut(texts.mapInArrow(add, "word binary, code long, n long").groupBy("word", "code").agg(F.sum("n").alias("n")), "ppm-counts")
    is_code = F.col("code").isNotNull()
    sums = counts.agg(F.sum(F.when(~is_code, F.col("n"))), F.count_if(~is_code), F.max(F.when(F.col("word") == F.lit(END), F.col("n"))), F.count_if(is_code)).first()
    few = counts.where(is_code).groupBy(F.col("code").bitwiseAND((1 << 8 * SHORT) - 1).cast("int").alias("code")).agg(F.sum("n").alias("n")).toArrow()  # 2**24 rows at most
    code, n = few.column("code").to_numpy().astype(np.int64), few.column("n").to_numpy()
    at = np.argsort(code)
    return Model(counts, spark.sparkContext.broadcast((code[at], n[at])), sums[2] or 0, sums[0] or 0, sums[1], sums[3], order)


def gram_shard(code: np.ndarray, n_shards: int) -> np.ndarray:
    """By the three bytes before the last; so does gram_shard_column."""
    return ((code >> 8 & 0xFFFFFF) * 0x9E3779B1 >> 16 & 0xFFFFFF) % n_shards


def gram_shard_column(n_shards: int) -> Column:
    three = F.shiftright("code", 8).bitwiseAND(0xFFFFFF)
    return (F.shiftright(three * F.lit(0x9E3779B1), 16).bitwiseAND(0xFFFFFF) % n_shards).cast("int")


def pack(code: np.ndarray) -> bytes:
    """Rising codes as gaps, by byte planes."""
    gap = np.diff(code, prepend=0).astype("<u8").view(np.uint8).reshape(-1, 8)
    return zstandard.compress(np.ascontiguousarray(gap.T).tobytes(), 3)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view("<u8").astype(np.int64))


def _squeeze(data: bytes) -> bytes:
    return zstandard.compress(data, 3)


TEXT = -1  #: the shard of rows that hold a block's documents
BLOCKS = "shard int, block long, data binary"


def _by_shard(own: list[bytes], n_shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of distinct words by checksum's shard, then as they come, and where each shard ends."""
    shard = np.fromiter(map(zlib.crc32, own), np.int64, len(own)) % n_shards
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(n_shards + 1))


def _numbered(texts: list[list[bytes]]) -> tuple[list[bytes], np.ndarray]:
    """The different words of texts as they come, and the number of each; -1 after each text."""
    numbers = words._Numbers()
    each = [np.fromiter(map(numbers.__getitem__, x), np.int32, len(x)) for x in texts]
    end = np.array([-1], np.int32)
    return numbers.new, np.concatenate([y for x in each for y in (x, end)])


def blocks(docs: DataFrame, n_grams: int, n_words: int, order: int) -> DataFrame:
    """A row with each block's documents, and rows with its distinct codes and words by the shard that knows them: codes' shards come first."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.sole("blocks", object)
        made, rows, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal made, rows, texts, size
            lines = [b" ".join(x) for x in texts]
            own, number = _numbered(texts)
            texts = []
            at, ends = _by_shard(own, n_words)
            place = np.empty(len(own) + 1, np.int32)
            place[at], place[-1] = np.arange(len(own)), -1
            own = [own[i] for i in at.tolist()]
            held = pickle.dumps((rows, b"\n".join(own), place[number].tobytes()), 5)
            out = [(n_grams + s, _squeeze(b"\n".join(own[ends[s] : ends[s + 1]]))) for s in range(n_words) if ends[s] < ends[s + 1]]
            asked = distinct(codes(lines, order))
            shard = gram_shard(asked, n_grams)
            at = np.argsort(shard, kind="stable")
            ends = np.searchsorted(shard[at], np.arange(n_grams + 1))
            out += [(TEXT, zstandard.compress(held, 1))] + [(s, pack(asked[at[ends[s] : ends[s + 1]]])) for s in range(n_grams) if ends[s] < ends[s + 1]]
            batch = pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([made] * len(out), pa.int64()), pa.array([x[1] for x in out], pa.binary())], names=["shard", "block", "data"])
            made, rows, size = made + 1, [], 0
            return batch

        for batch in batches:
            for key, held, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text")], strict=True):
                rows.append((key, held))
                texts.append(tokens(text))
                size += len(text) + 100
                if size >= BLOCK_BYTES or len(rows) == BLOCK_DOCS:
                    yield close()
        if rows:
            yield close()

    return docs.mapInArrow(cut, BLOCKS)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs."""
    spark = docs.sparkSession
    store.small_batches(spark)
    parts, order, base = int(spark.conf.get("spark.sql.shuffle.partitions")), model.order, model.base
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (~learned(id_col)).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0  # as many codes at most
    n_grams, n_words = max(MIN_SHARDS, -(-model.n_codes // SHARD_CODES)), max(1, -(-model.n_kinds // SHARD_WORDS))
    salts = max(1, -(-n_bytes // (GROUP_CODES * n_grams)))
    dealt = blocks(rows, n_grams, n_words, order).repartition(parts, "block")
    here = lambda wanted: wanted | (F.spark_partition_id() < 0)  # noqa: E731  not a condition that is pushed below the exchange, which would make two of it
    texts, asked = dealt.where(here(F.col("shard") == TEXT)), dealt.where(here(F.col("shard") != TEXT))
    n_texts, n_tokens, floor = model.n_texts, model.n_tokens, model.n_tokens + SMOOTH * (model.n_kinds + 1)

    def answer(key: tuple, known: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(questions) and key[0] >= n_grams:
            counts = dict(zip(known["word"], known["n"], strict=True))
            for block, data in zip(questions["block"], questions["data"], strict=True):
                out.append((key[0], block, _squeeze(np.array([counts.get(w, 0) for w in zstandard.decompress(data).split(b"\n")], "<i8").tobytes())))
        elif len(questions):
            known = known.sort_values("code")
            code, n = known["code"].to_numpy(np.int64), known["n"].to_numpy(np.int64)
            short, m = base.value
            found = levels(code, n, order, SHORT, (short, m)) + levels(short, m, SHORT - 1, 0)
            asked = [unpack(x) for x in questions["data"]]
            for a, b in words.pieces([len(x) for x in asked], ASK_CODES):
                logs = log10_of(found, np.concatenate(asked[a:b])).astype("<f4")
                ends = np.cumsum([0, *map(len, asked[a:b])])
                out += [(key[0], block, zstandard.compress(logs[i:j].tobytes(), 1)) for block, i, j in zip(questions["block"].iloc[a:b], ends[:-1], ends[1:], strict=True)]
        return pd.DataFrame(out, columns=["shard", "block", "data"])

    def total(key: tuple, texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows, own, number = pickle.loads(zstandard.decompress(texts["data"].iloc[0]))
        own, number = own.split(b"\n"), np.frombuffer(number, np.int32)
        ends = np.flatnonzero(number < 0)
        begins = np.concatenate([[0], ends[:-1] + 1])
        lines = [b" ".join([own[i] for i in number[a:b].tolist()]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        answers = answers.sort_values("shard")
        grams, known = ([zstandard.decompress(x) for x in answers.loc[which, "data"]] for which in (answers["shard"] < n_grams, answers["shard"] >= n_grams))
        starts = np.cumsum([0, *(len(x) + 1 for x in lines[:-1])])
        at, asked = pd.factorize(codes(lines, order))
        del lines
        rank = np.argsort(asked)
        logs = np.empty(len(asked))
        logs[rank[np.argsort(gram_shard(asked[rank], n_grams), kind="stable")]] = np.frombuffer(b"".join(grams), "<f4")  # as many as were asked for, or this fails
        scores = np.add.reduceat(logs[at], starts)
        seen = np.append(np.frombuffer(b"".join(known), "<i8"), n_texts)  # the end is the last
        log = np.array([math.log10(c + SMOOTH) for c in seen.tolist()]) - math.log10(floor)
        columns = {"n_tokens": np.diff(ends, prepend=-1), "n_known": np.add.reduceat((seen > 0)[number].astype(np.int64), begins), "train_tokens": n_tokens, "base_score": np.add.reduceat(log[number], begins), "score": scores}
        return pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "held_out": [r[1] for r in rows]} | columns)

    is_code = F.col("code").isNotNull()
    shard = F.when(is_code, gram_shard_column(n_grams)).otherwise((n_grams + F.crc32("word") % n_words).cast("int"))
    left = model.counts.where(is_code | (F.col("word") != F.lit(END))).withColumn("shard", shard).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    groups = asked.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
    answers = left.groupBy("shard", "salt").cogroup(groups.groupBy("shard", "salt")).applyInPandas(answer, "shard int, block long, data binary")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(total, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def pretrained(docs: DataFrame, *, order: int = ORDER) -> DataFrame:
    """Every row of docs scored by what the rows that teach hold."""
    store.small_batches(docs.sparkSession)
    return score(docs, train(docs.where(learned()), order=order))


def adaptive_bits(line: bytes, order: int = ORDER) -> float:
    """The code length of a line and its end by a model that starts empty and learns each byte after it is coded."""
    seen: dict[bytes, Counter] = defaultdict(Counter)
    data, bits = END * order + line + END, 0.0
    for i in range(order, len(data)):
        out, excluded, p = data[i], {}, 1.0
        for j in range(order, -1, -1):
            counts = seen.get(data[i - j : i])
            if counts is None:
                continue
            t, d = sum(n for b, n in counts.items() if b not in excluded), len(counts) - len(excluded)
            if out in counts:
                p *= (2 * counts[out] - 1) / (2 * t)
                break
            if d:
                p *= d / (2 * t)
            excluded = counts
        else:
            p /= max(SYMBOLS - len(excluded), 1)
        bits -= math.log2(p)
        for j in range(order + 1):
            seen[data[i - j : i]][out] += 1
    return bits


def adaptive(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """doc_id, n_bytes, bits: what each row's text takes on its own, whatever the others hold. Memory grows with the longest text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [b" ".join(tokens(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, lines), pa.int64()), pa.array([adaptive_bits(x, order) for x in lines], pa.float64())], names=["doc_id", "n_bytes", "bits"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(measure, "doc_id long, n_bytes long, bits double")
