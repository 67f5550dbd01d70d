"""Token ids in binary files: patched frame-of-reference blocks.

A file holds the ids of whole documents one after another, in blocks of 128. A block subtracts its least id and packs what
is left at the width that holds a chosen share of it; greater ones leave their high bits in an exception list. Layout, little-endian:

    "EFPF1\\0\\0\\0"
    blocks: u32 least | u8 width | u8 exceptions | u16 0 | 128 * width / 8 bytes | positions u8 each | high bits u32 each
    footer: block starts u64 each | document ids i64 | null flags u8 | ids in each document u64
    trailer: u64 footer start, blocks, documents, ids | "EFPF1END"

The last block is filled up with its own last id. Files are named by what they hold first; their order is the order of ids.

Defined results: a null or empty text is a document with the end id alone; documents with a null id come first; rows with equal ids are
documents of their own, in the order of their texts (and share a file); an empty table gives no files; further columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import store, words

MAGIC, END = b"EFPF1\0\0\0", b"EFPF1END"
BLOCK = 128
PERCENTILE = 90
FILES = "file string, first_id long, first_null boolean, last_id long, last_null boolean, n_docs long, n_ids long, n_bytes long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """(BLOCK, rows) of numbers below 2**width to (rows, BLOCK * width / 8) bytes."""
    lanes = np.zeros((BLOCK * width // 64, values.shape[1]), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        lanes[word] |= values[i] << np.uint64(shift)
        if shift + width > 64:
            lanes[word + 1] |= values[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(lanes.T.astype("<u8")).view(np.uint8)


def unpack(data: np.ndarray, width: int) -> np.ndarray:
    """(rows, BLOCK * width / 8) bytes to (BLOCK, rows) numbers."""
    out = np.zeros((BLOCK, len(data)), np.uint64)
    if not width:
        return out
    lanes = np.ascontiguousarray(np.ascontiguousarray(data).view("<u8").T)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        v = lanes[word] >> np.uint64(shift)
        if shift + width > 64:
            v |= lanes[word + 1] << np.uint64(64 - shift)
        np.bitwise_and(v, mask, out=out[i])
    return out


def encode_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Blocks of ids, whose number BLOCK divides, and the size of each."""
    rows = ids.reshape(-1, BLOCK).astype(np.uint64)
    least = rows.min(1)
    rest = rows - least[:, None]
    bits = np.maximum((rest.astype(np.float64).view(np.int64) >> 52) - 1022, 0).astype(np.uint8)
    width = np.sort(bits, 1)[:, -(-BLOCK * percentile // 100) - 1].astype(np.int64)
    high = rest >> width[:, None].astype(np.uint64)
    patched = high > 0
    n_exc = patched.sum(1)
    sizes = 8 + BLOCK // 8 * width + 5 * n_exc
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)

    def put(at: np.ndarray, data: np.ndarray) -> None:
        out[at[:, None] + np.arange(data.shape[1])] = data

    put(starts, least.astype("<u4").view(np.uint8).reshape(-1, 4))
    out[starts + 4], out[starts + 5] = width, n_exc
    for w in np.unique(width[width > 0]):
        own = np.flatnonzero(width == w)
        low = np.ascontiguousarray((rest[own] & np.uint64((1 << int(w)) - 1)).T)
        put(starts[own] + 8, pack(low, int(w)))
    row, place = np.nonzero(patched)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n_exc) - n_exc, n_exc)
    base = starts[row] + 8 + BLOCK // 8 * width[row]
    out[base + nth] = place
    put(base + n_exc[row] + 4 * nth, high[row, place].astype("<u4").view(np.uint8).reshape(-1, 4))
    return out.tobytes(), sizes


def decode_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at starts, block by block."""
    get = lambda at, n: data[at[:, None] + np.arange(n)]
    least = np.ascontiguousarray(get(starts, 4)).view("<u4").ravel().astype(np.uint64)
    width, n_exc = data[starts + 4].astype(np.int64), data[starts + 5].astype(np.int64)
    out = np.empty((len(starts), BLOCK), np.uint64)
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        out[own] = unpack(get(starts[own] + 8, BLOCK // 8 * int(w)), int(w)).T
    row = np.repeat(np.arange(len(starts)), n_exc)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n_exc) - n_exc, n_exc)
    base = starts[row] + 8 + BLOCK // 8 * width[row]
    high = np.ascontiguousarray(get(base + n_exc[row] + 4 * nth, 4)).view("<u4").ravel().astype(np.uint64)
    out[row, data[base + nth]] |= high << width[row].astype(np.uint64)
    return (out + least[:, None]).ravel()


class Writer:
    def __init__(self, uri: str, chunk_blocks: int = 2048, percentile: int = PERCENTILE):
        self.file, self.chunk, self.percentile = store.AtomicFile(uri), chunk_blocks * BLOCK, percentile
        self.file.write(MAGIC)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.n_docs = 0
        self.sizes: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(doc_ids.astype("<i8"))
        self.nulls.append(nulls.astype(np.uint8))
        self.counts.append(counts.astype("<u8"))
        self.n_docs += len(doc_ids)
        self.n_ids += len(ids)
        self.held.append(ids.astype(np.uint32))
        self.n_held += len(ids)
        if self.n_held >= self.chunk:
            self._flush(self.n_held // self.chunk * self.chunk)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held)
        self.held, self.n_held = [ids[n:]], len(ids) - n
        for at in range(0, n, self.chunk):
            data, sizes = encode_blocks(ids[at : min(at + self.chunk, n)], self.percentile)
            self.file.write(data)
            self.sizes.append(sizes)

    def close(self) -> None:
        if self.n_held:
            fill = -self.n_held % BLOCK
            last = next(x for x in reversed(self.held) if len(x))[-1]
            self.held.append(np.full(fill, last, np.uint32))
            self.n_held += fill
            self._flush(self.n_held)
        sizes = np.concatenate([np.zeros(0, np.int64), *self.sizes])
        at = self.file.size
        self.file.write((len(MAGIC) + np.cumsum(sizes) - sizes).astype("<u8").tobytes())
        for parts in (self.docs, self.nulls, self.counts):
            self.file.write(np.concatenate(parts).tobytes())
        self.file.write(struct.pack("<4Q", at, len(sizes), self.n_docs, self.n_ids) + END)
        self.file.commit()


class Reader:
    def __init__(self, uri: str):
        fs, path = store.filesystem(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(40, size - 40)
        if self.file.read_at(8, 0) != MAGIC or tail[32:] != END:
            raise ValueError(f"not a token file: {uri}")
        self.footer, self.n_blocks, self.n_docs, self.n_ids = struct.unpack("<4Q", tail[:32])
        foot = self.file.read_at(size - 40 - self.footer, self.footer)
        at = 8 * self.n_blocks
        self.starts = np.frombuffer(foot, "<i8", self.n_blocks)
        self.docs = np.frombuffer(foot, "<i8", self.n_docs, at)
        self.nulls = np.frombuffer(foot, np.uint8, self.n_docs, at + 8 * self.n_docs)
        self.counts = np.frombuffer(foot, "<i8", self.n_docs, at + 9 * self.n_docs)

    def ids(self, first: int, n: int) -> np.ndarray:
        """n ids from number first on, reading no block but theirs."""
        if not n:
            return np.zeros(0, np.uint32)
        a, b = first // BLOCK, -(-(first + n) // BLOCK)
        begin = int(self.starts[a])
        end = int(self.starts[b]) if b < self.n_blocks else self.footer
        data = np.frombuffer(self.file.read_at(end - begin, begin), np.uint8)
        out = decode_blocks(data, self.starts[a:b] - begin)
        return out[first - a * BLOCK : first - a * BLOCK + n].astype("<u4")

    def documents(self, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """Null flag, id and ids of each document, reading about so many ids at a time."""
        at = 0
        for a, b in words.pieces(self.counts.tolist(), most):
            n = int(self.counts[a:b].sum())
            ids, at = self.ids(at, n), at + n
            for k, part in zip(range(a, b), np.split(ids, np.cumsum(self.counts[a:b])[:-1]), strict=True):
                yield int(self.nulls[k]), int(self.docs[k]), part

    def close(self) -> None:
        self.file.close()


def word_encoder(path: str) -> words.Flat:
    """Ids of white-space-free words by a tokenizer of the tokenizers library whose pre-tokens hold no ASCII white space.

    Words go to the tokenizer many at a time, with a special token between them; a word that may itself hold one goes alone.
    """
    return words.sole(("token file", path), lambda: _word_encoder(path))


def _word_encoder(path: str) -> words.Flat:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = min((i, t.content) for i, t in tokenizer.get_added_tokens_decoder().items() if t.special)

    def many(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = [special[1].join(new[a : a + 200]) for a in range(0, len(new), 200)]
        lists = tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.append(np.asarray(e.ids, np.int32), special[0]) for e in lists])
        ends = np.flatnonzero(ids == special[0])
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def encode(new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        odd = [b"<" in w and len(w) > 1 for w in new]
        if not any(odd):
            return many([w.decode() for w in new])
        flat, n = many([w.decode() for w, o in zip(new, odd, strict=True) if not o] or ["a"])
        parts = iter(np.split(flat, np.cumsum(n)[:-1]))
        return words.flat_lists([tokenizer.encode(w.decode(), add_special_tokens=False).ids if o else next(parts) for w, o in zip(new, odd, strict=True)])

    return words.Flat(encode, 800_000)


_SPACE, _ALNUM, _POINT = (np.isin(np.arange(256), list(x)) for x in (b"\t\n\x0b\x0c\r ", b"abcdefghijklmnopqrstuvwxyz0123456789", b".,;:!?"))
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def word_ranges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of lower-case text begin and end. Words lie between ASCII white space; a run of punctuation that follows a letter or digit
    and ends a word is a word of its own, as it is a pre-token of its own."""
    text = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(text, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    run = np.flatnonzero(np.diff(_POINT[data], prepend=False, append=False))
    first, last = run[::2], run[1::2]
    inner = (first > 0) & _ALNUM[data[first - 1]] & ~np.append(text, False)[last]
    cut = first[inner]
    return np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))


def encode_texts(texts: list[bytes], encoder: words.Flat, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, each with end_id after it, and the number of each."""
    odd = [i for i, t in enumerate(texts) if b"<|" in t]  # perhaps a special token, which is told by its case
    if odd:
        ids, counts = encode_texts([b"" if b"<|" in t else t for t in texts], encoder, end_id)
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in odd:
            own = encoder.expand(encoder.look_up(texts[i].split()))[0]
            parts[i] = np.append(np.asarray(own, np.int32), np.int32(end_id))
        return np.concatenate(parts), np.array(list(map(len, parts)), np.int64)
    data = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    limits = np.cumsum([len(t) + 1 for t in texts])
    starts, ends = word_ranges(data)
    ids, n = encoder.expand(words.look_up_ranges(encoder, data, starts, ends))
    ends = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(starts, limits)]
    counts = np.diff(ends, prepend=0)
    return np.insert(ids, ends, end_id), counts + 1


def in_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Partitions whose keys don't overlap, each sorted."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.repartitionByRange(n, F.col(key).asc_nulls_first()).sortWithinPartitions(F.col(key).asc_nulls_first(), text)


def apart(files: DataFrame) -> bool:
    """Whether no id, null among them, is within the range of two files."""
    order = Window.orderBy(F.desc("first_null"), "first_id", "last_id", "file").rowsBetween(Window.unboundedPreceding, -1)
    low, high = F.when(~F.col("first_null"), F.col("first_id")), F.when(~F.col("last_null"), F.col("last_id"))
    crossed = files.select(F.max(high).over(order).alias("before"), low.alias("low"), F.count("*").over(order).alias("nth"))
    return not crossed.where("nth > 0 and (low is null or before >= low)").limit(1).count()


def write(docs: DataFrame, tokenizer: str, *, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", percentile: int = PERCENTILE) -> DataFrame:
    """Write the token files below the shared folder; gives the files, one row each.

    Each task sorts and writes what it reads. If the files that came of it overlap in ids, as after a shuffle, the table is dealt by ranges of ids and
    written once more; what decides is what the files hold, so the layout of a plan that ran before doesn't matter.
    """
    spark = docs.sparkSession
    store.small_batches(spark)
    folder = store.fresh(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out, first, last = word_encoder(tokenizer), None, None, (0, False)
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("doc_id")
            none = keys.is_null().to_numpy(zero_copy_only=False)
            held = keys.fill_null(0).to_numpy()
            for a, b in words.pieces(list(map(len, texts)), 1 << 20):
                if out is None:
                    out, first = Writer(f"{folder}/{uuid.uuid4().hex}.pfor", percentile=percentile), (held[a], none[a])
                ids, counts = encode_texts(texts[a:b], encoder, end_id)
                out.add(held[a:b], none[a:b], counts, ids)
                last = (held[b - 1], none[b - 1])
        if out is not None:
            out.close()
            row = {"file": out.file.uri, "first_id": int(first[0]), "first_null": bool(first[1]), "last_id": int(last[0]), "last_null": bool(last[1]), "n_docs": out.n_docs, "n_ids": out.n_ids, "n_bytes": out.file.size}
            kinds = [pa.string(), *[pa.int64(), pa.bool_()] * 2, *[pa.int64()] * 3]
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema(list(zip(row, kinds, strict=True))))

    files = store.cut(rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").mapInArrow(put, FILES), "token-files")
    if apart(files):
        return files
    store.remove(spark, folder)
    return store.cut(in_order(rows, "doc_id", "text").mapInArrow(put, FILES), "token-files")


def read(files: DataFrame, digest: Callable[[np.ndarray], int] = lambda ids: zlib.crc32(ids.tobytes())) -> DataFrame:
    """Per document of the files: where it starts in the sequence of all ids, its number of ids and their checksum."""
    order = Window.orderBy(F.desc("first_null"), "first_id", "last_id", "file").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for row in batch.to_pylist():
                reader, start, held = Reader(row["file"]), row["base"], []
                for none, key, ids in reader.documents():
                    held.append((None if none else key, start, len(ids), digest(ids)))
                    start += len(ids)
                reader.close()
                for a in range(0, len(held), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*held[a : a + 10_000], strict=True)], names=names)

    n = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return placed.select("file", "base").repartition(n, "file").mapInArrow(get, DOCS)


def digest_table(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    return read(write(docs, tokenizer))
