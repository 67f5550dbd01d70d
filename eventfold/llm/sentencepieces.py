"""SentencePiece models on the tokenizers library.

The model's protobuf is parsed here, and its normaliser, metaspace marker, scores (unigram log-probabilities, or BPE merge ranks) and byte fallback are
rebuilt as a tokenizers pipeline. Texts are cut where no piece can reach across (before a run of spaces, before a line
feed), and each chunk is encoded and decoded by the tokenizers library once per worker, in multithreaded batches. These ids are the result. Parity is verified beside it: each new
chunk is encoded by the sentencepiece library too, and a document says whether all its chunks agree; the ids of a chunk that differs are replaced by the sentencepiece library's. A model whose pieces reach across such places, that has
user-defined pieces or a normaliser that rewrites characters is encoded by whole texts instead, with the same check.

Defined results: a null text is an empty one and has no ids; rows are encoded one by one, so repeated and null ids stay; an empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store, words

NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
APART, ONE_WAY = 1, 2  #: flags of a chunk: the libraries differ; decoding doesn't give the text
MARK = "▁"


@dataclass
class Model:
    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    unk_id: int
    charsmap: bytes
    dummy_prefix: bool
    one_space: bool
    escape: bool


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        c = data[i]
        value |= (c & 127) << shift
        i, shift = i + 1, shift + 7
        if c < 128:
            return value, i


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protobuf message."""
    i = 0
    while i < len(data):
        key, i = _varint(data, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(data, i)
        elif kind in (1, 2, 5):
            n = 8 if kind == 1 else 4
            if kind == 2:
                n, i = _varint(data, i)
            value, i = data[i : i + n], i + n
        else:
            raise ValueError(f"wire type {kind}")
        yield key >> 3, value


def parse(data: bytes) -> Model:
    pieces, trainer, normalizer = [], {}, {}
    for number, value in fields(data):
        if number == 1:
            got = dict(fields(value))
            pieces.append((got[1].decode(), struct.unpack("<f", got[2])[0] if 2 in got else 0.0, got.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            normalizer = dict(fields(value))
    unknown = next(i for i, p in enumerate(pieces) if p[2] == UNKNOWN)
    return Model(pieces, trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), unknown, normalizer.get(2, b""), bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1)), bool(normalizer.get(5, 1)))


def merges(model: Model) -> list[tuple[str, str]]:
    """For BPE: all pairs of pieces that make a piece, better pieces first."""
    rank = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for p, score, kind in model.pieces:
        if kind in (NORMAL, USER_DEFINED):
            pairs = [(p[:i], p[i:]) for i in range(1, len(p)) if p[:i] in rank and p[i:] in rank]
            found += [(-score, rank[a], rank[b], a, b) for a, b in pairs]
    return [x[3:] for x in sorted(found)]


def rebuild(model: Model, normalize: bool = True):
    """The tokenizer; without normalize for chunks that hold the marker already."""
    from tokenizers import Tokenizer, decoders, models, normalizers

    if model.kind == UNIGRAM:
        core = models.Unigram([p[:2] for p in model.pieces], model.unk_id, model.byte_fallback)
    elif model.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocab, merges(model), unk_token=model.pieces[model.unk_id][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models can be rebuilt")
    out = Tokenizer(core)
    if normalize:
        steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
        if model.one_space:
            from tokenizers import Regex

            steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        steps += [normalizers.Prepend(" ")] if model.dummy_prefix else []
        steps += [normalizers.Replace(" ", MARK)] if model.escape else []
        out.normalizer = normalizers.Sequence(steps)
    tail = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
    return out


def in_chunks(model: Model) -> bool:
    """Whether a text's ids are those of its chunks."""
    plain = not model.charsmap and not model.one_space and model.dummy_prefix and model.escape and model.byte_fallback
    plain = plain and any(p == MARK and kind == NORMAL for p, _, kind in model.pieces)
    return plain and not any(kind == USER_DEFINED or "\n" in p or MARK in p.lstrip(MARK) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED))


SPACED = re.compile(rb" ( *[^ ]*)")


def chunks(text: bytes) -> list[bytes]:
    """A text cut before each run of spaces and each line feed. A chunk that doesn't begin with a line feed has lost one space, at the start of the text the one that is put before it."""
    lines = text.split(b"\n")
    out: list[bytes] = []
    for i, line in enumerate(lines):
        cut = SPACED.findall(b" " + line) if b"  " in line or line[:1] == b" " else line.split(b" ")
        if i:
            if line[:1] == b" ":  # the spaces after a line feed are a chunk apart, with all their spaces
                out.append(b"\n")
                cut = SPACED.findall(line)
            else:
                cut[0] = b"\n" + cut[0]
        out += cut
    return out if text else []


class Encoder:
    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            self.model = parse(f.read())
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunked = in_chunks(self.model)
        self._normalized = None
        self.bare = rebuild(self.model, normalize=False)
        self.cache = words.Flat(self._learn)

    def _learn(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks; each list has flags before it. The libraries' results are large, so they are asked by some thousands."""
        parts = [self._some(new[a : a + 4000]) for a in range(0, len(new), 4000)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _some(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        keys = [w.decode() for w in new]
        got = [e.ids for e in self.bare.encode_batch_fast([k if k[:1] == "\n" else MARK + k.replace(" ", MARK) for k in keys], add_special_tokens=False)]
        back = self.bare.decode_batch(got, skip_special_tokens=False)
        flags = np.zeros(len(keys), np.int32)
        flags[[i for i, (k, b) in enumerate(zip(keys, back, strict=True)) if b != k]] = ONE_WAY
        for i in self.differ(keys, got):
            got[i], flags[i] = self.library.encode(keys[i])[keys[i][:1] == "\n" :], flags[i] | APART
        flat, n = words.flat_lists(got)
        return np.insert(flat, np.cumsum(n) - n, flags), n + 1

    def differ(self, keys: list[str], got: list[list[int]]) -> list[int]:
        """Parity: which chunks the sentencepiece library encodes in another way. It puts a space before a line feed, and none before an empty text."""
        other = self.library.encode(keys, num_threads=1)
        return [i for i, (k, g, r) in enumerate(zip(keys, got, other, strict=True)) if g != r and k and (k[0] != "\n" or g != r[1:])]

    @property
    def whole(self):
        """The tokenizer for whole texts, made when one is needed."""
        if self._normalized is None:
            self._normalized = rebuild(self.model)
        return self._normalized

    def _whole(self, texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        held = [t.decode() for t in texts]
        got = [e.ids for e in self.whole.encode_batch_fast(held, add_special_tokens=False)]
        back = self.whole.decode_batch(got, skip_special_tokens=False)
        right = self.library.encode(held, num_threads=1)
        flags = [APART * (g != r) | ONE_WAY * (b != t) for t, g, r, b in zip(held, got, right, back, strict=True)]
        return [np.array(r if g != r else g, np.int32) for g, r in zip(got, right, strict=True)], np.array(flags, np.int32)

    def encode(self, texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of each text, and its flags."""
        if not self.chunked:
            return self._whole(texts)
        marked = [i for i, t in enumerate(texts) if MARK.encode() in t]
        if marked:  # the marker itself may join the spaces beside it
            ids, flags = self.encode([b"" if MARK.encode() in t else t for t in texts])
            for i, x, flag in zip(marked, *self._whole([texts[i] for i in marked]), strict=True):
                ids[i], flags[i] = x, flag
            return ids, flags
        split = list(map(chunks, texts))
        flat, n = self.cache.expand(self.cache.look_up([w for ws in split for w in ws]))
        n_chunks = np.fromiter(map(len, split), np.int64, len(split))
        ends_of = np.cumsum(n_chunks)
        heads = np.cumsum(n) - n
        ids = np.delete(flat, heads) if len(n) else flat
        ends = np.concatenate([[0], np.cumsum(n - 1)])[ends_of]
        flags = np.zeros(len(texts), np.int32)
        for bit in (APART, ONE_WAY):
            with_bit = np.concatenate([[0], np.cumsum(flat[heads] & bit > 0)]) if len(n) else np.zeros(1, np.int64)
            flags |= np.where(np.diff(with_bit[ends_of], prepend=0) > 0, bit, 0).astype(np.int32)
        return np.split(ids, ends[:-1]), flags


def encoder(path: str) -> Encoder:
    return words.sole(("sentencepieces", path), lambda: Encoder(path))


def encode(docs: DataFrame, path: str, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = True) -> DataFrame:
    """Columns keep, ids (with with_ids), n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers), parity (both libraries agree),
    round_trip (decoding the ids gives the text)."""
    store.small_batches(docs.sparkSession)
    rows = docs.select(*keep, F.col(text_col).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = [t or b"" for t in batch.column("_text").to_pylist()]
            for a, b in words.pieces(list(map(len, texts)), 1 << 20):
                part = texts[a:b]
                ids, flags = own.encode(part)
                cols = [batch.column(c)[a:b] for c in keep]
                if with_ids:
                    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32))))
                cols += [
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array(flags & APART == 0),
                    pa.array(flags & ONE_WAY == 0),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, *["ids"] * with_ids, "n_tokens", "ids_crc32", "parity", "round_trip"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{kinds}, {'ids array<int>, ' * with_ids}n_tokens long, ids_crc32 long, parity boolean, round_trip boolean")


def decode(encoded: DataFrame, path: str, *, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns keep and the text of the ids; null ids give a null text."""
    rows = encoded.select(*keep, F.col(ids_col).cast("array<int>").alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            ids = batch.column("_ids").to_pylist()
            texts = own.whole.decode_batch([x or [] for x in ids], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array([t if x is not None else None for t, x in zip(texts, ids, strict=True)], pa.string())], names=[*keep, "text"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{kinds}, text string")
