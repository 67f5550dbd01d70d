"""Token counts that follow edits: a segment tree over the pre-tokens of each document.

Byte-level BPE merges within pre-tokens only, so a document's count is the sum over its pre-tokens. They are the leaves, gathered in blocks;
the inner nodes of a complete binary tree over the blocks hold sums of characters and tokens. An edit finds its leaves by descending the character sums, cuts the
text again from the leaf CONTEXT characters before the edit up to the first old boundary behind it where the cuts agree, encodes the new leaves only, and updates the sums on
the paths of the touched blocks. Trees are kept as a table (grown): the text and, packed, the characters and tokens of each leaf. A later table of edits is applied to it (apply), which gives the next
such table; leaves are cut from the text only in blocks that an edit touches, and nothing is encoded but new leaves. The pre-token pattern looks at most two characters past a match and never back, so CONTEXT = 3 and one agreeing
boundary make the result that of a full count.

Defined results: a null text is an empty one with 0 tokens; null edits are none; edits apply in order, each to the text left by the one before; places
and lengths beyond the text are cut to it, negative ones count as 0, a null replacement is empty; rows are counted one by one, so repeated and null ids stay.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store, words

#: Fixed value: the pre-token pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTEXT = 3
BLOCK = 64
CACHE = 300_000


class Counter:
    """Tokens of a pre-token."""

    def __init__(self, ranks_path: str, pattern: str = PATTERN):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.library = tiktoken.Encoding("edits", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def counts(self, parts: list[str]) -> list[int]:
        known = self.known
        if len(known) > CACHE:
            known.clear()
        for p in set(parts).difference(known):
            known[p] = len(self.library.encode_ordinary(p))
        return [known[p] for p in parts]

    def full(self, text: str) -> int:
        return len(self.library.encode_ordinary(text))


class Tree:
    def __init__(self, text: str, counter: Counter):
        self.counter, self.encoded = counter, 0
        parts = counter.pattern.findall(text)
        self.encoded = len(parts)
        self._load(text, np.fromiter(map(len, parts), np.int64, len(parts)), np.array(counter.counts(parts), np.int64))

    @classmethod
    def unpack(cls, text: str, data: bytes, counter: Counter) -> Tree:
        """The tree that pack gave, over its text; nothing is encoded."""
        raw = zstandard.decompress(data)
        n = struct.unpack_from("<I", raw)[0]
        out = cls.__new__(cls)
        out.counter, out.encoded = counter, 0
        out._load(text, *np.frombuffer(raw, "<u4", 2 * n, 4).astype(np.int64).reshape(2, n))
        return out

    def pack(self) -> bytes:
        """Characters and tokens of all leaves."""
        blocks = [(self.lengths[b], self.counts[b]) for b in range(len(self.counts))]
        lengths, counts = ([x for block in blocks for x in block[i]] for i in (0, 1))
        return zstandard.compress(struct.pack("<I", len(lengths)) + np.array(lengths, "<u4").tobytes() + np.array(counts, "<u4").tobytes(), 1)

    def _load(self, text: str, lengths: np.ndarray, counts: np.ndarray) -> None:
        cut = range(0, max(len(lengths), 1), BLOCK)
        ends = np.cumsum(lengths)
        bounds = [0, *[int(ends[min(a + BLOCK, len(lengths)) - 1]) if len(lengths) else 0 for a in cut]]
        self.texts = [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        self.lengths = [lengths[a : a + BLOCK].tolist() for a in cut]
        self.counts = [counts[a : a + BLOCK].tolist() for a in cut]
        self.cut: dict[int, list[str]] = {}
        n = 1
        while n < len(self.texts):
            n *= 2
        self.leaves, self.chars, self.tokens = n, [0] * (2 * n), [0] * (2 * n)
        for i, (t, c) in enumerate(zip(self.texts, self.counts, strict=True)):
            self.chars[n + i], self.tokens[n + i] = len(t), sum(c)
        for i in range(n - 1, 0, -1):
            self.chars[i], self.tokens[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.tokens[2 * i] + self.tokens[2 * i + 1]

    def parts(self, b: int) -> list[str]:
        """The leaves of a block, cut when they are first asked for."""
        if b not in self.cut:
            ends = np.cumsum([0, *self.lengths[b]]).tolist()
            self.cut[b] = [self.texts[b][x:y] for x, y in zip(ends, ends[1:], strict=False)]
        return self.cut[b]

    def _put(self, b: int, parts: list[str], counts: list[int]) -> None:
        self.cut[b], self.texts[b], self.lengths[b], self.counts[b] = parts, "".join(parts), list(map(len, parts)), counts

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_pieces(self) -> int:
        return sum(map(len, self.lengths))

    def text(self) -> str:
        return "".join(self.texts)

    def find(self, place: int) -> tuple[int, int, int]:
        """Block and leaf that hold the character at place, and where the leaf begins; past the end the last leaf's end."""
        if place >= self.n_chars:
            b = len(self.texts) - 1
            return b, len(self.lengths[b]), self.n_chars
        i, at = 1, 0
        while i < self.leaves:
            i *= 2
            if place >= at + self.chars[i]:
                at, i = at + self.chars[i], i + 1
        b = i - self.leaves
        for j, n in enumerate(self.lengths[b]):
            if place < at + n:
                return b, j, at
            at += n
        raise AssertionError("sums of characters are wrong")

    def edit(self, start: int, length: int, replacement: str) -> None:
        start = min(max(start, 0), self.n_chars)
        end = min(start + max(length, 0), self.n_chars)
        if start == end and not replacement:
            return
        b0, j0, begin = self.find(max(start - CONTEXT, 0))
        if begin > start or (begin == self.n_chars and j0 > 0):
            j0, begin = j0 - 1, begin - self.lengths[b0][j0 - 1]
        # old leaves behind the edit, taken as they are needed
        b, j = b0, j0
        old, bounds, at = [], {}, begin
        text, n_new, shift = "", 0, len(replacement) - (end - start)
        want = end + 64
        new: list[str] = []
        while True:
            while at < want and b < len(self.texts):
                if j >= len(self.lengths[b]):
                    b, j = b + 1, 0
                    continue
                p = self.parts(b)[j]
                old.append(p)
                at, j = at + len(p), j + 1
                bounds[at] = (b, j)
            whole = "".join(old)
            text = whole[: start - begin] + replacement + whole[end - begin :]
            last = at >= self.n_chars
            new, meets = [], None
            for m in self.counter.pattern.finditer(text):
                if not last and m.end() > len(text) - CONTEXT:
                    break  # what follows may change this one
                new.append(m.group())
                place = begin + m.end() - shift
                if place >= end and place in bounds and m.end() >= start - begin + len(replacement):
                    meets = bounds[place]
                    break
            if meets is not None or last:
                break
            want = at + max(4 * (want - end), 64)
        b1, j1 = meets if meets is not None else (len(self.texts) - 1, len(self.lengths[-1]))
        counts = self.counter.counts(new)
        self.encoded += len(new)
        tail, tail_counts = self.parts(b1)[j1:], self.counts[b1][j1:]
        new, counts = self.parts(b0)[:j0] + new, self.counts[b0][:j0] + counts
        for x in range(b0 + 1, b1):
            self._put(x, [], [])
        if b1 == b0:
            new, counts = new + tail, counts + tail_counts
        else:
            self._put(b1, tail, tail_counts)
        self._put(b0, new, counts)
        if max(len(new), len(tail)) > 4 * BLOCK:
            flat = lambda x: np.array([v for block in x for v in block], np.int64)
            self._load(self.text(), flat(self.lengths), flat(self.counts))
            return
        for x in range(b0, b1 + 1):
            i = self.leaves + x
            self.chars[i], self.tokens[i] = len(self.texts[x]), sum(self.counts[x])
        level = {(self.leaves + x) // 2 for x in range(b0, b1 + 1)}
        while level and 0 not in level:
            for i in level:
                self.chars[i], self.tokens[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.tokens[2 * i] + self.tokens[2 * i + 1]
            level = {i // 2 for i in level}


def counter(path: str) -> Counter:
    return words.sole(("edit counts", path), lambda: Counter(path))


def _fields(rows: DataFrame, keep: tuple[str, ...]) -> str:
    return "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)


def grown(docs: DataFrame, path: str, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns keep, text, tree and n_tokens: the tree of each document, to be written and edited later."""
    store.small_batches(docs.sparkSession)
    rows = docs.select(*keep, F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            trees = [Tree(t, own) for t in texts]
            packed = pa.array([t.pack() for t in trees], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(texts, pa.string()), packed, pa.array([t.n_tokens for t in trees], pa.int64())], names=[*keep, "text", "tree", "n_tokens"])

    return rows.mapInArrow(run, f"{_fields(rows, keep)}text string, tree binary, n_tokens long")


def apply(trees: DataFrame, path: str, *, edits_col: str = "edits", keep: tuple[str, ...] = ("doc_id",), with_trees: bool = True) -> DataFrame:
    """Columns keep, text, tree and n_tokens after the edits (with with_trees), and n_before, n_after, n_chars (after), n_pieces (pre-tokens before) and n_encoded (pre-tokens encoded for the edits).

    trees: what grown or apply gave, with edits_col: array of struct<start: int, length: int, text: string>, in characters.
    """
    store.small_batches(trees.sparkSession)
    rows = trees.select(*keep, F.col("text").alias("_text"), F.col("tree").alias("_tree"), F.col(edits_col).alias("_edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            out: list[list[int]] = [[] for _ in range(5)]
            kept: list[Tree] = []
            for text, data, edits in zip(*[batch.column(c).to_pylist() for c in ("_text", "_tree", "_edits")], strict=True):
                tree = Tree.unpack(text, data, own)
                before, pieces = tree.n_tokens, tree.n_pieces
                for e in edits or []:
                    if e is not None:
                        tree.edit(e["start"] or 0, e["length"] or 0, e["text"] or "")
                for held, x in zip(out, (before, tree.n_tokens, tree.n_chars, pieces, tree.encoded), strict=True):
                    held.append(x)
                if with_trees:
                    kept.append(tree)
            cols = [batch.column(c) for c in keep]
            if with_trees:
                cols += [pa.array([t.text() for t in kept], pa.string()), pa.array([t.pack() for t in kept], pa.binary()), pa.array(out[1], pa.int64())]
            yield pa.RecordBatch.from_arrays([*cols, *[pa.array(x, pa.int64()) for x in out]], names=[*keep, *["text", "tree", "n_tokens"] * with_trees, "n_before", "n_after", "n_chars", "n_pieces", "n_encoded"])

    more = "text string, tree binary, n_tokens long, " * with_trees
    return rows.mapInArrow(run, f"{_fields(rows, keep)}{more}n_before long, n_after long, n_chars long, n_pieces long, n_encoded long")


def recount(docs: DataFrame, path: str, *, edits_col: str = "edits", text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns keep, n_before, n_after, n_chars, n_pieces and n_encoded as of apply: trees are grown and written to the shared folder, then the edits in edits_col are applied to that table."""
    held = dict.fromkeys([*keep, edits_col])
    trees = store.cut(grown(docs, path, text_col=text_col, keep=tuple(held)), "edit-trees")
    return apply(trees, path, edits_col=edits_col, keep=keep, with_trees=False)


def with_edits(docs: DataFrame, edits: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """docs (or trees) with their edits (doc id, seq, start, length, text) as an array in order of seq; a column edits that docs has is replaced."""
    each = edits.groupBy(id_col).agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", "start", "length", "text"))), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"), x["text"].alias("text"))).alias("edits"))
    return docs.drop("edits").join(each, id_col, "left")


def three_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Edits worked out from each row: its first 40 characters repeated at one place, 25 characters taken out at another, 10 replaced at a third."""
    n = F.coalesce(F.length(text_col), F.lit(0)) + 1
    at = lambda i: F.pmod(F.xxhash64(F.coalesce(F.col(id_col), F.lit(-1)), F.lit(i)), n).cast("int")
    one = lambda start, length, text: F.struct(start.alias("start"), F.lit(length).alias("length"), text.alias("text"))
    return docs.withColumn("edits", F.array(one(at(1), 0, F.coalesce(F.substring(text_col, 1, 40), F.lit(""))), one(at(2), 25, F.lit("")), one(at(3), 10, F.lit("edited text "))))
