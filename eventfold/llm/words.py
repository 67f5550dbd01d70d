"""Work once per distinct word: caches that live as long as a Python worker and stay below a number of entries."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Sequence

import numpy as np

CACHE_ENTRIES = 200_000


_HELD: dict[object, object] = {}


def sole(key: object, make: Callable[[], object]):
    """What make gives, kept for later tasks of this Python worker; only one such thing at a time, as each is large."""
    if key not in _HELD:
        _HELD.clear()
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)
        _HELD[key] = make()
    return _HELD[key]


class _Numbers(dict):
    """Numbers words as they come."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Flat:
    """Integer lists of words, laid end to end, with a number for each word seen."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], entries: int = CACHE_ENTRIES):
        """encode: the lists of some words end to end, and the length of each."""
        self.encode, self.entries = encode, entries
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.values = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int32)
        self.hits = np.zeros(1 << 14, np.int32)
        self.used = 0

    def _shrink(self) -> None:
        """Keep the half of the words that was asked for most."""
        n = len(self.numbers)
        kept = np.sort(np.argpartition(-self.hits[:n], n // 2)[: n // 2])
        names = list(self.numbers)
        flat, lengths = self.expand(kept)
        hits = self.hits[kept] // 2
        self.clear()
        self.numbers.update(zip([names[i] for i in kept.tolist()], range(len(kept)), strict=True))
        self._put(0, flat, lengths)
        self.hits[: len(kept)] = hits

    def _learn(self) -> None:
        new, self.numbers.new = self.numbers.new, []
        self._put(len(self.numbers) - len(new), *self.encode(new))

    def _put(self, at: int, flat: np.ndarray, n: np.ndarray) -> None:
        while len(self.numbers) > len(self.starts):
            self.starts, self.lengths, self.hits = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths, self.hits))
        while self.used + len(flat) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        self.values[self.used : self.used + len(flat)] = flat
        self.starts[at : at + len(n)] = self.used + np.cumsum(n) - n
        self.lengths[at : at + len(n)] = n
        self.used += len(flat)

    def look_up(self, words: list) -> np.ndarray:
        """The number of each word; numbers hold until the next call."""
        if len(self.numbers) > self.entries:
            self._shrink()
        out = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if self.numbers.new:
            self._learn()
        n = len(self.numbers)
        self.hits[:n] += np.bincount(out, minlength=n).astype(np.int32)
        return out

    def expand(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All lists end to end, and the length of each."""
        n = self.lengths[numbers].astype(np.int64)
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(n) else 0
        at = np.repeat(self.starts[numbers] - (ends - n), n) + np.arange(total)
        return self.values[at], n


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(64, MULTIPLIER))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for ranges in order. Two of a million different words agree with a chance of some 1 in 10**7."""
    global _POWERS
    longest = int((ends - starts).max())
    if longest > len(_POWERS):
        _POWERS = np.cumprod(np.full(longest, MULTIPLIER))
    n = ends - starts
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    with np.errstate(over="ignore"):
        h = np.add.reduceat((data[np.repeat(starts, n) + inner].astype(np.uint64) + np.uint64(1)) * _POWERS[inner], np.cumsum(n) - n)
        h = (h ^ (h >> np.uint64(32))) * MULTIPLIER
    return h ^ (h >> np.uint64(29))


def distinct_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The different words data[start:end], and which of them each range is. Words are told apart by their bytes; hashes only bring equal ones together."""
    _, first, at = np.unique(hashes(data, starts, ends), return_index=True, return_inverse=True)
    n = ends - starts
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    same = (n == n[first][at]).all() and np.array_equal(data[np.repeat(starts, n) + inner], data[np.repeat(starts[first][at], n) + inner])
    raw = memoryview(np.ascontiguousarray(data))
    if same:
        return [bytes(raw[a:b]) for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], at
    numbers = _Numbers()  # two words of equal hash
    return numbers.new, np.fromiter((numbers[bytes(raw[a:b])] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.int64, len(starts))


def look_up_ranges(cache: Flat, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of the words data[start:end]; equal words are looked up once."""
    if not len(starts):
        return np.zeros(0, np.int64)
    own, at = distinct_ranges(data, starts, ends)
    return cache.look_up(own)[at]


def flat_lists(lists: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((x for ids in lists for x in ids), np.int32, int(n.sum())), n


def pieces(sizes: Sequence[int], most: int) -> list[tuple[int, int]]:
    """Ranges of rows that together hold at most so many bytes, one row at least."""
    out, at, held = [], 0, 0
    for i, n in enumerate(sizes):
        if i > at and held + n > most:
            out.append((at, i))
            at, held = i, 0
        held += n
    if at < len(sizes):
        out.append((at, len(sizes)))
    return out
