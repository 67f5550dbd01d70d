"""Many phrases in one pass over a text: an automaton, a trie of all phrases with failure links, built once in a worker, proposes; each phrase's own pattern decides.

A pass costs the text's length and its hits, not the number of phrases. The automaton reads a text in lower case with runs of white space and hyphens as one space, and finds phrases anywhere in it;
what the pattern then finds first is what the text says. So results are those of searching for every pattern.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import product

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources import shared

FOUND = "array<struct<n: int, title: boolean, said: string>>"
_KIND = pa.list_(pa.struct([("n", pa.int32()), ("title", pa.bool_()), ("said", pa.string())]))
_END = re.compile(r"(?:s|es)?(?![A-Za-z0-9])")


def pattern(phrase: str) -> str:
    """A phrase as a regular expression: whole words, a hyphen may be a space, "and" may be "&", a plural ending may follow, * at the end stands for any ending."""
    p = phrase.strip().lower()
    words = ["(?:&|and)" if w in ("and", "&") else re.sub(r"\\?-", r"[\\s\\-]", re.escape(w)) for w in p.rstrip("*").split()]
    return "(?<![A-Za-z0-9])" + r"[\s\-]+".join(words) + ("" if p.endswith("*") else "(?:s|es)?(?![A-Za-z0-9])")


def plain(text: str) -> str:
    return " ".join(text.lower().replace("ſ", "s").replace("-", " ").split())


def spellings(phrase: str) -> list[str]:
    """What the automaton looks for: the phrase with each "and" either way."""
    words = phrase.strip().lower().rstrip("*").split()
    return [plain(" ".join(x)) for x in product(*[("and", "&") if w in ("and", "&") else (w,) for w in words])]


class Matcher:
    """The phrases that a text has, by their numbers, and each as first written there."""

    def __init__(self, phrases: tuple[str, ...]):
        import ahocorasick

        self.patterns = [re.compile(pattern(p), re.IGNORECASE) for p in phrases]
        self.any_end = [p.strip().endswith("*") for p in phrases]
        by_spelling: dict[str, list[int]] = {}
        for n, p in enumerate(phrases):
            for s in spellings(p):
                if s:
                    by_spelling.setdefault(s, []).append(n)
        self.automaton = ahocorasick.Automaton()
        for s, ns in by_spelling.items():
            self.automaton.add_word(s, (len(s), ns))
        if by_spelling:
            self.automaton.make_automaton()
        self.empty = not by_spelling

    def proposed(self, text: str) -> set[int]:
        if not text or self.empty:
            return set()
        low, out = plain(text), set()
        for end, (n, phrases) in self.automaton.iter(low):
            before = low[end - n] if end >= n else " "
            if before.isascii() and before.isalnum():
                continue
            whole = None
            for p in phrases:
                if p not in out and not self.any_end[p]:
                    whole = bool(_END.match(low, end + 1)) if whole is None else whole
                if self.any_end[p] or p in out or whole:
                    out.add(p)
        return out

    def __call__(self, text: str) -> dict[int, str]:
        out = {}
        for n in self.proposed(text):
            if m := self.patterns[n].search(text):
                out[n] = m.group(0).strip().lower()
        return out


@lru_cache(maxsize=4)
def matcher(phrases: tuple[str, ...]) -> Matcher:
    return Matcher(phrases)


def found(title: Column, description: Column, phrases: tuple[str, ...]) -> Column:
    """FOUND: the phrases of the title, and those that only the description has, in the order of phrases, each as written in lower case. Nulls are empty texts."""

    @F.arrow_udf(FOUND)
    def search(titles: pa.Array, descriptions: pa.Array) -> pa.Array:
        own, out = matcher(phrases), []
        for t, d in zip(titles.to_pylist(), descriptions.to_pylist(), strict=True):
            a = own(t or "")
            b = own(d or "")
            out.append([{"n": n, "title": n in a, "said": a.get(n, b.get(n))} for n in sorted(a.keys() | b.keys())])
        return pa.array(out, _KIND)

    shared.whole_texts()
    return search(title, description)
