"""What an event is about: a taxonomy of categories, topics and phrases over title and description.

A taxonomy is a JSON file {category: {"topics": {topic: [phrase, ...]}, "weak": [word, ...]}}, whose path is a parameter, or rows of that. Its phrases, however many, are found in one pass over a
text (phrases.found); scores, the choice of a category, its topic and the reason in words are expressions over what was found.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Callable, Sequence
from functools import cache
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed, phrases
from .phrases import pattern  # noqa: F401

DEFAULT = str(Path(__file__).with_name("taxonomy.json"))
TITLE, TEXT, WEAK_TITLE, WEAK_TEXT, ACCEPT, SHOWN = 3.0, 1.0, 1.0, 0.5, 3.0, 4


class Entry(NamedTuple):
    category: str
    topic: str
    phrase: str
    weak: bool


def entries(raw: dict) -> tuple[Entry, ...]:
    """By category its topics' phrases in order, a topic's name being one of them, then its weak words."""
    out = []
    for c in fixed.CATEGORY_ORDER:
        own = raw.get(c, {})
        out += [Entry(c, t, p, False) for t, ps in own.get("topics", {}).items() for p in dict.fromkeys([t, *ps])]
        out += [Entry(c, fixed.GENERIC_WORD, w, True) for w in own.get("weak", [])]
    return tuple(out)


@cache
def load(path: str = DEFAULT) -> tuple[Entry, ...]:
    return entries(json.loads(Path(path).read_text(encoding="utf-8")))


def topic_names(rows: Sequence[Entry]) -> dict[str, list[str]]:
    """By category its topics, without the general one."""
    return {c: list(dict.fromkeys(r.topic for r in rows if r.category == c and not r.weak and "(general)" not in r.topic)) for c in fixed.CATEGORY_ORDER}


def topics_in_words(rows: Sequence[Entry]) -> str:
    """A line for each category, for a reviewer's question."""
    return "\n".join(f"  {c}: {'; '.join(names)}" for c, names in topic_names(rows).items())


def rejection(title: Column, description: Column) -> Column:
    """struct<kind, said> of the first kind of event that is rejected outright, else null."""
    title, description = F.coalesce(title, F.lit("")), F.coalesce(description, F.lit(""))
    both = F.concat_ws(" ", title, description)
    out = F.lit(None)
    for kind, p in reversed(fixed.REJECT_PATTERNS.items()):
        where = both if kind == "exam prep" else title
        out = F.when(where.rlike(f"(?i){p}"), F.struct(F.lit(kind).alias("kind"), F.trim(F.regexp_extract(where, f"(?i){p}", 0)).alias("said"))).otherwise(out)
    return out


def hits(title: Column, description: Column, rows: Sequence[Entry] | None = None) -> Column:
    """array<struct<n, title, said, category, topic, weak>> in the taxonomy's order: the phrases that the title has, and those that only the description has."""
    rows = load() if rows is None else tuple(rows)
    told = phrases.found(title, description, tuple(r.phrase for r in rows))
    part = lambda values, kind: F.array(*map(F.lit, values)).cast(f"array<{kind}>")
    # a category's entries stand together, so where it begins tells it; topics and weak words likewise
    edges = [i for i, r in enumerate(rows) if not i or (r.category, r.topic, r.weak) != (rows[i - 1].category, rows[i - 1].topic, rows[i - 1].weak)]
    known = {k: part([getattr(rows[i], k) for i in edges], kind) for k, kind in (("category", "string"), ("topic", "string"), ("weak", "boolean"))}
    place = F.split(F.lit(",".join(str(bisect_right(edges, n) - 1) for n in range(len(rows)))), ",").try_cast("array<int>")  # by entry its place among edges, folded to a constant

    def complete(h: Column) -> Column:
        at = F.get(place, h["n"])
        return F.struct(h["n"].alias("n"), h["title"].alias("title"), h["said"].alias("said"), *[F.get(v, at).alias(k) for k, v in known.items()])

    return F.transform(told, complete)


def _bound(value: Column, tell: Callable[[Column], Column]) -> Column:
    """tell of a value that is worked out once, however often tell names it."""
    return F.get(F.transform(F.array(value), tell), F.lit(0))


def _of(found: Column, category: str) -> Column:
    """struct<category, score, strong, shown, topic, any> of one category's hits. Without a topic's phrase the score stays below what is accepted."""
    weight = lambda h: F.when(h["weak"], F.when(h["title"], WEAK_TITLE).otherwise(WEAK_TEXT)).otherwise(F.when(h["title"], TITLE).otherwise(TEXT))

    def tell(own: Column, strong: Column) -> Column:
        total = F.aggregate(own, F.lit(0.0), lambda a, h: a + weight(h))
        shown = F.slice(F.array_distinct(F.transform(own, lambda h: F.concat(h["topic"], F.lit(" ('"), h["said"], F.lit("')")))), 1, SHOWN)
        score = F.when(F.size(strong) > 0, total).otherwise(F.least(total, F.lit(ACCEPT - 0.5)))
        return F.struct(F.lit(category).alias("category"), score.alias("score"), shown.alias("shown"), F.coalesce(F.get(strong, F.lit(0))["topic"], F.lit("")).alias("topic"))

    return _bound(F.filter(found, lambda h: h["category"] == category), lambda own: _bound(F.filter(own, lambda h: ~h["weak"]), lambda strong: tell(own, strong)))


def judged(found: Column, rejected: Column | None = None) -> Column:
    """struct<category, reason, topic, scores> from hits and rejection, if any: Tax, Legal or Finance (ties in this order), Reject or Unclear, and why."""
    none = F.lit("")
    rejected = F.lit(None).cast("struct<kind: string, said: string>") if rejected is None else rejected
    scores = _bound(found, lambda f: F.array(*[_of(f, c) for c in fixed.CATEGORY_ORDER]))

    def tell(all_: Column) -> Column:
        return _bound(F.array_max(F.transform(all_, lambda x: x["score"])), lambda top: _bound(F.filter(all_, lambda x: x["score"] == top), lambda tied: said_of(all_, top, tied)))

    def said_of(all_: Column, top: Column, tied: Column) -> Column:
        first, others = F.get(tied, F.lit(0)), F.transform(F.slice(tied, 2, len(fixed.CATEGORY_ORDER)), lambda x: x["category"])
        shown = F.array_join(first["shown"], "; ")
        tie = F.when(F.size(others) > 0, F.concat(F.lit(fixed.ALSO_MATCHES), F.array_join(others, " and "), F.lit("; "), first["category"], F.lit(fixed.BY_ORDER))).otherwise(none)
        said = lambda category, reason, topic: F.struct(category.alias("category"), reason.alias("reason"), topic.alias("topic"), F.transform(all_, lambda x: x["score"]).alias("scores"))
        return (
            F.when(rejected.isNotNull(), said(F.lit("Reject"), F.concat(rejected["kind"], F.lit(": '"), rejected["said"], F.lit(fixed.IN_THE_TEXT)), none))
            .when(top == 0, said(F.lit("Unclear"), F.lit(fixed.NO_TOPIC), none))
            .when(top < ACCEPT, said(F.lit("Unclear"), F.concat(F.lit(fixed.ONLY_GENERIC), shown, F.lit(fixed.NOT_ENOUGH)), none))
            .otherwise(said(first["category"], F.concat(first["category"], F.lit(fixed.IN_OWN_TEXT), shown, tie), first["topic"]))
        )

    return _bound(scores, tell)


def classify(title: Column, description: Column, rows: Sequence[Entry] | None = None) -> Column:
    """struct<category, reason, topic, scores>."""
    return judged(hits(title, description, rows), rejection(title, description))


def category(title: Column, description: Column, rows: Sequence[Entry] | None = None) -> Column:
    """Tax, Legal, Finance (ties in this order), Reject or Unclear."""
    return classify(title, description, rows)["category"]


def topics(title: Column, description: Column, category: str, rows: Sequence[Entry] | None = None) -> Column:
    """What a text says of a category: topic ('phrase as written') of the first few phrases that it has, in the taxonomy's order, generic words last."""
    return _of(hits(title, description, rows), category)["shown"]
