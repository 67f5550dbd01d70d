"""Titles, relevance, country and format told from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed, text


def junk_title(name: Column) -> Column:
    n = F.lower(text.blank(name))
    return (n == "") | n.isin(*fixed.JUNK_TITLES) | n.rlike(r"^\d+$") | n.rlike("|".join(fixed.JUNK_SUBSTRINGS))


def generic_title(title: Column, organizer: Column | None = None) -> Column:
    t = F.lower(text.squeeze(title))
    out = (F.length(t) < 4) | t.rlike(r"^\d+$") | t.isin(*fixed.GENERIC_HEADINGS) | t.rlike(fixed.LISTING_TITLE) | t.rlike(f"(?U){fixed.NAV_TITLE}")
    if organizer is not None:
        o = F.lower(text.squeeze(organizer))
        out = out | ((o != "") & (t == o))
    return out


def relevant(category: Column, name: Column, description: Column) -> Column:
    """By the category's words; only without a category by name and description."""
    words = "|".join(fixed.RELEVANCE_KEYWORDS)
    c = F.lower(text.blank(category))
    return F.when(c != "", c.rlike(words)).otherwise(F.lower(F.concat_ws(" ", text.blank(name), text.blank(description))).rlike(words))


def country_of(location: Column) -> Column:
    """The one tracked country that a location names, else null."""
    loc = F.lower(F.coalesce(location, F.lit("")))
    hints = {c: r"\b(" + "|".join(ws) + r")\b" for c, ws in fixed.COUNTRY_WORDS.items()}
    hints["USA"] += r"|,\s*(" + "|".join(s.lower() for s in fixed.US_STATES) + r")\b"
    named = F.array_compact(F.array(*[F.when(loc.rlike(p), F.lit(c)) for c, p in hints.items()]))
    return F.when(F.size(named) == 1, F.element_at(named, 1))


def untracked(location: Column) -> Column:
    return F.lower(F.coalesce(location, F.lit(""))).rlike(r"\b(" + "|".join(fixed.UNTRACKED_PLACES) + r")\b")


def resolved_country(location: Column, source_country: Column) -> Column:
    return F.coalesce(country_of(location), source_country)


def _by_words(t: Column, words: dict[str, str]) -> Column:
    """The first form of which a text has a word, else nothing."""
    return F.coalesce(*[F.when(t.rlike(p), F.lit(form)) for form, p in words.items()], F.lit(""))


def mode_from_text(c: Column) -> Column:
    return _by_words(F.lower(F.coalesce(c, F.lit(""))), fixed.MODE_WORDS)


def format_from_text(c: Column) -> Column:
    return _by_words(F.lower(F.coalesce(c, F.lit(""))), fixed.TEXT_MODE_WORDS)


def format_from_mode(uri: Column, virtual_location: Column) -> Column:
    last = F.lower(F.element_at(F.split(F.coalesce(uri, F.lit("")), "/"), -1))
    told = F.coalesce(*[F.when(last.contains(part), F.lit(form)) for part, form in fixed.ATTENDANCE_MODES.items()])
    return F.coalesce(told, F.when(virtual_location, F.lit("Virtual")), F.lit(""))


def location_in_text(c: Column) -> Column:
    return F.regexp_extract(c, fixed.PLACE_IN_TEXT, 0)


def missing_info(reason: Column) -> Column:
    return F.coalesce(F.lower(reason).rlike(fixed.MISSING_INFO), F.lit(False))
