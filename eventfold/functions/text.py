"""Strings, URLs, identities and proof: expressions that stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def blank(c: Column) -> Column:
    """A cell as text: null is the empty string, outer white space goes."""
    return squeeze(F.coalesce(c.cast("string"), F.lit("")))


def squeeze(c: Column) -> Column:
    """Runs of white space (any Unicode kind) as one space, none outside; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def normalize_url(url: Column) -> Column:
    """Host in lower case without www., path without trailing slashes, query if any. Scheme and fragment go."""
    text = F.trim(F.coalesce(url, F.lit("")))
    host = F.regexp_replace(F.lower(F.regexp_extract(text, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")
    rest = F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^([^?#]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def same_page(a: Column, b: Column) -> Column:
    """Equal but for query, fragment, a trailing slash and case."""
    bare = lambda c: F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[#?].*$", ""), r"/+$", ""))
    return bare(a) == bare(b)


def valid_href(href: Column) -> Column:
    text = F.trim(F.coalesce(href, F.lit("")))
    return (text != "") & ~F.lower(text).rlike(r"^(#|javascript:|mailto:|tel:)")


def event_id(organizer: Column, name: Column, link: Column, source_url: Column, when: Column) -> Column:
    """By the event's own page if it has one, else by organizer, name and date."""
    own = (blank(link) != "") & (normalize_url(link) != normalize_url(source_url))
    words = F.trim(F.regexp_replace(F.lower(squeeze(name)), r"(?U)\W+", " "))
    by_name = F.concat(F.lit("name|"), F.lower(squeeze(organizer)), F.lit("|"), words, F.when(squeeze(when) != "", F.concat(F.lit("|"), squeeze(when))).otherwise(""))
    basis = F.when(own, F.concat(F.lit("url|"), normalize_url(link))).otherwise(by_name)
    return F.concat(F.lit("ev_"), F.substring(F.sha1(basis.cast("binary")), 1, 12))


def fingerprint(*texts: Column) -> Column:
    return F.substring(F.sha1(F.concat(*[F.coalesce(t, F.lit("")) for t in texts]).cast("binary")), 1, 16)


def on_page(needle: Column, page: Column) -> Column:
    """Whether a text occurs on a page, white space and case aside; a blank one doesn't."""
    n = F.lower(squeeze(needle))
    return (n != "") & F.contains(F.lower(squeeze(page)), n)


def evidence(value: Column, match: Column, reason: str, source: str, confidence: str = "high") -> Column:
    """A value with the text that proves it; null without a value."""
    cell = F.struct(value.alias("value"), match.alias("match"), F.lit(reason).alias("reason"), F.lit(source).alias("source"), F.lit(confidence).alias("confidence"))
    return F.when(value.isNotNull(), cell)


def reason_group(reason: Column) -> Column:
    """A reason without its quoted text and dates, so that like reasons count together."""
    return F.regexp_replace(reason, r"'[^']*'|\d{2}-[A-Za-z]{3}-\d{4}", "...")


def host(url: Column) -> Column:
    return F.regexp_extract(normalize_url(url), r"^([^/?]*)", 1)


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("yes", "y", "true", "1"), F.lit(False))


def visible_length(html: Column) -> Column:
    """Characters of a page's text without scripts, styles and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b.*?</\1>", " ")
    return F.length(squeeze(F.regexp_replace(bare, r"(?s)<[^>]+>", " ")))


def js_shell(html: Column) -> Column:
    """A page that shows next to nothing until scripts have run."""
    shell = lambda n: (n < 400) | (html.rlike(r"(?i)(enable|requires) javascript") & (n < 1500))
    return F.get(F.transform(F.array(visible_length(html)), shell), F.lit(0))  # bound, so that the length is worked out once


def more_pages(html: Column) -> Column:
    return html.rlike(f"(?i){fixed.MORE_PAGES}")


def blocked(html: Column) -> Column:
    return (F.length(html) <= fixed.BLOCK_LENGTH) & F.lower(html).rlike("|".join(fixed.BLOCK_MARKERS))


def like_listing(html: Column) -> Column:
    """Three dates or more at the beginning of a page."""
    return F.regexp_count(F.substring(html, 1, 20_000), F.lit(f"(?i){fixed.LISTING_DATE}")) >= 3


def too_old(text: Column, this_year: int = 2026) -> Column:
    """An archive page that names years from 2010 on and not this one."""
    past = "|".join(str(y) for y in range(2010, this_year))
    return text.rlike(rf"\b({past})\b") & ~text.rlike(rf"\b{this_year}\b")
