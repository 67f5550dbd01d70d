"""The extraction as table functions, for SQL: register(spark), then

    SELECT p.page, e.* FROM pages p, LATERAL list_events(p.html, p.url, DATE '2026-01-01') e

list_events(html, url, today)   the events of a list page: a row each, with name, date, end_date, location, format, description, link, card_text, conflict
shaped_events(html, url)        what looks like an event on any page: name, date, link, card_text
page_labels(html)               what a page's elements state as pairs: label, value
json_events(html, url)          the events that JSON-LD and microdata state: name, date, end_date, location, format, description, link

Nulls are empty texts. Arguments go to Python by Arrow, as do the rows that come back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from . import dom, extract

_FIELDS = ", ".join(f"{c} string" for c in extract.COLUMNS if c != "link")


def _values(fields: dict) -> list[str | None]:
    return [(fields.get(c) or {}).get("value") for c in extract.COLUMNS if c != "link"]


class ListEvents:
    def eval(self, html: str, url: str, today: dt.date) -> Iterator[tuple]:
        for e in extract.list_events(html, url or "", dt.datetime(today.year, today.month, today.day)):
            yield (*_values(e["fields"]), e["link"], e["card_text"], e["conflict"])


class ShapedEvents:
    def eval(self, html: str, url: str) -> Iterator[tuple]:
        for e in extract.events_by_shape(html, url or ""):
            yield e["name"], e["date"], e["link"], e["card_text"]


class PageLabels:
    def eval(self, html: str) -> Iterator[tuple]:
        yield from extract.pairs(dom.main(dom.without_tags(dom.parse(html), "aside", "form")))


class JsonEvents:
    def eval(self, html: str, url: str) -> Iterator[tuple]:
        for fields in extract.structured(dom.parse(html), url or ""):
            yield (*_values(fields), (fields.get("link") or {}).get("value"))


FUNCTIONS = {
    "list_events": (ListEvents, f"{_FIELDS}, link string, card_text string, conflict string"),
    "shaped_events": (ShapedEvents, "name string, date string, link string, card_text string"),
    "page_labels": (PageLabels, "label string, value string"),
    "json_events": (JsonEvents, f"{_FIELDS}, link string"),
}


def register(spark: SparkSession) -> None:
    for name, (kind, schema) in FUNCTIONS.items():
        spark.udtf.register(name, udtf(kind, returnType=schema, useArrow=True))
