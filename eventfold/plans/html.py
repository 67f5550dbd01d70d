"""Queries that read HTML as a tree."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from ..functions import extract, text
from ..sources import shared
from .registry import cases_sql, pick, query, table

TODAY = dt.date(2026, 9, 24)


@query()
def page_main_text_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.fingerprint(extract.page_text(F.col("html"))).alias("fingerprint"))


@query()
def page_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that pages list, one row each."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(extract.list_page(F.col("html"), F.col("url"), TODAY)).alias("e"))
    return rows.select("page_id", "e.link", "e.card_text", "e.conflict", F.col("e.fields.name.value").alias("name"), F.col("e.fields.date.value").alias("date"))


@query()
def page_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", extract.detail_page(F.col("html"), F.col("url"), F.lit(""), TODAY).alias("d"))
    return rows.select("page_id", F.col("d.fields.name.value").alias("name"), F.col("d.fields.description.value").alias("description"), F.array_join("d.reasons", ",").alias("reasons"))


def _page(head: str, body: str) -> str:
    return f"<html><head><title>T</title>{head}</head><body><nav>Home</nav><main>{body}</main></body></html>"


def _ld(data: str) -> str:
    return f'<script type="application/ld+json">{data}</script>'


DETAILS = [
    (_page("", "<h1>VAT Update Day</h1><p>Date: 5-6 October 2026 Venue: London</p>"), "VAT Update Day", "05-Oct-2026", "06-Oct-2026", "London", "", ""),
    (_page(_ld('{"@type":"EducationEvent","name":"Law Talk","startDate":"2026-11-02","location":{"name":"Hall","address":{"addressLocality":"Leeds"}}}'), "<h1>Law Talk</h1><p>Date: 3 November 2026</p>"), "Law Talk", None, None, "Hall, Leeds", "", "conflict:date"),
    (_page(_ld('{"@graph":[{"@type":"WebSite"},{"@type":"Event","name":"Audit Forum","startDate":"2026-12-01T09:00","endDate":"2026-12-02","eventAttendanceMode":"https://schema.org/OnlineEventAttendanceMode"}]}'), "<p>x</p>"), "Audit Forum", "01-Dec-2026", "02-Dec-2026", None, "Virtual", ""),
    (_page("", "<h1>Tax Night</h1><table><tr><th>When</th><td>12 October</td></tr><tr><th>Mode</th><td>In person</td></tr></table>"), "Tax Night", None, None, None, "In Person", "no_year"),
    (_page(_ld("{broken"), "<h1>Events</h1><p>Registration deadline: 1 May 2026</p>"), None, None, None, None, "", "no_title,no_date"),
    (_page("", '<h1>Bank Day</h1><dl><dt>Dates:</dt><dd>1st to 3rd March, 2027</dd><dt>Location</dt><dd>TBA</dd></dl>'), "Bank Day", "01-Mar-2027", "03-Mar-2027", None, "", ""),
    (_page("", '<div itemscope itemtype="https://schema.org/Event"><h2 itemprop="name">Micro Meet</h2><meta itemprop="startDate" content="2027-01-05"></div>'), "Micro Meet", "05-Jan-2027", None, None, "", ""),
    (_page("", '<h1>Clock Day</h1><time datetime="2026-10-10T10:00">soon</time>'), "Clock Day", "10-Oct-2026", None, None, "", "weak:date"),
]


@query(cases_sql("part", "p_partkey", ["name", "date", "end_date", "location", "format", "reasons"], [d[1:] for d in DETAILS]))
def detail_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shared.spread(table(spark, sf_dir, "part").select("p_partkey")).select(F.col("p_partkey").alias("id"), pick([d[0] for d in DETAILS], "p_partkey").alias("html"))
    rows = rows.withColumn("d", extract.detail_page(F.col("html"), F.lit("https://a.example/e"), F.lit(""), TODAY))
    value = lambda c: F.col(f"d.fields.{c}.value").alias(c)
    return rows.select("id", *[value(c) for c in ("name", "date", "end_date", "location")], F.coalesce("d.fields.format.value", F.lit("")).alias("format"), F.array_join("d.reasons", ",").alias("reasons"))


def _cards(*cards: str) -> str:
    return "<html><body>" + "".join(f'<div class="event-card">{c}</div>' for c in cards) + "</body></html>"


LISTS = [
    (_cards('<h3><a href="/a">Transfer Pricing Day</a></h3><p>Date: 5 October 2026</p><span>Virtual</span>', '<h3><a href="/b">Audit Day</a></h3><p>6 Oct 2026 in Leeds</p>'), 2, "Transfer Pricing Day|05-Oct-2026|Virtual;Audit Day|06-Oct-2026|"),
    (_cards('<h3>Webinars</h3><p>7 Oct 2026</p><a href="/c">Cross-border VAT seminar</a>', '<h3><a href="/d">Law Day</a></h3><p>Register by 1 May 2026, held 8 Oct 2026</p>'), 2, "Cross-border VAT seminar|07-Oct-2026|;Law Day|08-Oct-2026|"),
    (_cards('<h3><a href="/e">Two Days</a></h3><p>7 Oct 2026 or 9 Oct 2026</p>', '<h3><a href="/f">Undated Day</a></h3><p>some time soon</p>'), 2, "Two Days||;Undated Day||"),
    ("<html><body><ul class='nav-menu'><li><a href='/x'>Some navigation text here</a></li><li><a href='/y'>More navigation text here</a></li></ul></body></html>", 0, ""),
]


@query(cases_sql("part", "p_partkey", ["n", "said"], [x[1:] for x in LISTS]))
def list_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shared.spread(table(spark, sf_dir, "part").select("p_partkey")).select(F.col("p_partkey").alias("id"), pick([x[0] for x in LISTS], "p_partkey").alias("html"))
    rows = rows.withColumn("e", extract.list_page(F.col("html"), F.lit("https://a.example/"), TODAY))
    say = lambda x: F.concat_ws("|", x["fields"]["name"]["value"], F.coalesce(x["fields"]["date"]["value"], F.lit("")), F.coalesce(x["fields"]["format"]["value"], F.lit("")))
    return rows.select("id", F.size("e").alias("n"), F.array_join(F.transform("e", say), ";").alias("said"))


@query("SELECT doc_id, length(coalesce(text, '')) AS n_chars, true AS whole FROM documents")
def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts in chunks of at most 4,000 characters: as many characters as before, none too long."""

    @pandas_udf("array<string>")
    def cut(texts):
        return texts.map(lambda t: extract.chunks(t, 4000))

    rows = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("c", cut("text"))
    whole = (F.array_join("c", "") == F.col("text")) & F.forall("c", lambda x: F.length(x) <= 4000)
    return rows.select("doc_id", F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("n_chars"), whole.alias("whole"))
