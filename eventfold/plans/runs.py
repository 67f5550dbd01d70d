"""Queries over pages and runs made of the customer table: fields of detail and list pages, what a second run changes, summaries."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, extract, table_functions
from ..operators import lifecycle, report
from ..sources import shared
from . import jobs, tables, weekly
from .registry import query, table

TODAY, LATER = dt.date(1998, 1, 1), dt.date(1998, 6, 1)
_DAY = "(DATE '1998-02-01' + CAST(c_custkey % 300 AS INTEGER))"
_SHOWN = f"strftime({_DAY}, '%d-%b-%Y')"


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("k"), F.date_add(F.lit(dt.date(1998, 2, 1)), (k % 300).cast("int")).alias("day"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query(
    f"""SELECT c_custkey AS k, 'Day of ' || c_mktsegment || ' ' || c_custkey AS name, CASE WHEN c_custkey % 7 <> 0 THEN {_SHOWN} END AS date,
    CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Hall ' || c_nationkey END AS location, CASE c_custkey % 3 WHEN 0 THEN 'Virtual' WHEN 1 THEN 'In Person' ELSE CASE WHEN c_custkey % 4 = 0 THEN 'Virtual' END END AS format,
    CASE WHEN c_custkey % 5 = 0 THEN 'Registration deadline' ELSE '' END AS ignored, CASE WHEN c_custkey % 7 = 0 THEN 'no_date' ELSE '' END AS reasons FROM customer"""
)
def customer_detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each customer with labels in a list, a table or lines; what the labels say."""
    c = shared.spread(_customers(spark, sf_dir))
    k, day = F.col("k"), F.date_format("day", "d MMMM yyyy")
    pair = lambda label, value: F.when(k % 2 == 0, _text(f"<dl><dt>{label}:</dt><dd>", value, "</dd></dl>")).otherwise(_text(f"<table><tr><th>{label}</th><td>", value, "</td></tr></table>"))
    date = F.when(k % 7 != 0, pair("Date", day)).otherwise(F.lit("<p>to be told</p>"))
    venue = F.when(k % 4 == 0, pair("Venue", F.lit("Online"))).otherwise(pair("Venue", _text("Hall ", F.col("nation"))))
    mode = F.when(k % 3 == 0, F.lit("<p>Mode: webinar</p>")).when(k % 3 == 1, F.lit("<p>Mode of delivery: on-site</p>")).otherwise(F.lit(""))
    other = F.when(k % 5 == 0, F.lit("<p>Registration deadline: 3 January 1998</p>")).otherwise(F.lit(""))
    # a mode line says it before the venue does
    html = _text("<html><head><title>T</title></head><body><nav>Home</nav><main><h1>Day of ", F.col("segment"), " ", k, "</h1>", mode_first(mode, venue), date, other, "</main></body></html>")
    d = extract.detail_page(html, _text("https://o.example/", k), F.lit(""), TODAY)
    rows = c.select("k", d.alias("d"))
    value = lambda f: F.col(f"d.fields.{f}.value").alias(f)
    return rows.select("k", value("name"), value("date"), value("location"), value("format"), F.array_join("d.ignored", ",").alias("ignored"), F.array_join("d.reasons", ",").alias("reasons"))


def mode_first(mode: Column, venue: Column) -> Column:
    """A mode in a table row, so that it stands before what a venue's value says of the mode."""
    row = F.regexp_replace(mode, r"<p>([^:]+): ([^<]+)</p>", "<dl><dt>$1</dt><dd>$2</dd></dl>")
    return F.concat(row, venue)


_LISTED = f"""SELECT (c_custkey - 1) // 20 AS page, 'Day of ' || c_mktsegment || ' ' || c_custkey AS name, 'https://o.example/e/' || c_custkey AS link, CASE WHEN c_custkey % 9 <> 0 THEN strftime({_DAY} + INTERVAL 28 YEAR, '%d-%b-%Y') END AS date,
    CASE WHEN c_custkey % 3 <> 0 THEN 'Hall ' || c_nationkey END AS location, c_custkey % 9 = 0 AS conflict FROM customer"""


def _listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page, html of twenty cards each, one for each customer."""
    k = F.col("k")
    day = F.date_format(F.add_months("day", 336), "d MMMM yyyy")  # dates without a label are read from 2000 on
    said = F.when(k % 2 == 0, _text("Date: ", day)).otherwise(_text("We meet on ", day))
    venue = F.when(k % 3 != 0, _text(" Venue: Hall ", F.col("nation"))).otherwise(F.lit(""))
    other = F.when(k % 9 == 0, F.lit('<time datetime="2025-03-04"></time>')).otherwise(F.lit(""))
    card = _text('<div class="card"><h3><a href="/e/', k, '">Day of ', F.col("segment"), " ", k, "</a></h3><p>", said, venue, "</p>", other, "</div>")
    cards = _customers(spark, sf_dir).select(((k - 1) / 20).cast("long").alias("page"), F.struct("k", card.alias("html")).alias("c"))
    pages = cards.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x["html"]), "").alias("body"))
    return pages.select("page", _text("<html><body><main>", F.col("body"), "</main></body></html>").alias("html"))


@query(_LISTED)
def customer_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of twenty cards, one for each customer; the events that they list."""
    rows = _listing_pages(spark, sf_dir).select("page", F.explode(extract.list_page(F.col("html"), F.lit("https://o.example/list"), dt.date(2026, 1, 1))).alias("e"))
    value = lambda f: F.col(f"e.fields.{f}.value").alias(f)
    return rows.select("page", value("name"), "e.link", value("date"), value("location"), (F.col("e.conflict") != "").alias("conflict"))


@query(_LISTED)
def events_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages, read by table functions in plain SQL."""
    table_functions.register(spark)
    _listing_pages(spark, sf_dir).createOrReplaceTempView("listing_pages")
    return spark.sql("SELECT p.page, e.name, e.link, e.date, e.location, e.conflict <> '' AS conflict FROM listing_pages p, LATERAL list_events(p.html, 'https://o.example/list', DATE '2026-01-01') e")


@query(
    f"""SELECT 'event e' || c_custkey AS name, CASE WHEN c_custkey % 5 IN (0, 3) THEN c_custkey ELSE 1000000 + c_custkey END AS ord,
    CASE c_custkey % 5 WHEN 0 THEN 'untouched' WHEN 1 THEN 'changed' WHEN 2 THEN 'completed' WHEN 3 THEN 'unchanged' ELSE 'new' END AS fate,
    CASE WHEN c_custkey % 5 <> 0 AND {_DAY} < DATE '1998-06-01' THEN 'past' ELSE 'upcoming' END AS bucket FROM customer"""
)
def second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over the customers' events, then another in which a fifth each is gone, changed, completed, unchanged and new."""
    c = _customers(spark, sf_dir)
    k = F.col("k")

    def raw(first: bool) -> DataFrame:
        day = F.date_format("day", "d MMMM yyyy")
        said = F.when(k % 5 == 2, F.lit("")).otherwise(day) if first else day
        place = _text("Hall ", F.col("nation")) if first else F.when(k % 5 == 1, F.lit("Elsewhere")).otherwise(_text("Hall ", F.col("nation")))
        same = {"organizer": F.col("segment"), "category": F.lit("Tax"), "format": F.lit("Virtual"), "location": place, "description": F.lit(""), "link": F.lit(""), "source_url": F.lit("s")}
        return c.where(k % 5 != (4 if first else 0)).select((k if first else k + 1_000_000).alias("ord"), said.alias("date"), _text("event e", k).alias("event_name"), *[v.alias(n) for n, v in same.items()])

    out = jobs.refresh(raw(False), jobs.clean(raw(True), TODAY), LATER)
    return out.select(F.col("event_name").alias("name"), "ord", "fate", "bucket")


_PER = f"(SELECT *, {tables._BUCKET} AS bucket FROM {tables._EVENTS})"


@query(
    f"""SELECT count(*) FILTER (bucket = 'upcoming') AS upcoming, count(*) FILTER (bucket = 'past') AS past, count(*) FILTER (bucket = 'incomplete') AS incomplete, count(*) FILTER (bucket = 'flagged') AS flagged,
    count(DISTINCT nation) AS with_events, count(DISTINCT organizer) FILTER (bucket = 'upcoming') AS organizers_upcoming, count(DISTINCT organizer) FILTER (bucket = 'past') AS organizers_past,
    (SELECT count(*) FROM (SELECT organizer FROM {_PER} WHERE bucket = 'upcoming' INTERSECT SELECT organizer FROM {_PER} WHERE bucket = 'past')) AS organizers_both,
    CAST(30 AS BIGINT) AS checked, greatest(30 - count(DISTINCT nation), 0) AS without_events FROM {_PER}"""
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.summary(tables._bucketed(spark, sf_dir).withColumn("source_url", F.col("nation")), total_sources=30)


@query(f"SELECT nation, bucket, count(*) AS n FROM {_PER} GROUP BY ALL")
def master_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.counts(tables._bucketed(spark, sf_dir), "nation", "bucket")


@query("SELECT DISTINCT source_url FROM (SELECT 'n' || c_nationkey AS source_url FROM customer WHERE c_custkey % 50 = 0 UNION ALL SELECT 'n' || s_nationkey FROM supplier WHERE s_suppkey % 7 = 0)")
def healthy_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = lambda name, key, nation, every: table(spark, sf_dir, name).select(_text("n", F.col(nation)).alias("source_url"), F.when(F.col(key) % every == 0, "ok").otherwise("empty").alias("status"))
    return report.healthy(run("customer", "c_custkey", "c_nationkey", 50), run("supplier", "s_suppkey", "s_nationkey", 7))


#: Customers as events of five countries, in two weekly runs: what each is after the second, by its own two records alone. The gathering of country 3 fails in the second run, the site of country 4 is empty then.
_WEEKS = """WITH c AS (SELECT c_custkey AS k, c_nationkey % 5 AS n, DATE '2026-09-01' + CAST(c_custkey % 40 AS INTEGER) AS day FROM customer),
  a AS (SELECT *, CASE WHEN k % 5 = 1 THEN 'review' WHEN k % 23 = 2 THEN 'rejected' WHEN day < DATE '2026-09-05' THEN 'past' ELSE 'verified' END AS first FROM c),
  b AS (SELECT *, n <> 3 AND n <> 4 AND k % 3 <> 0 AS seen, k % 7 = 0 AS moved FROM a),
  r AS (SELECT *, CASE WHEN first = 'past' AND NOT seen THEN 'past' WHEN first = 'rejected' AND NOT seen THEN 'rejected'
      WHEN first = 'review' THEN CASE WHEN NOT seen THEN 'review' WHEN k % 11 = 4 THEN 'rejected' WHEN day < DATE '2026-09-22' THEN 'past' ELSE 'verified' END
      WHEN seen AND k % 11 = 4 THEN 'rejected' WHEN first IN ('past', 'rejected') THEN CASE WHEN day < DATE '2026-09-22' THEN 'past' ELSE 'verified' END
      WHEN day < DATE '2026-09-22' THEN 'past' WHEN seen OR n = 3 OR n = 4 THEN 'verified' ELSE 'review' END AS second FROM b)
"""


@query(
    _WEEKS
    + """SELECT 'ev_' || k AS event_id, second AS bucket, CASE WHEN seen AND moved THEN 'moved' ELSE 'hall ' || k END AS location, CASE WHEN seen THEN '22-Sep-2026' ELSE '05-Sep-2026' END AS last_seen,
    CASE WHEN second <> 'review' THEN '' WHEN first = 'review' THEN 'no proof' ELSE 'Not found on its website since 05-Sep-2026' END AS review_reason FROM r
    UNION ALL SELECT 'ev_' || k, 'rejected', 'hall ' || k, '05-Sep-2026', '' FROM r WHERE first = 'rejected' AND second <> 'rejected'
    UNION ALL SELECT 'ev_' || k, 'past', 'hall ' || k, '05-Sep-2026', '' FROM r WHERE first = 'past' AND second <> 'past'"""
)
def weekly_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master after two weekly runs, the second of which lacks a country, with rows that change, go missing, pass and are rejected."""
    c, k = F.col, F.col("c_custkey")
    people = table(spark, sf_dir, "customer").withColumn("day", F.date_add(F.lit("2026-09-01").cast("date"), (k % 40).cast("int")))
    n = c("c_nationkey") % 5
    people = shared.once(shared.spread(people.select("c_custkey", "c_nationkey", "day"), 50_000), "people")  # every country reads it anew
    site = _text("https://n", n, ".example/list")
    base = [
        k.alias("ord"), _text("ev_", k).alias("event_id"), _text("Meeting ", k).alias("event_name"), dates.display(c("day")).alias("date"), _text("Organisation ", n).alias("organizer"), _text("Country ", n).alias("country"),
        site.alias("source_url"), _text("https://n", n, ".example/e/", k).alias("register_link"), F.lit("no proof").alias("reason"),
    ]

    def gathered(country: int, second: bool) -> weekly.Gathered:
        own = people.where(n == country)
        if second and country == 3:
            raise OSError("no network")
        here = own.where((k % 3 != 0) & F.lit(country != 4)) if second else own
        status = F.when(k % 11 == 4, "rejected").otherwise("verified") if second else F.when(k % 5 == 1, "needs_review").when(k % 23 == 2, "rejected").otherwise("verified")
        place = F.when((k % 7 == 0) & F.lit(second), "moved").otherwise(_text("hall ", k)).alias("location")
        records = here.select(*base, status.alias("status"), place, F.lit(True).alias("changed"))
        sites = own.groupBy(site.alias("source_url")).agg(F.lit("x").alias("organizer"), F.lit(0 if second and country == 4 else 9).alias("events"), F.lit(None).cast("string").alias("error"))
        return records, sites

    path = shared.folder(spark, "weekly")
    for name, second, today in (("first", False, dt.date(2026, 9, 5)), ("second", True, dt.date(2026, 9, 22))):
        weekly.run(spark, path, name, {f"Country {i}": partial(gathered, i, second) for i in range(5)}, today)
    rows, _ = lifecycle.read(spark, path)
    return rows.select("event_id", "bucket", "location", "last_seen", "review_reason")
