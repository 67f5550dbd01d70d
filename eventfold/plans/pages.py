"""Queries over pages: identity, own pages, fetch tiers, titles, anchors, proof."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text, titles
from ..operators import merge, report
from .registry import query, table

HOST = r"regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z]+://([^/?#]*)', 1)), '^www\.', '')"
PATH = r"regexp_replace(regexp_extract(trim(url), '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', '')"
ASK = r"regexp_extract(trim(url), '^[^?#]*[?]([^#]*)', 1)"
URL = f"{HOST} || {PATH} || CASE WHEN {ASK} <> '' THEN '?' || {ASK} ELSE '' END"


@query(f"SELECT page_id, {URL} AS normalized, 'ev_' || substr(sha1('url|' || {URL}), 1, 12) AS event_id FROM pages")
def page_url_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit("")
    return table(spark, sf_dir, "pages").select("page_id", text.normalize_url(F.col("url")).alias("normalized"), text.event_id(none, none, F.col("url"), none, none).alias("event_id"))


@query(f"SELECT coalesce({HOST}, 'TOTAL') AS host, count(*) AS pages, count(DISTINCT {URL}) AS urls FROM pages GROUP BY ROLLUP ({HOST})")
def page_host_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select(text.host(F.col("url")).alias("host"), text.normalize_url(F.col("url")).alias("u"))
    return report.with_total(rows, "host", pages=F.count("*"), urls=F.countDistinct("u"))


@query(
    f"WITH p AS (SELECT page_id, {URL} AS n, {HOST} AS h FROM (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'https://lists.example.org/all' ELSE url END AS url FROM pages)) "
    "SELECT page_id, n <> '' AND n <> 'lists.example.org' AND NOT regexp_matches(h, 'google[.]com$') AND count(*) OVER (PARTITION BY n) = 1 AS own_page FROM p"
)
def own_page_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 7 == 0, "https://lists.example.org/all").otherwise(F.col("url")).alias("url"), F.lit("https://lists.example.org/").alias("source"))
    return report.own_page(rows, "url", "source").select("page_id", "own_page")


def _bare(html: str) -> str:
    for tag in ("script", "style", "noscript"):
        html = rf"regexp_replace({html}, '(?is)<{tag}\b.*?</{tag}>', ' ', 'g')"
    return rf"length(trim(regexp_replace(regexp_replace({html}, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')))"


@query(f"SELECT page_id, CAST({_bare('html')} AS BIGINT) AS visible FROM pages")
def page_visible_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.visible_length(F.col("html")).cast("long").alias("visible"))


_MORE = fixed.MORE_PAGES.replace("'", "''")


@query(
    f"""SELECT page_id, CASE WHEN length(html) <= 3000 AND regexp_matches(lower(html), '{"|".join(fixed.BLOCK_MARKERS)}') THEN 'blocked'
    WHEN {_bare("html")} < 400 OR (regexp_matches(html, '(?i)(enable|requires) javascript') AND {_bare("html")} < 1500) THEN 'browser'
    WHEN regexp_matches(html, '(?i){_MORE}') THEN 'more_pages'
    WHEN len(regexp_extract_all(substr(html, 1, 20000), '(?i){fixed.LISTING_DATE}')) >= 3 THEN 'listing' ELSE 'final' END AS tier,
    regexp_matches(html, '\\b(20(1[0-9]|2[0-5]))\\b') AND NOT regexp_matches(html, '\\b2026\\b') AS old FROM pages"""
)
def page_fetch_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.col("html")
    tier = F.when(text.blocked(h), "blocked").when(text.js_shell(h), "browser").when(text.more_pages(h), "more_pages").when(text.like_listing(h), "listing").otherwise("final")
    return table(spark, sf_dir, "pages").select("page_id", tier.alias("tier"), text.too_old(h).alias("old"))


@query("SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'browser' ELSE 'http' END AS fetched_by, length(html) AS n FROM pages")
def fetch_two_tier_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    first = pages.select("page_id", F.when(F.col("page_id") % 2 != 0, F.col("html")).alias("html"), F.lit("http").alias("fetched_by"))
    second = pages.select("page_id", "html", F.lit("browser").alias("fetched_by"))
    return merge.two_tiers(first, second, "page_id", F.col("html").isNull()).select("page_id", "fetched_by", F.length("html").cast("long").alias("n"))


_TITLE = r"trim(regexp_replace(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '\s+', ' ', 'g'))"


@query(
    f"""SELECT page_id, t AS title, length(t) < 4 OR regexp_matches(t, '^[0-9]+$') OR lower(t) IN ({", ".join(f"'{w}'" for w in fixed.GENERIC_HEADINGS)})
    OR regexp_matches(lower(t), '{fixed.LISTING_TITLE}') OR regexp_matches(lower(t), '{fixed.NAV_TITLE.replace("'", "''")}') AS generic FROM (SELECT page_id, {_TITLE} AS t FROM pages)"""
)
def page_title_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = text.squeeze(F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1))
    return table(spark, sf_dir, "pages").select("page_id", title.alias("title")).withColumn("generic", titles.generic_title(F.col("title")))


@query(
    "SELECT page_id, href, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS href FROM pages) "
    "WHERE trim(href) <> '' AND NOT regexp_matches(lower(trim(href)), '^(#|javascript:|mailto:|tel:)') GROUP BY ALL"
)
def anchor_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    hrefs = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href"))
    return hrefs.where(text.valid_href(F.col("href"))).groupBy("page_id", "href").agg(F.count("*").alias("n"))


@query(
    f"SELECT page_id, t <> '' AND contains(p, lower(t)) AS own_title, contains(p, 'no page says this') AS other FROM (SELECT page_id, {_TITLE} AS t, lower(trim(regexp_replace(html, '\\s+', ' ', 'g'))) AS p FROM pages)"
)
def proof_on_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)
    return table(spark, sf_dir, "pages").select("page_id", text.on_page(title, F.col("html")).alias("own_title"), text.on_page(F.lit("No page  says this"), F.col("html")).alias("other"))


@query("SELECT doc_id, substr(sha1(coalesce(text, '')), 1, 16) AS fingerprint, doc_id % 5 = 0 AS changed FROM documents")
def fingerprint_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"), text.fingerprint(F.col("text")).alias("fingerprint"), F.lit("new").alias("record"))
    state = docs.select("event_id", F.when(F.col("event_id") % 5 == 0, "other").otherwise(F.col("fingerprint")).alias("fingerprint"), F.lit("kept").alias("record"))
    return merge.reuse(docs, state).select(F.col("event_id").alias("doc_id"), "fingerprint", "changed")


