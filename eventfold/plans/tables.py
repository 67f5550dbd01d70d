"""Queries over the business tables as events: dates, buckets, merges, the master, statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, taxonomy, text, titles
from ..operators import dedupe, master, merge, report
from ..sources import organisations
from .registry import query, table

TODAY = dt.date(1998, 1, 1)

# --- dates

_SHAPES = """CASE o_orderkey % 6 WHEN 0 THEN strftime(d, '%d %B %Y') WHEN 1 THEN strftime(d, '%B %d, %Y') WHEN 2 THEN strftime(d, '%d-%m-%Y')
  WHEN 3 THEN strftime(d, '%B %Y') WHEN 4 THEN strftime(d, '%d %b') ELSE 'Meeting on ' || strftime(d, '%d %b %Y') || ' at noon' END"""
_ORDERS = "(SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders)"


def _shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    f = lambda p: F.date_format(d, p)
    k = F.col("o_orderkey") % 6
    said = F.when(k == 0, f("dd MMMM yyyy")).when(k == 1, f("MMMM dd, yyyy")).when(k == 2, f("dd-MM-yyyy")).when(k == 3, f("MMMM yyyy")).when(k == 4, f("dd MMM")).otherwise(F.concat(F.lit("Meeting on "), f("dd MMM yyyy"), F.lit(" at noon")))
    return table(spark, sf_dir, "orders").select("o_orderkey", d.alias("d"), said.alias("said"))


@query(f"SELECT o_orderkey, {_SHAPES} AS said, o_orderkey % 6 <> 3 AS has_day, o_orderkey % 6 <> 4 AS has_year FROM {_ORDERS}")
def date_precision_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(spark, sf_dir).select("o_orderkey", "said", dates.has_day(F.col("said")).alias("has_day"), dates.has_year(F.col("said")).alias("has_year"))


@query(
    # day-month-year numbers read month first where they can
    f"""SELECT o_orderkey, {_SHAPES} AS said, CASE WHEN o_orderkey % 6 IN (3, 4) THEN NULL
    WHEN o_orderkey % 6 = 2 AND day(d) <= 12 THEN strftime(make_date(year(d), day(d), month(d)), '%Y-%m-%d') ELSE strftime(d, '%Y-%m-%d') END AS first_day FROM {_ORDERS}"""
)
def strict_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _shaped(spark, sf_dir)
    return rows.withColumn("r", dates.strict(F.col("said"), TODAY)).select("o_orderkey", "said", F.col("r.start").cast("string").alias("first_day"))


_SENTENCE = "'Held ' || strftime(d, '%d %B %Y') || ', was ' || strftime(d + 9, '%B %d, %Y') || ' or ' || strftime(d + 40, '%d/%m/%Y')"


@query(f"SELECT o_orderkey, CAST(len(list_distinct([d, d + 9, d + 40])) AS INTEGER) AS n, strftime(d, '%Y-%m-%d') AS first_one, strftime(d + 40, '%Y-%m-%d') AS last_one FROM {_ORDERS}")
def stated_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    said = F.concat(F.lit("Held "), F.date_format(d, "dd MMMM yyyy"), F.lit(", was "), F.date_format(d + F.expr("interval 9 day"), "MMMM dd, yyyy"), F.lit(" or "), F.date_format(F.date_add(d, 40), "dd/MM/yyyy"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", dates.stated(said).alias("s"))
    return rows.select("o_orderkey", F.size("s").alias("n"), F.element_at("s", 1).cast("string").alias("first_one"), F.element_at("s", -1).cast("string").alias("last_one"))


@query(f"SELECT o_orderkey, o_orderkey % 4 IN (1, 3) AS conflict FROM {_ORDERS}")
def date_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.to_date("o_orderdate"), F.col("o_orderkey") % 4
    said = F.when(k == 0, F.date_format(d, "d MMM yyyy")).when(k == 1, F.date_format(F.date_add(d, 5), "d MMM yyyy")).when(k == 2, F.lit("no date")).otherwise(F.date_format(F.date_add(d, -1), "MMMM d, yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.conflicts(d, F.date_add(d, 2), F.concat(F.lit("On "), said)).alias("conflict"))


@query(
    f"SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN false ELSE d < DATE '1998-01-01' END AS past, CASE WHEN o_orderkey % 10 = 0 THEN true ELSE d >= DATE '1996-01-01' END AS kept, "
    f"CASE WHEN o_orderkey % 3 = 0 THEN false WHEN o_orderkey % 3 = 1 THEN d + 5 < DATE '1998-01-01' ELSE coalesce(CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE d END < DATE '1998-01-01', false) END AS over FROM {_ORDERS}"
)
def past_and_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    d = F.to_date("o_orderdate")
    start = F.when(k % 10 != 0, d)
    end_text = F.when(k % 3 == 0, "to be announced").when(k % 3 == 1, dates.display(F.date_add(d, 5)))
    over = report.record_past(start, end_text, dates.from_display(end_text), TODAY)
    kept = F.coalesce(start >= F.lit(dt.date(1996, 1, 1)), F.lit(True))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.is_past(start, TODAY).alias("past"), kept.alias("kept"), over.alias("over"))


# --- buckets, duplicates, statistics

_EVENTS = f"""(SELECT o.o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'Register' ELSE 'Event ' || o_orderkey END AS name, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE d END AS day,
  CASE WHEN o_orderkey % 2 = 0 THEN 'In Person' ELSE 'Virtual' END AS format, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'Nation ' || c_nationkey END AS location,
  c_mktsegment AS category, c_custkey AS organizer, c_nationkey AS nation FROM {_ORDERS} o JOIN customer ON o_custkey = c_custkey)"""
_BUCKET = """CASE WHEN category = 'MACHINERY' OR name = 'Register' THEN 'flagged' WHEN day IS NULL OR (format = 'In Person' AND location = '') THEN 'incomplete'
  WHEN day < DATE '1998-01-01' THEN 'past' ELSE 'upcoming' END"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select(
        k.alias("k"),
        F.when(k % 11 == 0, "Register").otherwise(F.concat(F.lit("Event "), k.cast("string"))).alias("name"),
        F.when(k % 10 != 0, F.to_date("o_orderdate")).alias("day"),
        F.when(k % 2 == 0, "In Person").otherwise("Virtual").alias("format"),
        F.when(k % 6 == 0, "").otherwise(F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string"))).alias("location"),
        F.col("c_mktsegment").alias("category"),
        F.col("c_custkey").alias("organizer"),
        F.col("c_nationkey").alias("nation"),
    )


def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    c = F.col
    return e.withColumn("bucket", report.bucket(c("name"), c("category") != "MACHINERY", c("day"), F.lit(None), c("format"), c("location"), TODAY))


@query(f"SELECT k, {_BUCKET} AS bucket FROM {_EVENTS}")
def bucket_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bucketed(spark, sf_dir).select("k", "bucket")


@query(
    f"SELECT organizer, count(*) FILTER (NOT p) AS upcoming, count(*) FILTER (p) AS past, count(*) AS total, min(k) AS first_seen FROM (SELECT *, coalesce(day < DATE '1998-01-01', false) AS p FROM {_EVENTS}) GROUP BY organizer"
)
def organizer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.per_organizer(_events(spark, sf_dir), "organizer", dates.is_past(F.col("day"), TODAY), "k")


@query(
    f"SELECT coalesce(country, 'TOTAL') AS country, count(*) AS events, count(DISTINCT organizer) AS organizers, count(*) FILTER (b = 'upcoming') AS upcoming, count(*) FILTER (b = 'flagged') AS flagged "
    f"FROM (SELECT *, {_BUCKET} AS b, n_name AS country FROM {_EVENTS} JOIN nation ON nation = n_nationkey) GROUP BY ROLLUP (country)"
)
def stats_per_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _bucketed(spark, sf_dir).join(table(spark, sf_dir, "nation"), F.col("nation") == F.col("n_nationkey")).withColumn("country", F.col("n_name"))
    n = lambda b: F.count_if(F.col("bucket") == b)
    return report.with_total(rows, "country", events=F.count("*"), organizers=F.countDistinct("organizer"), upcoming=n("upcoming"), flagged=n("flagged"))


@query("SELECT r_name AS country, coalesce(n, 0) AS events, CASE WHEN n IS NULL THEN 'failed' ELSE 'ok' END AS status FROM region LEFT JOIN (SELECT n_regionkey, count(*) AS n FROM nation WHERE n_regionkey % 2 = 0 GROUP BY 1) ON r_regionkey = n_regionkey")
def summary_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each configured country with its run's summary; a missing one has failed."""
    summaries = table(spark, sf_dir, "nation").where(F.col("n_regionkey") % 2 == 0).groupBy("n_regionkey").agg(F.count("*").alias("n"))
    joined = table(spark, sf_dir, "region").join(summaries, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return joined.select(F.col("r_name").alias("country"), F.coalesce("n", F.lit(0)).alias("events"), F.when(F.col("n").isNull(), "failed").otherwise("ok").alias("status"))


@query(
    "SELECT l_orderkey, l_linenumber, mode, note FROM (SELECT l_orderkey, l_linenumber, mode, note, row_number() OVER (PARTITION BY l_orderkey ORDER BY (mode <> '')::INT + (note <> '')::INT DESC, l_linenumber, l_partkey, l_suppkey) AS i FROM "
    "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 3 = 0 THEN '' ELSE 'm' || l_partkey % 5 END AS mode, CASE WHEN l_suppkey % 2 = 0 THEN '' ELSE 'n' || l_suppkey % 7 END AS note FROM lineitem)) WHERE i = 1"
)
def dedupe_keep_fullest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_partkey") % 3 == 0, "").otherwise(F.concat(F.lit("m"), (F.col("l_partkey") % 5).cast("string"))).alias("mode"),
        F.when(F.col("l_suppkey") % 2 == 0, "").otherwise(F.concat(F.lit("n"), (F.col("l_suppkey") % 7).cast("string"))).alias("note"),
    )
    return dedupe.keep_fullest(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], ["mode", "note"]).drop("l_partkey", "l_suppkey")


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    first = dedupe.keep_first(docs, ["h"], ["doc_id"])
    return first.join(docs.groupBy("h").agg(F.count("*").alias("copies")), "h").select("doc_id", "copies")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN i = 1 THEN 'ev_' || l_orderkey ELSE 'ev_' || l_orderkey || '~' || i END AS event_id FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem)")
def id_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.concat(F.lit("ev_"), F.col("l_orderkey").cast("string")).alias("event_id"))
    return dedupe.suffix_ids(rows, "event_id", ["l_linenumber", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "event_id")


@query("SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS i FROM events) WHERE i <= 50")
def recent_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 50 of each kind."""
    return dedupe.recent(table(spark, sf_dir, "events"), ["event_type"], [F.desc("ts"), F.desc("event_id")]).select("event_type", "event_id")


@query("SELECT s_suppkey AS ord, s_name AS organizer, 'https://' || lower(replace(s_name, '#', '-')) AS url FROM supplier ORDER BY s_suppkey LIMIT 40 OFFSET 3")
def org_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("No."), F.col("s_name").alias(" Organisation / Website "), F.concat(F.lit("https://"), F.lower(F.regexp_replace("s_name", "#", "-"))).alias("Official Events Page"))
    orgs = organisations.read(odd, order="No.")
    return orgs.orderBy("ord").offset(3).limit(40).select("ord", "organizer", "url")


@query("SELECT s_suppkey AS ord, s_name AS organizer, 'x' || s_nationkey AS category, NULL::VARCHAR AS country, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE 'https://s' || s_suppkey || '.example' END AS url FROM supplier WHERE s_suppkey % 9 <> 0")
def org_header_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    odd = s.select(
        F.col("s_suppkey").alias("No."), F.col("s_name").alias("ORGANIZATION"), F.concat(F.lit("x"), F.col("s_nationkey").cast("string")).alias("Main focus"),
        F.when(F.col("s_suppkey") % 9 != 0, F.concat(F.lit("https://s"), F.col("s_suppkey").cast("string"), F.lit(".example"))).alias("Link to list"),
    )
    return organisations.read(odd, order="No.")


@query(
    "SELECT p_partkey, (row_number() OVER (ORDER BY p_partkey) - 1) // 60 AS batch, CASE WHEN ((row_number() OVER (ORDER BY p_partkey) - 1) // 60) % 4 = 3 THEN true ELSE p_partkey % 3 <> 0 END AS keep FROM part"
)
def llm_batching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 60 in order of keys; verdicts are found by id, and a batch without an answer keeps its rows."""
    from ..sources import review

    parts = table(spark, sf_dir, "part").select("p_partkey")
    batches = review.batches(parts, "p_partkey", 60)
    verdicts = batches.where(F.col("batch") % 4 != 3).select("p_partkey", (F.col("p_partkey") % 3 != 0).alias("verdict"))
    return review.keep(batches, verdicts, "p_partkey").select("p_partkey", "batch", "keep")


@query("SELECT doc_id, spent, spent - cost >= 200000 AS over FROM (SELECT doc_id, n_chars AS cost, sum(n_chars) OVER (ORDER BY doc_id)::BIGINT AS spent FROM documents)")
def budget_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.spend(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", F.col("n_chars"), 200_000).select("doc_id", "spent", "over")


@query(
    "SELECT reason, count(*) AS n FROM (SELECT unnest(['event date ... has already passed', 'title ... is a ' || event_type]) AS reason FROM events) GROUP BY 1 ORDER BY n DESC, reason LIMIT 8"
)
def reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    said = F.array(F.concat(F.lit("event date "), F.date_format("ts", "dd-MMM-yyyy"), F.lit(" has already passed")), F.concat(F.lit("title '"), F.col("event_id").cast("string"), F.lit("' is a "), F.col("event_type")))
    return report.reason_counts(e.select(said.alias("reasons")), "reasons")


@query(
    """WITH h AS (SELECT user_id, count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS now, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS before FROM events GROUP BY 1)
    SELECT 'u' || user_id AS source_url, now AS events, CASE WHEN user_id % 13 = 0 THEN 0 ELSE before END AS before, CASE WHEN user_id % 17 = 0 THEN 'failed'
    WHEN now = 0 AND (CASE WHEN user_id % 13 = 0 THEN 0 ELSE before END) > 0 THEN 'empty' WHEN user_id % 13 <> 0 AND before >= 6 AND now < before * 0.5 THEN 'big_drop' ELSE 'ok' END AS status FROM h"""
)
def site_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    h = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(half).alias("now"), F.count_if(~half).alias("was"))
    url = F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source_url")
    current = h.select(url, F.lit("o").alias("organizer"), F.col("now").alias("events"), F.when(F.col("user_id") % 17 == 0, "timeout").alias("error"))
    previous = h.where(F.col("user_id") % 13 != 0).select(url, F.col("was").alias("events"))
    return report.health(current, previous).select("source_url", "events", "before", "status")


# --- merges

_OLD = "(SELECT o_orderkey AS ord, 'E' || o_orderkey % 5000 AS name, CASE WHEN o_orderkey % 4 = 0 THEN strftime(d, '%B %Y') ELSE strftime(d, '%d %B %Y') END AS date, d, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'L' || o_custkey END AS location FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders) WHERE o_orderkey % 2 = 0)"
_NEW = "(SELECT o_orderkey AS ord, 'E' || o_orderkey % 5000 AS name, strftime(d, '%d %B %Y') AS date, d, 'L' || o_custkey AS location FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders) WHERE o_orderkey % 2 = 1 OR o_orderkey % 10 = 0)"


@query(
    f"""WITH o AS (SELECT * FROM {_OLD}), f AS (SELECT *, row_number() OVER (PARTITION BY name, date ORDER BY ord) AS i FROM {_NEW} n WHERE d >= DATE '1996-01-01' AND NOT EXISTS (SELECT 1 FROM o WHERE o.name = n.name AND lower(o.date) = lower(n.date))),
    f1 AS (SELECT * FROM f WHERE i = 1), open_ AS (SELECT name, max(ord) AS old FROM o WHERE ord % 4 = 0 GROUP BY name), first_ AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ord) AS j FROM f1),
    r AS (SELECT old, f.* FROM first_ f JOIN open_ USING (name) WHERE j = 1)
    SELECT o.ord, o.name AS event_name, coalesce(r.date, o.date) AS date, CASE WHEN r.old IS NULL OR o.location <> '' THEN o.location ELSE r.location END AS location, CASE WHEN r.old IS NULL THEN 'kept' ELSE 'repaired' END AS action FROM o LEFT JOIN r ON o.ord = r.old
    UNION ALL SELECT ord, name, date, location, 'added' FROM f1 WHERE ord NOT IN (SELECT ord FROM r)"""
)
def raw_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    o = table(spark, sf_dir, "orders")
    base = [k.alias("ord"), F.concat(F.lit("E"), (k % 5000).cast("string")).alias("event_name")]
    place = F.concat(F.lit("L"), F.col("o_custkey").cast("string"))
    old = o.where(k % 2 == 0).select(*base, F.when(k % 4 == 0, F.date_format(d, "MMMM yyyy")).otherwise(F.date_format(d, "dd MMMM yyyy")).alias("date"), d.alias("event_date"), F.when(k % 3 == 0, "").otherwise(place).alias("location"))
    new = o.where((k % 2 == 1) | (k % 10 == 0)).select(*base, F.date_format(d, "dd MMMM yyyy").alias("date"), d.alias("event_date"), place.alias("location"))
    return merge.raw_upsert(old, new, cutoff=dt.date(1996, 1, 1), today=TODAY, fill=("location",)).select("ord", "event_name", "date", "location", "action")


@query(
    """SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 7 = 0 THEN 'new' WHEN o_orderkey % 5 = 0 THEN 'changed' ELSE 'unchanged' END AS fate FROM orders WHERE o_orderkey % 3 <> 0
    UNION ALL SELECT o_orderkey, 'untouched' FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 7 <> 0"""
)
def incremental_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("ord"), F.concat(F.lit("Event "), k.cast("string")).alias("event_name"), F.date_format("o_orderdate", "dd-MMM-yyyy").alias("date"), F.col("o_orderstatus").alias("location"), F.lit("upcoming").alias("bucket"))
    o = F.col("ord")
    previous = rows.where(o % 7 != 0).withColumn("location", F.when(o % 5 == 0, "elsewhere").otherwise(F.col("location")))
    return merge.difference(previous, rows.where(o % 3 != 0), ["location"]).select("ord", "fate")


@query(
    """WITH p AS (SELECT p_partkey, p_partkey % 2 = 0 AS has_l, p_partkey % 3 <> 0 AS has_d, CASE p_partkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS lc, CASE p_partkey % 4 WHEN 0 THEN 'high' ELSE 'medium' END AS dc FROM part)
    SELECT p_partkey, CASE WHEN NOT has_l AND NOT has_d THEN NULL WHEN NOT has_d THEN 'list' WHEN NOT has_l THEN 'detail' WHEN (CASE lc WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) > (CASE dc WHEN 'high' THEN 3 ELSE 2 END) THEN 'list' ELSE 'detail' END AS name,
    CASE WHEN has_l AND has_d THEN NULL WHEN has_l THEN 'list' WHEN has_d THEN 'detail' END AS date, CASE WHEN has_l AND has_d THEN 1 ELSE 0 END AS conflicts FROM p"""
)
def merge_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")

    def cell(value: str, there, confidence):
        return F.when(there, F.struct(F.lit(value).alias("value"), F.lit(value).alias("match"), F.lit("r").alias("reason"), F.lit("s").alias("source"), confidence.alias("confidence")))

    lc = F.when(k % 3 == 0, "high").when(k % 3 == 1, "medium").otherwise("low")
    dc = F.when(k % 4 == 0, "high").otherwise("medium")
    rows = table(spark, sf_dir, "part").select("p_partkey", *[cell("list", k % 2 == 0, lc).alias(f"l_{c}") for c in ("name", "date")], *[cell("detail", k % 3 != 0, dc).alias(f"d_{c}") for c in ("name", "date")])
    out = merge.merge_fields(rows, ["name", "date"], ["date"])
    return out.select("p_partkey", F.col("name")["value"].alias("name"), F.col("date")["value"].alias("date"), F.size("conflicts").alias("conflicts"))


_RECORDS = """(SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 9 = 0 THEN 'verified' WHEN o_orderkey % 9 = 1 THEN 'needs_review' WHEN o_orderkey % 9 = 2 THEN 'rejected' WHEN o_orderkey % 9 = 3 THEN 'past' ELSE 'verified' END AS status,
  o_orderkey % 5 <> 0 AS changed FROM orders)"""


@query(
    f"""SELECT ord, CASE WHEN status = 'past' THEN CASE WHEN ord % 4 = 0 THEN 'seen' ELSE 'nothing' END WHEN ord % 4 = 0 AND ord % 8 = 0 THEN 'locked_skipped'
    WHEN status = 'verified' THEN CASE WHEN ord % 4 = 0 THEN CASE WHEN changed THEN 'updated' ELSE 'unchanged' END WHEN ord % 4 = 1 THEN 'promoted' ELSE 'added' END
    WHEN status = 'needs_review' THEN CASE WHEN ord % 4 = 0 THEN 'kept_after_failed_rescrape' WHEN ord % 4 = 1 THEN 'review_updated' ELSE 'sent_to_review' END ELSE 'rejected' END AS action FROM {_RECORDS}"""
)
def master_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, kept = _records(spark, sf_dir)
    return master.decide(records, kept).select("ord", "action")


def _records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("o_orderkey")
    r = F.col("o_orderkey") % 9
    status = F.when(r == 1, "needs_review").when(r == 2, "rejected").when(r == 3, "past").otherwise("verified")
    o = table(spark, sf_dir, "orders")
    ident = [F.concat(F.lit("ev_"), k.cast("string")).alias("event_id"), F.concat(F.lit("Event "), k.cast("string")).alias("event_name"), F.date_format("o_orderdate", "dd-MMM-yyyy").alias("date")]
    records = o.select(k.alias("ord"), *ident, status.alias("status"), (k % 5 != 0).alias("changed"))
    kept = o.where(k % 4 <= 1).select(*ident, F.when(k % 4 == 0, "verified").otherwise("review").alias("bucket"), F.when(k % 8 == 0, "Yes").otherwise("").alias("locked"), F.lit("Rules").alias("verified_by"))
    return records, kept


@query(
    "SELECT 'ev_' || o_orderkey AS event_id, field, old_value, new_value FROM (SELECT o_orderkey, 'location' AS field, 'L' || o_custkey AS old_value, CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN 'moved' ELSE 'L' || o_custkey END AS new_value FROM orders "
    "UNION ALL SELECT o_orderkey, 'date', strftime(o_orderdate, '%d-%b-%Y'), strftime(CASE WHEN o_orderkey % 6 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END, '%d-%b-%Y') FROM orders) WHERE new_value <> '' AND new_value <> old_value"
)
def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders")
    eid, place = F.concat(F.lit("ev_"), k.cast("string")).alias("event_id"), F.concat(F.lit("L"), F.col("o_custkey").cast("string"))
    d = F.to_date("o_orderdate")
    old = o.select(eid, place.alias("location"), dates.display(d).alias("date"))
    new = o.select(eid, F.when(k % 4 == 0, "").when(k % 4 == 1, "moved").otherwise(place).alias("location"), dates.display(F.when(k % 6 == 0, F.date_add(d, 1)).otherwise(d)).alias("date"))
    return master.changes(old, new, ["location", "date"])


@query(
    """WITH u AS (SELECT user_id, CAST(max(ts) AS DATE) AS last_seen FROM events GROUP BY 1)
    SELECT 'ev_' || user_id AS event_id, CASE WHEN user_id % 10 = 0 THEN 'kept' WHEN user_id % 7 = 0 THEN 'past' WHEN user_id % 3 <> 0 AND user_id % 5 <> 0 AND user_id % 4 <> 0 AND date_diff('day', last_seen, DATE '2024-02-12') > 14 THEN 'missing' ELSE 'kept' END AS outcome FROM u"""
)
def missing_and_past(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = table(spark, sf_dir, "events").groupBy("user_id").agg(F.to_date(F.max("ts")).alias("last_seen"))
    k = F.col("user_id")
    name = k.cast("string")
    verified = u.select(
        F.concat(F.lit("ev_"), name).alias("event_id"),
        F.when(k % 4 == 0, "https://shared.example/p").otherwise(F.concat(F.lit("https://own.example/"), name)).alias("link"),
        F.concat(F.lit("https://site.example/"), (k % 5).cast("string")).alias("source_url"),
        F.when(k % 7 == 0, F.lit(dt.date(2024, 1, 1))).otherwise(F.lit(dt.date(2025, 1, 1))).alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        "last_seen",
        F.when(k % 10 == 0, "yes").otherwise("").alias("locked"),
    )
    seen = u.where(k % 3 == 0).select(F.concat(F.lit("ev_"), name).alias("event_id"))
    sites = spark.range(5).select(F.concat(F.lit("https://site.example/"), F.col("id").cast("string")).alias("source_url"), F.when(F.col("id") == 0, "big_drop").otherwise("ok").alias("status"))
    return report.missing_and_past(verified, seen, sites, dt.date(2024, 2, 12)).select("event_id", "outcome")


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    cell = lambda v, there, c=None: F.when(there, F.struct(v.alias("value"), v.alias("match"), F.lit("r").alias("reason"), F.lit("s").alias("source"), (c if c is not None else F.lit("high")).alias("confidence")))
    name = F.when(k % 8 == 1, "Register").when(k % 8 == 2, "Nowhere on it").otherwise("Tax Day")
    day = F.when(k % 5 == 1, "someday").otherwise(dates.display(d))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        cell(name, k % 8 != 0, F.when(k % 3 == 0, "medium").otherwise("high")).alias("name"),
        cell(day, k % 5 != 0).alias("date"),
        cell(F.lit(""), F.lit(False)).alias("end_date"),
        cell(F.when(k % 7 == 0, "Tokyo").otherwise("London"), F.lit(True)).alias("location"),
        cell(F.lit("Virtual"), F.lit(True)).alias("format"),
        F.when(k % 4 == 0, "Unclear").otherwise("Tax").alias("category"),
        F.concat(F.lit("REGISTER  tax day virtual London Tokyo someday "), dates.display(d)).alias("page"),
    )


@query(
    """SELECT o_orderkey, unnest(list_filter([CASE WHEN o_orderkey % 8 = 0 THEN 'no_title' END, CASE WHEN o_orderkey % 8 = 1 THEN 'generic_title' END, CASE WHEN o_orderkey % 8 <> 0 AND o_orderkey % 3 = 0 THEN 'weak_title' END,
    CASE WHEN o_orderkey % 8 = 2 THEN 'unproved_name' END, CASE WHEN o_orderkey % 5 = 0 THEN 'no_date' END, CASE WHEN o_orderkey % 5 = 1 THEN 'bad_date' END, CASE WHEN o_orderkey % 5 > 1 AND d < DATE '1998-01-01' THEN 'past_date' END,
    CASE WHEN o_orderkey % 7 = 0 THEN 'untracked' END, CASE WHEN o_orderkey % 4 = 0 THEN 'category' END], lambda x: x IS NOT NULL)) AS code FROM """
    + _ORDERS
)
def verify_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a projection of its own: exploding an expression over fields of structs reads wrong columns in this version of Spark
    return _candidates(spark, sf_dir).select("o_orderkey", report.failures(TODAY).alias("codes")).select("o_orderkey", F.explode("codes").alias("code"))


@query(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'rejected' WHEN o_orderkey % 3 = 0 AND o_orderkey % 4 <> 0 THEN 'past' WHEN o_orderkey % 5 = 0 OR o_orderkey % 4 = 0 THEN 'needs_review' ELSE 'verified' END AS status FROM orders"
)
def candidate_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    some = lambda c, x: F.when(c, F.array(F.lit(x))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "orders").select("o_orderkey", report.status(k % 7 == 0, k % 3 == 0, some(k % 4 == 0, "date"), some(k % 5 == 0, "no_date")).alias("status"))


@query(
    """WITH e AS (SELECT c_custkey AS ord, 'Event ' || c_custkey % 400 AS event_name, strftime(DATE '1998-01-01' + CAST(c_custkey % 400 AS INTEGER), '%d-%b-%Y') AS date, CASE WHEN c_custkey % 5 = 0 THEN 'London' WHEN c_custkey % 5 = 1 THEN 'Tokyo' ELSE '' END AS location, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'text' END AS description, n_name AS source_country FROM customer JOIN nation ON c_nationkey = n_nationkey),
    c AS (SELECT *, CASE WHEN location = 'London' THEN 'UK' ELSE source_country END AS country, location = 'Tokyo' AS review FROM e),
    v AS (SELECT *, row_number() OVER (PARTITION BY event_name, date ORDER BY (location <> '')::INT + (description <> '')::INT DESC, ord) AS i FROM c WHERE NOT review)
    SELECT ord, event_name, date, country, 'verified' AS bucket FROM v WHERE i = 1 UNION ALL SELECT ord, event_name, date, country, 'review' FROM c WHERE review"""
)
def cross_country_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all countries as one: places decide the country, untracked ones go to review, the fullest of each name and date stays."""
    k = F.col("c_custkey")
    e = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        k.alias("ord"), F.concat(F.lit("Event "), (k % 400).cast("string")).alias("event_name"), dates.display(F.date_add(F.lit(TODAY), (k % 400).cast("int"))).alias("date"),
        F.when(k % 5 == 0, "London").when(k % 5 == 1, "Tokyo").otherwise("").alias("location"), F.when(k % 3 == 0, "").otherwise("text").alias("description"), F.col("n_name").alias("source_country"),
    )
    from . import jobs

    return jobs.across_countries(e).select("ord", "event_name", "date", "country", "bucket")


# --- the flagship


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.lit("").alias("source"), text.squeeze(F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)).alias("title"), text.js_shell(F.col("html")).alias("shell"), text.host(F.col("url")).alias("host"))
    rows = report.own_page(rows, "url", "source")
    kept = dedupe.keep_fullest(rows, [F.lower("title")], ["page_id"], ["title", "url"])
    kept = kept.withColumns({"category": taxonomy.category(F.col("title"), F.lit("")), "generic": titles.generic_title(F.col("title"))})
    n = lambda c: F.count_if(F.col(c))
    return report.with_total(kept, "host", pages=F.count("*"), own_pages=n("own_page"), shells=n("shell"), generic=n("generic"), topical=F.count_if(F.col("category").isin(*report.ACCEPTED)))




@query()
def page_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagship(spark, sf_dir)


