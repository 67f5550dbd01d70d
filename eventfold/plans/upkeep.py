"""Queries over what happens to tables from run to run: loading, moving and completing rows, sheets, checks in words, and pages without lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, extract, titles
from ..operators import lifecycle, master, report
from ..sources import sheets
from . import digest, tables
from .registry import query, table
from .runs import _DAY, _customers, _text
from .tables import _ORDERS, TODAY


@query(
    f"""SELECT o_orderkey, concat_ws('; ', CASE WHEN o_orderkey % 8 = 0 THEN 'no event title' END, CASE WHEN o_orderkey % 8 = 1 THEN 'title ''Register'' is a generic label, not an event name' END,
    CASE WHEN o_orderkey % 8 <> 0 AND o_orderkey % 3 = 0 THEN 'title only came from a s (medium confidence)' END, CASE WHEN o_orderkey % 8 = 2 THEN 'name ''Nowhere on it'' could not be found on the event page' END,
    CASE WHEN o_orderkey % 5 = 0 THEN 'no event date' END, CASE WHEN o_orderkey % 5 = 1 THEN 'date ''someday'' is not a real date' END, CASE WHEN o_orderkey % 5 > 1 AND d < DATE '1998-01-01' THEN 'event date ' || strftime(d, '%d-%b-%Y') || ' has already passed' END,
    CASE WHEN o_orderkey % 7 = 0 THEN 'location ''Tokyo'' is in a country we don''t track' END, CASE WHEN o_orderkey % 4 = 0 THEN 'the rules could not place it in Tax, Finance or Legal (goes to the AI review, not rejected)' END) AS said FROM {_ORDERS}"""
)
def verify_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables._candidates(spark, sf_dir)
    told = rows.withColumn("codes", report.failures(TODAY))
    return told.select("o_orderkey", report.messages(F.col("codes")).alias("said")).select("o_orderkey", F.array_join("said", "; ").alias("said"))


@query(
    """WITH r AS (SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 2 = 0 THEN 'verified' ELSE 'review' END AS bucket, o_orderkey % 3 = 0 AS old,
      CASE WHEN o_orderkey % 3 = 0 THEN 'ev_' || substr(sha1('name|org|event ' || o_orderkey), 1, 12) ELSE 'ev_' || o_custkey END AS id FROM orders WHERE o_orderkey % 7 <> 0),
    n AS (SELECT *, row_number() OVER (PARTITION BY bucket, id ORDER BY ord) AS i FROM r)
    SELECT ord, bucket, id || CASE WHEN i > 1 THEN '~' || i ELSE '' END AS event_id, CASE WHEN old THEN 'Legacy (before v2)' ELSE '' END AS verified_by, CASE WHEN ord % 4 = 0 THEN '01-Dec-1997' ELSE '01-Jan-1998' END AS last_seen FROM n"""
)
def master_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as kept rows: some without a name, without an id, with an id that others have, or without the day they were seen."""
    k = F.col("o_orderkey")
    kept = table(spark, sf_dir, "orders").select(
        k.alias("ord"), F.when(k % 2 == 0, "verified").otherwise("review").alias("bucket"), F.when(k % 3 != 0, _text("ev_", F.col("o_custkey"))).alias("event_id"),
        F.when(k % 7 != 0, _text("Event ", k)).alias("event_name"), F.lit("Org").alias("organizer"), F.when(k % 4 == 0, "01-Dec-1997").alias("last_seen"),
    )
    return lifecycle.load(kept, TODAY).select("ord", "bucket", "event_id", "verified_by", "last_seen")


_AGED = """(SELECT k, CASE WHEN k % 10 = 0 THEN 'kept' WHEN day < DATE '1998-01-01' THEN 'past' WHEN k % 3 <> 0 AND o_custkey % 5 <> 0 AND k % 4 = 2 THEN 'missing' ELSE 'kept' END AS outcome
  FROM (SELECT o_orderkey AS k, o_custkey, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 * 400 AS INTEGER) AS day FROM orders))"""


def _aged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as verified rows, a tenth of them with a row of the same id among the past ones, after a run that saw a third of them."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders")
    site = _text("https://site.example/", F.col("o_custkey") % 5)
    eid, name = _text("ev_", k).alias("event_id"), _text("Event ", k).alias("event_name")
    verified = o.select(
        k.alias("ord"), F.lit("verified").alias("bucket"), eid, name, dates.display(F.date_add(F.to_date("o_orderdate"), (k % 5 * 400).cast("int"))).alias("date"), site.alias("source_url"),
        F.when(k % 4 == 0, "https://shared.example/p").otherwise(_text("https://own.example/", k)).alias("register_link"), F.when(k % 2 == 0, "01-Dec-1997").otherwise("25-Dec-1997").alias("last_seen"), F.when(k % 10 == 0, "yes").alias("locked"),
    )
    before = o.where(k % 10 == 1).select((-k).alias("ord"), F.lit("past").alias("bucket"), eid, name)
    seen = o.where(k % 3 == 0).select(eid)
    sites = spark.range(5).select(_text("https://site.example/", F.col("id")).alias("source_url"), F.when(F.col("id") == 0, "empty").otherwise("ok").alias("status"))
    return lifecycle.age(lifecycle.load(verified.unionByName(before, allowMissingColumns=True), TODAY), seen, sites, TODAY)


@query(
    f"""SELECT k AS ord, CASE outcome WHEN 'past' THEN 'past' WHEN 'missing' THEN 'review' ELSE 'verified' END AS bucket, outcome, CASE WHEN outcome = 'missing' THEN 'Not found on its website since 01-Dec-1997' ELSE '' END AS review_reason FROM {_AGED}
    UNION ALL SELECT -k, 'past', 'kept', '' FROM {_AGED} WHERE k % 10 = 1 AND outcome <> 'past'"""
)
def master_ageing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aged(spark, sf_dir).select("ord", "bucket", "outcome", "review_reason")


@query(
    f"""SELECT 'run' AS stamp, 'ev_' || k AS event_id, 'Event ' || k AS event_name, CASE outcome WHEN 'past' THEN 'moved to Past Events' ELSE 'sent to Needs Review' END AS action, '' AS field, '' AS old_value,
    CASE outcome WHEN 'missing' THEN 'Not found on its website since 01-Dec-1997' ELSE '' END AS new_value, CASE outcome WHEN 'past' THEN 'date passed' ELSE 'not on website' END AS source, 'Scraper' AS changed_by FROM {_AGED} WHERE outcome <> 'kept'"""
)
def master_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.log_of_ageing(_aged(spark, sf_dir), "run")


@query(
    f"SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 10 <> 0 AND d < DATE '1998-01-01' THEN 'Past' ELSE 'Upcoming' END AS status, CASE WHEN o_orderkey % 10 <> 0 THEN strftime(d, '%Y-%m-%d') END AS day, '' AS location FROM {_ORDERS} WHERE o_orderkey % 10 = 0 OR d >= DATE '1996-01-01'"
)
def raw_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a raw sheet that lacks most columns."""
    k = F.col("o_orderkey")
    raw = table(spark, sf_dir, "orders").select(k.alias("ord"), F.when(k % 10 != 0, F.date_format("o_orderdate", "d MMMM yyyy")).alias("date"), _text("Event ", k).alias("event_name"))
    return sheets.refreshed(raw, TODAY, dt.date(1996, 1, 1)).select("ord", "status", F.col("day").cast("string").alias("day"), "location")


@query("SELECT o_orderkey AS ord, 'Event ' || o_orderkey AS event_name, o_orderpriority AS organizer, '' AS link FROM orders WHERE o_orderkey % 6 <> 0 AND o_orderstatus <> 'F'")
def upcoming_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    raw = table(spark, sf_dir, "orders").select(k.alias("ord"), F.when(k % 6 != 0, _text(" Event  ", k)).alias("event_name"), F.col("o_orderpriority").alias("organizer"), F.when(F.col("o_orderstatus") == "F", "Past").alias("status"))
    return sheets.upcoming(raw).drop("source_url")


@query("SELECT l_orderkey AS source_url, min(l_linenumber) AS page, l_returnflag AS event_name, l_linestatus AS date FROM lineitem GROUP BY ALL")
def organisation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as what the pages of an order list, each name and date once."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("source_url"), F.col("l_linenumber").alias("page"), F.lit("x").alias("link"), F.col("l_returnflag").alias("event_name"), F.col("l_linestatus").alias("date"))
    return sheets.of_organisation(rows).drop("link")


@query(
    """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0 THEN 'moved' WHEN o_orderkey % 2 = 0 THEN 'C' || o_custkey END AS place, CASE WHEN o_orderkey % 3 <> 0 THEN 'first' WHEN o_orderkey % 4 <> 0 THEN 'late' END AS said,
    CASE WHEN o_orderkey % 4 <> 0 THEN 2 ELSE 1 END AS run FROM orders"""
)
def late_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over orders; the later one's cells win where they say something."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders")
    old = o.select(k.alias("k"), F.when(k % 2 == 0, _text("C", F.col("o_custkey"))).alias("place"), F.when(k % 3 != 0, "first").alias("said"), F.lit(1).alias("run"))
    new = o.where(k % 4 != 0).select(k.alias("k"), F.when(k % 5 != 0, "moved").otherwise(" ").alias("place"), F.when(k % 3 == 0, "late").otherwise("").alias("said"), F.lit(2).alias("run"))
    return lifecycle.fill(old, new, "k", "run")


@query(
    """WITH s AS (SELECT s_nationkey AS country, count(*) AS sites, count(*) FILTER (s_suppkey % 3 = 1) AS sites_failed FROM supplier GROUP BY 1),
    r AS (SELECT c_nationkey AS country, c_custkey AS k, c_custkey % 3 = 0 AS review FROM customer),
    n AS (SELECT country, count(*) AS events, count(*) FILTER (review) AS needs_review, count(*) FILTER (NOT review AND k % 5 = 0) AS fixed_by_retry FROM r GROUP BY 1),
    g AS (SELECT country, reason, count(*) AS n FROM (SELECT country, 'date ... bad' AS reason FROM r WHERE review UNION ALL SELECT country, 'no title' FROM r WHERE review AND k % 2 = 0) GROUP BY ALL),
    t AS (SELECT country, string_agg(n || ' x ' || reason, '; ' ORDER BY n DESC, reason) AS reasons FROM g GROUP BY 1)
    SELECT country, sites, sites_failed, coalesce(events, 0) AS events, coalesce(needs_review, 0) AS needs_review, coalesce(fixed_by_retry, 0) AS fixed_by_retry, coalesce(reasons, '') AS reasons FROM s LEFT JOIN n USING (country) LEFT JOIN t USING (country)"""
)
def run_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of the weekly report, nations as countries."""
    s, k = F.col("s_suppkey"), F.col("c_custkey")
    sites = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("country"), s.alias("source_url"), F.when(s % 3 == 1, "failed").otherwise("ok").alias("status"))
    reasons = F.array_compact(F.array(_text("date '", k, "' bad"), F.when(k % 2 == 0, "no title")))
    records = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("country"), F.when(k % 3 == 0, "needs_review").otherwise("verified").alias("status"), reasons.alias("reasons"), F.when(k % 5 == 0, 1).otherwise(0).alias("attempts"))
    told = F.transform("reasons", lambda r: F.concat(r["n"].cast("string"), F.lit(" x "), r["reason"]))
    return digest.checked(sites, records).select("country", "sites", "sites_failed", "events", "needs_review", "fixed_by_retry", F.array_join(told, "; ").alias("reasons"))


@query(
    f"""SELECT (c_custkey - 1) // 20 AS page, 'Day of ' || c_mktsegment || ' ' || c_custkey AS name, 'https://o.example/e/' || c_custkey AS link, strftime({_DAY}, '%B %-d, %Y') AS date,
    CASE WHEN c_custkey % 3 = 0 THEN 'Virtual' ELSE '' END AS format, CASE WHEN c_custkey % 3 = 1 THEN 'Leeds, UK' ELSE '' END AS location FROM customer"""
)
def customer_notice_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of twenty notices that aren't cards of a list, one for each customer, found by their dates."""
    k = F.col("k")
    more = F.when(k % 3 == 0, "as a webinar").when(k % 3 == 1, "held in Leeds, UK").otherwise("see below")
    notice = _text("<section><h3>Day of ", F.col("segment"), " ", k, "</h3><p>on <b>", F.date_format("day", "MMMM d, yyyy"), "</b> ", more, '</p><a href="/e/', k, '">Details</a></section>')
    rows = _customers(spark, sf_dir).select(((k - 1) / 20).cast("long").alias("page"), F.struct("k", notice.alias("html")).alias("c"))
    pages = rows.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x["html"]), "").alias("body"))
    found = pages.select("page", F.explode(extract.shapes_of_page(_text("<html><body><main>", F.col("body"), "</main></body></html>"), F.lit("https://o.example/notices"))).alias("e"))
    text_ = F.col("e.card_text")
    return found.select("page", "e.name", "e.link", "e.date", titles.format_from_text(text_).alias("format"), titles.location_in_text(text_).alias("location"))


#: Records made of events, in order: several for each user. What each finds is worked out record by record in the recursive part; duplicates are looked up among all rows and records.
_FOLDED = """WITH RECURSIVE rec AS (SELECT event_id AS ord, 'ev_' || user_id AS id, CASE event_type WHEN 'error' THEN 'rejected' WHEN 'signup' THEN 'needs_review' WHEN 'purchase' THEN 'past' ELSE 'verified' END AS s,
    event_id % 4 <> 0 AS changed, 'Event ' || (user_id % 40) AS name, 'day ' || (event_id % 400) AS day, CASE WHEN event_id % 3 = 0 THEN '' ELSE props END AS loc, 'seen ' || event_id AS why FROM events),
  u AS (SELECT DISTINCT user_id AS k FROM events),
  m AS (SELECT 'ev_' || k AS id, CASE WHEN k % 3 = 0 THEN 'review' ELSE 'verified' END AS bucket, k % 9 = 1 AS locked, 'Event ' || (k % 40) AS name, 'day ' || (k % 400) AS day, 'at ' || k AS loc, CASE WHEN k % 7 = 1 THEN 'Legacy' ELSE 'Rules' END AS by_ FROM u WHERE k % 3 < 2
    UNION ALL SELECT 'ev_x' || k, 'verified', false, 'Event ' || (k % 40), 'day ' || (k * 7 % 400), 'at ' || k, 'Legacy' FROM u WHERE k % 2 = 0),
  had AS (SELECT id, max(bucket) AS bucket, bool_or(locked AND bucket = 'verified') AS locked FROM m GROUP BY 1),
  r0 AS (SELECT rec.*, had.bucket AS had, coalesce(had.locked, false) AS locked, row_number() OVER (PARTITION BY id ORDER BY ord) AS i FROM rec LEFT JOIN had USING (id)),
  came AS (SELECT * FROM r0 WHERE s = 'verified' AND NOT locked AND (changed OR had IS NULL)),
  lead AS (SELECT name, day, id, min(ord) AS ord, min(CASE WHEN had IS NULL THEN ord END) AS takes FROM came GROUP BY 1, 2, 3),
  r1 AS (SELECT r0.*, (SELECT min(m.id) FROM m WHERE m.bucket = 'verified' AND m.name = r0.name AND m.day = r0.day AND m.id <> r0.id) AS other,
    EXISTS (SELECT 1 FROM lead WHERE lead.name = r0.name AND lead.day = r0.day AND lead.id <> r0.id AND lead.ord < r0.ord) AS earlier, (SELECT min(takes) FROM lead WHERE lead.name = r0.name AND lead.day = r0.day) AS takes FROM r0),
  r AS (SELECT r1.*, coalesce(NOT earlier AND takes = r1.ord AND m.by_ = 'Legacy' AND m.id NOT IN (SELECT id FROM rec), false) AS taking, m.name AS mname, m.day AS mday, m.loc AS mloc FROM r1 LEFT JOIN m ON m.id = other AND m.bucket = 'verified'),
  f AS (SELECT id, CAST(0 AS BIGINT) AS i, coalesce(m.bucket, 'none') AS at_, m.name AS name, m.day AS day, m.loc AS loc, CASE WHEN m.bucket = 'verified' THEN m.by_ ELSE '' END AS by_, CASE WHEN m.bucket IS NULL THEN NULL ELSE 'before' END AS since, '' AS why,
      CASE WHEN m.bucket = 'review' THEN 'note' ELSE '' END AS note, 'before' AS seen, false AS out, '' AS oname, '' AS oday, '' AS oloc, '' AS owhy, '' AS gone FROM (SELECT DISTINCT id FROM rec) LEFT JOIN m USING (id)
    UNION ALL
    SELECT id, i + 1, CASE act WHEN 'out' THEN 'none' WHEN 'in' THEN 'verified' WHEN 'take' THEN 'verified' WHEN 'hold' THEN 'review' ELSE at_ END,
      CASE WHEN act = 'take' THEN rname WHEN act IN ('in', 'hold', 'up') THEN rname WHEN act = 'out' THEN '' ELSE name END, CASE WHEN act IN ('take', 'in', 'hold', 'up') THEN rday WHEN act = 'out' THEN '' ELSE day END,
      CASE WHEN act = 'take' THEN coalesce(nullif(rloc, ''), mloc) WHEN act IN ('in', 'hold', 'up') THEN coalesce(nullif(rloc, ''), loc, '') WHEN act = 'out' THEN '' ELSE loc END,
      CASE WHEN act IN ('take', 'in') OR act = 'up' AND (rname <> name OR rday <> day OR rloc <> '' AND rloc <> loc) THEN 'Rules' WHEN act IN ('hold', 'out') THEN '' ELSE by_ END,
      CASE WHEN act = 'take' THEN 'before' WHEN act = 'out' THEN NULL WHEN act IN ('in', 'hold') THEN coalesce(since, 'now') ELSE since END, CASE WHEN act = 'hold' THEN rwhy WHEN act IN ('in', 'out', 'take') THEN '' ELSE why END,
      CASE WHEN act = 'hold' AND at_ = 'review' AND NOT changed THEN note WHEN act IN ('hold', 'in', 'out', 'take') THEN '' ELSE note END, CASE WHEN act IN ('none') THEN seen ELSE 'now' END,
      out OR act = 'out', CASE WHEN act = 'out' THEN rname ELSE oname END, CASE WHEN act = 'out' THEN rday ELSE oday END, CASE WHEN act = 'out' THEN coalesce(nullif(rloc, ''), loc, '') ELSE oloc END, CASE WHEN act = 'out' THEN rwhy ELSE owhy END,
      CASE WHEN act = 'take' THEN other ELSE gone END
    FROM (SELECT f.*, r.name AS rname, r.day AS rday, r.loc AS rloc, r.why AS rwhy, r.changed, r.mloc, r.other, CASE WHEN s = 'past' THEN CASE WHEN at_ = 'verified' THEN 'see' ELSE 'none' END WHEN r.locked THEN 'none'
        WHEN s = 'verified' AND at_ = 'verified' THEN CASE WHEN r.changed THEN 'up' ELSE 'see' END WHEN s = 'verified' AND at_ = 'review' THEN 'in' WHEN s = 'verified' AND taking THEN 'take'
        WHEN s = 'verified' AND (other IS NOT NULL OR earlier) THEN 'none' WHEN s = 'verified' THEN 'in' WHEN s = 'needs_review' AND at_ = 'verified' THEN 'see' WHEN s = 'needs_review' THEN 'hold' ELSE 'out' END AS act
      FROM f JOIN r ON r.id = f.id AND r.i = f.i + 1)),
  e AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY id ORDER BY i DESC) = 1),
  g AS (SELECT DISTINCT gone FROM f WHERE gone <> '')"""


@query(
    _FOLDED
    + """ SELECT id AS event_id, at_ AS bucket, name AS event_name, day AS date, loc AS location, by_ AS verified_by, since AS added_on, seen AS last_seen, why AS review_reason, note AS ai_review, '' AS reject_reason FROM e WHERE at_ <> 'none'
    UNION ALL SELECT id, 'rejected', oname, oday, oloc, '', 'now', 'now', '', '', owhy FROM e WHERE out
    UNION ALL SELECT id, bucket, name, day, loc, CASE WHEN bucket = 'verified' THEN by_ ELSE '' END, 'before', 'before', '', CASE WHEN bucket = 'review' THEN 'note' ELSE '' END, '' FROM m WHERE id NOT IN (SELECT id FROM rec) AND id NOT IN (SELECT gone FROM g)"""
)
def master_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master after a run whose records are all events, many for each user, told apart only by their order."""
    c, k, i = F.col, F.col("user_id"), F.col("event_id")
    e = table(spark, sf_dir, "events")
    status = F.when(c("event_type") == "error", "rejected").when(c("event_type") == "signup", "needs_review").when(c("event_type") == "purchase", "past").otherwise("verified")
    name = _text("Event ", k % 40).alias("event_name")
    records = e.select(
        i.alias("ord"), _text("ev_", k).alias("event_id"), status.alias("status"), (i % 4 != 0).alias("changed"), name, _text("day ", i % 400).alias("date"), F.when(i % 3 == 0, "").otherwise(c("props")).alias("location"), _text("seen ", i).alias("reason"),
    )
    users = e.select(k).distinct()
    review = k % 3 == 0
    rest = [F.lit("before").alias("added_on"), F.lit("before").alias("last_seen")]
    said = lambda r: [F.lit("").alias("review_reason"), F.when(r, "note").otherwise("").alias("ai_review"), F.lit("").alias("reject_reason")]
    own = users.where(k % 3 < 2).select(
        _text("ev_", k).alias("event_id"), F.when(review, "review").otherwise("verified").alias("bucket"), name, _text("day ", k % 400).alias("date"), _text("at ", k).alias("location"),
        F.when(review, "").when(k % 7 == 1, "Legacy").otherwise("Rules").alias("verified_by"), F.when((k % 9 == 1) & ~review, "Yes").otherwise("").alias("locked"), *rest, *said(review),
    )
    old = users.where(k % 2 == 0).select(
        _text("ev_x", k).alias("event_id"), F.lit("verified").alias("bucket"), name, _text("day ", k * 7 % 400).alias("date"), _text("at ", k).alias("location"), F.lit("Legacy").alias("verified_by"), F.lit("").alias("locked"), *rest, *said(F.lit(False)),
    )
    return master.apply(records, own.unionByName(old), F.lit("now")).drop("locked")
