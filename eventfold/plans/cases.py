"""Queries whose inputs are stated cases, dealt to the rows of a table by their keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, taxonomy, text, titles
from .registry import cases_sql, pick, query, table

TODAY = dt.date(2026, 9, 24)

JUNK = [
    ("  Register NOW ", True), ("Tax Summit 2026", False), ("12345", True), (None, True), ("", True), ("Please check eligibility first", True),
    ("Masterclass", True), ("Masterclass on VAT", False), ("read more »", True), ("Login with email", True), ("2026 outlook", False),
]


@query(cases_sql("part", "p_partkey", ["name", "junk"], JUNK))
def junk_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), pick([x[0] for x in JUNK], "p_partkey").alias("name"))
    return rows.withColumn("junk", titles.junk_title(F.col("name")))


RELEVANT = [
    ("Tax", "x", "y", True), ("Sports", "Tax day", "", False), ("", "Banking forum", "", True), ("", "Garden party", "about law", True),
    (None, "Garden party", None, False), ("Legal / Tax", "", "", True), ("Arts", "", "insurance", False), (" ", "CPA update", "", True),
]


@query(cases_sql("part", "p_partkey", ["category", "name", "description", "relevant"], RELEVANT))
def keyword_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["category", "name", "description"]
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), *[pick([x[i] for x in RELEVANT], "p_partkey").alias(n) for i, n in enumerate(names)])
    return rows.withColumn("relevant", titles.relevant(*[F.col(n) for n in names]))


TOPICS = [
    ("International Tax Conference", "", "Tax"), ("Transfer Pricing Masterclass", "", "Tax"), ("Insolvency and restructuring forum", "", "Legal"),
    ("Private Equity Summit", "", "Finance"), ("Taxonomy of plants", "", "Unclear"), ("Lawn care day", "", "Unclear"), ("Golf day", "tax", "Reject"),
    ("Annual General Meeting", "", "Reject"), ("Pass your tax exam", "", "Reject"), ("Risk and policy", "governance and sustainability", "Unclear"),
    ("Networking", "a talk on arbitration, mediation and litigation", "Legal"), ("Tax and law", "", "Tax"), ("M & A outlook", "mergers and acquisitions", "Unclear"),
    ("Cross border tax", "", "Tax"), ("Cross-border taxes", "", "Tax"), ("Arbitrators meet", "", "Legal"), ("Alumni evening", "finance", "Reject"), (None, None, "Unclear"),
]


@query(cases_sql("part", "p_partkey", ["title", "description", "category"], TOPICS))
def taxonomy_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), pick([x[0] for x in TOPICS], "p_partkey").alias("title"), pick([x[1] for x in TOPICS], "p_partkey").alias("description"))
    return rows.withColumn("category", taxonomy.category(F.col("title"), F.col("description")))


#: Put after the texts, which say little of these fields themselves.
ADDED = ["", "a tax treaty and transfer pricing", "arbitration or data-privacy", "capital markets and banks", "taxonomy"]


def _bounded(body: str) -> str:
    """A phrase's pattern for an engine without looking around: what stands beside it is part of the match."""
    return body.replace("(?<![A-Za-z0-9])", "(?:^|[^A-Za-z0-9])").replace("(?![A-Za-z0-9])", "(?:$|[^A-Za-z0-9])").replace("'", "''")


def _topic_sql() -> str:
    parts = [f"('{r.category}', {i}, '(?i){_bounded(taxonomy.pattern(r.phrase))}')" for i, r in enumerate(taxonomy.load()) if not r.weak]
    return (
        f"WITH p(category, i, rx) AS (VALUES {', '.join(parts)}), h AS (SELECT doc_id, category FROM documents, p WHERE regexp_matches(coalesce(text, '') || ' ' || [{', '.join(f"'{a}'" for a in ADDED)}][1 + doc_id % {len(ADDED)}], rx)) "
        "SELECT category, count(*) AS hits, count(DISTINCT doc_id) AS docs FROM h GROUP BY category"
    )


@query(_topic_sql())
def taxonomy_on_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases found in whole texts, by category."""
    docs = table(spark, sf_dir, "documents").withColumn("text", F.concat_ws(" ", F.coalesce("text", F.lit("")), pick(ADDED, "doc_id")))
    hits = docs.select("doc_id", F.explode(taxonomy.hits(F.lit(""), F.col("text"))).alias("h")).where("not h.weak").select("doc_id", "h.category")
    by_doc = hits.groupBy("category", "doc_id").agg(F.count("*").alias("n"))
    return by_doc.groupBy("category").agg(F.sum("n").cast("long").alias("hits"), F.count("*").alias("docs"))


N_PHRASES, LONGEST = 600, 4


def benchmark_taxonomy(spark: SparkSession, sf_dir: str) -> tuple[taxonomy.Entry, ...]:
    """Some 600 phrases of the benchmark's plain words: of item i the topic "Item i" of category i mod 3, phrases of 1 to LONGEST words that begin at its words in turn; every tenth is a weak word. The items are the stated part
    of the query, few and short; the texts are all documents."""
    items = table(spark, sf_dir, "benchmark").where("text is not null").orderBy("item_id").select("item_id", F.expr("filter(split(lower(text), '[^a-z]+'), x -> length(x) > 2)").alias("words"))
    own = [(r["item_id"], r["words"]) for r in items.limit(N_PHRASES).collect()]
    each = -(-N_PHRASES // max(len(own), 1))
    raw: dict = {c: {"topics": {}, "weak": []} for c in ("Tax", "Legal", "Finance")}
    k = 0
    for i, words in own:
        block = raw[("Tax", "Legal", "Finance")[i % 3]]
        for n in range(min(each, max(len(words) - LONGEST, 0))):
            if k % 10 == 9:
                block["weak"].append(" ".join(words[n : n + 2]))
            else:
                block["topics"].setdefault(f"Item {i}", []).append(" ".join(words[n : n + 1 + k % LONGEST]))
            k += 1
    return taxonomy.entries(raw)


#: The same phrases, each looked for in each document by its own pattern.
REASONS_SQL = f"""WITH items AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: len(x) > 2) AS ws FROM benchmark WHERE text IS NOT NULL ORDER BY item_id LIMIT {N_PHRASES}),
  e AS (SELECT item_id, ws, unnest(range(0, greatest(least(CAST(ceil({N_PHRASES} / (SELECT count(*) FROM items)) AS BIGINT), len(ws) - {LONGEST}), 0))) AS n FROM items),
  k AS (SELECT *, row_number() OVER (ORDER BY item_id, n) - 1 AS k FROM e),
  ph AS (SELECT k, item_id, k % 10 = 9 AS weak, array_to_string(ws[n + 1:n + CASE WHEN k % 10 = 9 THEN 2 ELSE 1 + k % {LONGEST} END], ' ') AS phrase FROM k),
  own AS (SELECT item_id AS item, weak, 'Item ' || item_id AS topic, phrase, min(k) AS k FROM ph WHERE NOT weak GROUP BY item_id, weak, phrase UNION ALL SELECT item_id, true, 'generic word', phrase, k FROM ph WHERE weak
    UNION ALL SELECT item_id, false, 'Item ' || item_id, 'item ' || item_id, -1 FROM ph WHERE NOT weak GROUP BY item_id),
  p AS (SELECT *, item % 3 AS c, row_number() OVER (ORDER BY item % 3, weak, CASE WHEN weak THEN 0 ELSE item END, k) AS nth, '(?i)(?:^|[^A-Za-z0-9])(' || replace(regexp_replace(phrase, '\\band\\b', '(?:&|and)', 'g'), ' ', '[\\s\\-]+') || '(?:s|es)?)(?:$|[^A-Za-z0-9])' AS rx FROM own),
  d AS (SELECT doc_id, split_part(coalesce(text, ''), '.', 1) AS title, coalesce(text, '') AS body FROM documents),
  x AS (SELECT doc_id, c, weak, topic, nth, regexp_extract(title, rx, 1) AS t, regexp_extract(body, rx, 1) AS b FROM d, p
    WHERE contains(lower(body), CASE WHEN phrase LIKE 'and %' THEN split_part(phrase, ' ', 2) WHEN phrase = 'and' THEN '' ELSE split_part(phrase, ' ', 1) END)),
  h AS (SELECT doc_id, c, weak, topic, nth, t <> '' AS in_title, lower(trim(CASE WHEN t <> '' THEN t ELSE b END)) AS said FROM x WHERE t <> '' OR b <> ''),
  s AS (SELECT doc_id, c, sum(CASE WHEN weak AND in_title THEN 1.0 WHEN weak THEN 0.5 WHEN in_title THEN 3.0 ELSE 1.0 END) AS total, bool_or(NOT weak) AS strong, arg_min(topic, nth) FILTER (NOT weak) AS topic FROM h GROUP BY 1, 2),
  u AS (SELECT doc_id, c, topic || ' (''' || said || ''')' AS told, min(nth) AS nth FROM h GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY doc_id, c ORDER BY min(nth)) <= 4),
  g AS (SELECT doc_id, c, string_agg(told, '; ' ORDER BY nth) AS shown FROM u GROUP BY 1, 2),
  z AS (SELECT doc_id, c, CASE WHEN strong THEN total ELSE least(total, 2.5) END AS score, topic, shown, ['Tax', 'Legal', 'Finance'][c + 1] AS name FROM s JOIN g USING (doc_id, c)),
  t AS (SELECT doc_id, max(score) AS top FROM z GROUP BY 1),
  b AS (SELECT z.doc_id, top, arg_min(name, c) AS name, arg_min(topic, c) AS topic, arg_min(shown, c) AS shown, string_agg(name, ' and ' ORDER BY c) AS tied, count(*) AS n FROM z JOIN t ON z.doc_id = t.doc_id AND z.score = t.top GROUP BY 1, 2)
SELECT d.doc_id, CASE WHEN coalesce(top, 0) < 3 THEN 'Unclear' ELSE name END AS category, CASE WHEN coalesce(top, 0) < 3 THEN '' ELSE topic END AS topic,
  CASE WHEN coalesce(top, 0) = 0 THEN 'no Tax, Finance or Legal topic found in the event''s title or description' WHEN top < 3 THEN 'only a generic word or a single passing mention (' || shown || ') -- not enough to accept on rules alone'
  ELSE name || ' topic in the event''s own text: ' || shown || CASE WHEN n > 1 THEN ' (also matches ' || substr(tied, len(name) + 6) || '; ' || name || ' chosen by fixed order)' ELSE '' END END AS reason FROM d LEFT JOIN b USING (doc_id)"""


@query(REASONS_SQL)
def taxonomy_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category, topic and reason of all documents by 600 phrases; their first sentence is the title."""
    body = F.coalesce("text", F.lit(""))
    told = taxonomy.judged(taxonomy.hits(F.substring_index(body, ".", 1), body, benchmark_taxonomy(spark, sf_dir)))
    return table(spark, sf_dir, "documents").select("doc_id", told.alias("x")).select("doc_id", "x.category", "x.topic", "x.reason")


PLACES = [
    ("Mumbai, India", "India", False), ("Indianapolis, IN", "USA", False), ("Dublin, OH", "USA", False), ("Dublin, Ireland", None, True),
    ("London and Dubai", None, False), ("Singapore", "SG", False), ("Perth WA", "AUS", False), ("Hong Kong", None, True), (None, None, False),
    ("", None, False), ("New Delhi", "India", False), ("United Arab Emirates", "UAE", False), ("Ukraine", None, False), ("Paris, TX", "USA", True),
]


@query(cases_sql("customer", "c_custkey", ["location", "country", "untracked"], PLACES))
def country_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), pick([x[0] for x in PLACES], "c_custkey").alias("location"))
    return rows.withColumns({"country": titles.country_of(F.col("location")), "untracked": titles.untracked(F.col("location"))})


MODES = [
    ("A hybrid meeting on Zoom", "Hybrid", "Virtual", "https://schema.org/MixedEventAttendanceMode", False, "Hybrid"),
    ("Join by Webex", "Virtual", "", "https://schema.org/OnlineEventAttendanceMode", False, "Virtual"),
    ("In-person only", "In Person", "In Person", "OfflineEventAttendanceMode", True, "In Person"),
    ("offline venue", "In Person", "", "", True, "Virtual"),
    ("nothing said", "", "", None, False, ""),
    ("Web conference", "", "Virtual", "x/y", False, ""),
]


@query(cases_sql("customer", "c_custkey", ["said", "mode", "format", "uri", "virtual", "by_uri"], MODES))
def format_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "c_custkey"
    rows = table(spark, sf_dir, "customer").select(F.col(k).alias("id"), pick([x[0] for x in MODES], k).alias("said"), pick([x[3] for x in MODES], k).alias("uri"), pick([x[4] for x in MODES], k).alias("virtual"))
    c = F.col
    return rows.select("id", "said", titles.mode_from_text(c("said")).alias("mode"), titles.format_from_text(c("said")).alias("format"), "uri", "virtual", titles.format_from_mode(c("uri"), c("virtual")).alias("by_uri"))


PAST_YEARS = [
    ("The programme was held from December 1 to 9 2023", 2023), ("was held in 2030", None), ("Our 2024 review", 2024), ("From 2022 to 2024", None),
    ("a plan for 2040", None), ("took place on 5 May 2021, again in 2022", 2021), ("no year", None), (None, None), ("concluded on 3 June 2019", 2019),
]


@query(cases_sql("orders", "o_orderkey", ["said", "year"], PAST_YEARS))
def stated_past_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), pick([x[0] for x in PAST_YEARS], "o_orderkey").alias("said"))
    return rows.withColumn("year", dates.past_year(F.col("said"), TODAY))


LINKS = [
    ("https://a.example/x", 200, "https://a.example/x", False), ("https://a.example/y", 404, "https://fall.example/", True),
    ("", None, "https://fall.example/", False), (None, None, "https://fall.example/", False), ("https://a.example/z", 500, "https://fall.example/", True),
]


@query(cases_sql("part", "p_partkey", ["link", "status", "final", "replaced"], LINKS))
def link_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A link that doesn't load (as a look-up says) or is blank gives way to the list's; only the former counts as replaced."""
    k = "p_partkey"
    rows = table(spark, sf_dir, "part").select(F.col(k).alias("id"), pick([x[0] for x in LINKS], k).alias("link"), pick([x[1] for x in LINKS], k).alias("status"))
    blank = text.blank(F.col("link")) == ""
    bad = ~blank & ~F.coalesce(F.col("status") < 400, F.lit(False))
    return rows.withColumns({"final": F.when(blank | bad, "https://fall.example/").otherwise(F.col("link")), "replaced": bad})


REVIEWS = [
    ("Tax Day", "tax  DAY", "reject", "The page does not state a date", True, "unclear"),
    ("Tax Day", "Law Day", "reject", "A wine tasting", False, "reject"),
    ("Tax Day", "", "accept", "Cookie notice", False, "accept"),
    ("Tax Day", "a tax day in may", "reject", None, True, "reject"),
]


@query(cases_sql("part", "p_partkey", ["quote", "page", "decision", "reason", "quoted", "outcome"], REVIEWS))
def review_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quote must be on the page; a rejection for want of information is none."""
    k, names = "p_partkey", ["quote", "page", "decision", "reason"]
    rows = table(spark, sf_dir, "part").select(F.col(k).alias("id"), *[pick([x[i] for x in REVIEWS], k).alias(n) for i, n in enumerate(names)])
    unclear = (F.col("decision") == "reject") & titles.missing_info(F.col("reason"))
    return rows.withColumns({"quoted": text.on_page(F.col("quote"), F.col("page")), "outcome": F.when(unclear, "unclear").otherwise(F.col("decision"))})


LENIENT = [
    ("12 Aug", "2027-08-12", None), ("12 Oct", "2026-10-12", None), ("1st to 18th September, 2026", "2026-09-01", "2026-09-18"),
    ("5-6 Sep 2026", "2026-09-05", "2026-09-06"), ("May 5-6, 2027", "2027-05-05", "2027-05-06"), ("24-07-2026 - 26-07-2026", "2026-07-24", "2026-07-26"),
    ("Bulletin of 1908", None, None), ("", None, None), (None, None, None), ("07/08/2026", "2026-07-08", None), ("20th July to 24th July 2026", "2026-07-20", "2026-07-24"),
    ("no date here", None, None), ("12 DAYS SERIES - 1st to 18th September, 2026", "2026-09-01", "2026-09-18"),
]


@query(cases_sql("orders", "o_orderkey", ["said", "first_day", "last_day"], LENIENT))
def lenient_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), pick([x[0] for x in LENIENT], "o_orderkey").alias("said"))
    d = dates.lenient(F.col("said"), TODAY)
    return rows.withColumn("d", d).select("id", "said", F.col("d.start").cast("string").alias("first_day"), F.col("d.end").cast("string").alias("last_day"))


