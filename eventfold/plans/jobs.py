"""Whole jobs made of the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, extract, taxonomy, text, titles
from ..operators import dedupe, merge, report
from ..sources import fetch, shared, sheets


def across_countries(rows: DataFrame) -> DataFrame:
    """Verified rows of all countries (ord, event_name, date, location, description, source_country) as one master: bucket verified or review.

    The place decides the country; a place in a country that isn't tracked, or a date that the text contradicts, goes to review; of the rest the fullest row of each name and date stays.
    """
    c = F.col
    said = F.concat_ws(" ", "event_name", "description")
    start = dates.from_display(c("date"))
    end = dates.from_display(c("end_date")) if "end_date" in rows.columns else F.lit(None).cast("date")
    doubt = (titles.untracked(c("location")) & titles.country_of(c("location")).isNull()) | F.coalesce(dates.conflicts(start, end, said), F.lit(False))
    told = rows.where(~titles.junk_title(c("event_name"))).withColumns({"country": titles.resolved_country(c("location"), c("source_country")), "_doubt": doubt})
    sure = dedupe.keep_fullest(told.where(~c("_doubt")), [merge.key("event_name"), merge.key("date")], ["ord"], ["event_name", "date", "location", "description"])
    return sure.withColumn("bucket", F.lit("verified")).unionByName(told.where("_doubt").withColumn("bucket", F.lit("review"))).drop("_doubt")


def clean(raw: DataFrame, today: dt.date) -> DataFrame:
    """Raw rows (ord, date, event_name, organizer, category, format, location, description, link, source_url) with resolved dates, one row for each name and date, and bucket."""
    c = F.col
    found = dates.lenient(text.blank(c("date")), today)
    by_title = dates.lenient(text.blank(c("event_name")), today)
    rows = raw.where(text.blank(c("event_name")) != "").withColumns({"_d": found, "_t": by_title})
    has_text = text.blank(c("date")) != ""
    start = F.when(has_text & dates.has_day(c("date")), c("_d.start")).when(~has_text & dates.has_day(c("event_name")), c("_t.start"))
    past = dates.past_year(F.concat_ws(" ", "event_name", "description"), today)
    moved = F.when(~dates.has_year(c("date")) & past.isNotNull(), dates.make_date(past, F.month(c("_s")), F.day(c("_s")))).otherwise(c("_s"))
    end = F.when(has_text, c("_d.end"))
    rows = rows.withColumn("_s", start).withColumn("day", moved).withColumn("end_day", F.when(end != c("day"), end))
    rows = rows.withColumns({"date": F.coalesce(dates.display(c("day")), F.lit("")), "end_date": F.coalesce(dates.display(c("end_day")), F.lit(""))}).drop("_d", "_t", "_s")
    one = dedupe.keep_fullest(rows, [merge.key("event_name"), merge.key("date")], ["ord"], [x for x in raw.columns if x != "ord"])
    return one.withColumn("bucket", report.bucket(c("event_name"), titles.relevant(c("category"), c("event_name"), c("description")), c("day"), c("end_day"), c("format"), c("location"), today))


#: What a row says; a fresh row that differs in none of these is unchanged.
SAID = ("end_date", "event_name", "organizer", "category", "format", "location", "description", "link", "source_url")


def refresh(raw: DataFrame, previous: DataFrame, today: dt.date) -> DataFrame:
    """A run after another: raw rows cleaned and held against the previous result (clean's columns and bucket); column fate tells what became of each row.

    What is new, changed, completed or reopened takes the bucket that clean gives it. An unchanged row is the previous one with its bucket, but an upcoming one whose day is over
    is past by now. A previous row that no fresh one used stays as it is.
    """
    c = F.col
    fresh = clean(raw, today)
    told = merge.difference(previous, fresh, SAID, with_used=True).select("ord", "used", "fate")
    cols = [x for x in fresh.columns if x in previous.columns]
    anew = fresh.join(told.where(~c("fate").isin("unchanged", "untouched")).select("ord", "fate"), "ord").select(*cols, "fate")
    carried = previous.join(told.where(c("fate").isin("unchanged", "untouched")).select(c("used").alias("ord"), "fate").dropDuplicates(["ord"]), "ord")
    over = (c("fate") == "unchanged") & (c("bucket") == "upcoming") & dates.is_past(dates.from_display(c("date")), today)
    return anew.unionByName(carried.withColumn("bucket", F.when(over, "past").otherwise(c("bucket"))).select(*cols, "fate"))


def judge(candidates: DataFrame, today: dt.date) -> DataFrame:
    """Candidates (fields as evidence structs, category or text to tell it from, page, conflicts) with category, failed checks and status."""
    c = F.col
    told = candidates.withColumn("category", taxonomy.category(c("name")["value"], c("description")["value"])).withColumn("failed", report.failures(today))
    past = report.record_past(dates.from_display(c("date")["value"]), c("end_date")["value"], dates.from_display(c("end_date")["value"]), today)
    return told.withColumn("status", report.status(c("category") == "Reject", past, c("conflicts"), c("failed")))


def from_lists(lists: DataFrame, details: DataFrame, state: DataFrame, today: dt.date) -> DataFrame:
    """Records of list pages (ord, url, organizer, country, html) and detail pages (url, html): fields merged, judged, with event ids, and unchanged ones as the state (event_id, fingerprint, record) holds them.

    A card whose link is its own page takes that page's fields too; one row for each event id of a country, the first.
    """
    c = F.col
    cards = lists.withColumn("_e", F.explode(extract.list_page(c("html"), c("url"), today))).select("ord", c("url").alias("source_url"), "organizer", c("country").alias("source_country"), c("_e.fields").alias("l"), c("_e.link").alias("card_link"), c("_e.card_text").alias("card_text"), c("_e.conflict").alias("card_conflict"))
    cards = report.own_page(cards, "card_link", "source_url")
    pages = details.select(c("url").alias("_url"), c("html").alias("_html")).dropDuplicates(["_url"])
    joined = cards.join(pages, c("own_page") & (c("card_link") == c("_url")), "left").withColumn("d", extract.detail_page(c("_html"), c("card_link"), c("organizer"), today)["fields"])
    has = c("_html").isNotNull()
    flat = joined.select("*", *[c(f"l.{x}").alias(f"l_{x}") for x in extract.COLUMNS], *[F.when(has, c(f"d.{x}")).alias(f"d_{x}") for x in extract.COLUMNS]).drop("l", "d")
    both = merge.merge_fields(flat.withColumn("page", F.concat_ws(" ", "card_text", extract.page_text(c("_html")))), extract.COLUMNS)
    told = judge(both.withColumn("conflicts", F.when(c("card_conflict") != "", F.array_append("conflicts", F.lit("card"))).otherwise(c("conflicts"))), today)
    value = lambda x: c(x)["value"]
    link = F.when(c("own_page"), c("card_link")).otherwise(F.lit(""))
    rows = told.select(
        "ord", text.event_id(c("organizer"), value("name"), link, c("source_url"), value("date")).alias("event_id"), "status", value("name").alias("event_name"), value("date").alias("date"), value("end_date").alias("end_date"),
        value("location").alias("location"), value("format").alias("format"), value("description").alias("description"), c("card_link").alias("register_link"), "source_url", "organizer", "category",
        titles.resolved_country(value("location"), c("source_country")).alias("country"), "failed", "conflicts", text.fingerprint(c("card_text"), c("page")).alias("fingerprint"),
    )
    one = dedupe.keep_first(rows, ["country", "event_id"], ["ord", "event_name"])
    held = state.select("event_id", c("fingerprint").alias("_f"), c("status").alias("_s"))
    same = F.coalesce(c("fingerprint") == c("_f"), F.lit(False))
    return one.join(held, "event_id", "left").withColumns({"status": F.when(same, c("_s")).otherwise(c("status")), "changed": ~same}).drop("_f", "_s")


#: Reasons of records that no page was read for.
UNREACHABLE, SHARED, NO_LINK = "unreachable", "shared_page", "no_link"


def _read(rows: DataFrame, pages: DataFrame, today: dt.date) -> DataFrame:
    """Rows (_url, organizer, source_country) with what their pages (url, html, status, error) say, judged."""
    c = F.col
    got = rows.join(pages.select(c("url").alias("_url"), c("html").alias("_html"), c("status").alias("_http"), c("error").alias("_error")), "_url", "left")
    d = got.withColumn("_d", extract.detail_page(c("_html"), c("_url"), c("organizer"), today))
    has = c("_html").isNotNull()
    flat = d.select(*got.columns, *[F.when(has, c(f"_d.fields.{x}")).alias(x) for x in extract.COLUMNS], c("_d.conflicts").alias("conflicts"), extract.page_text(c("_html")).alias("page"))
    return judge(flat, today).withColumn("status", F.when(has, c("status")).otherwise(UNREACHABLE))


def from_rows(raw: DataFrame, fetcher: Callable[[str], dict], state: DataFrame, country: str, today: dt.date, *, retries: int = 2, pause: float = 0.3) -> DataFrame:
    """Records of a country's raw rows (ord and any of sheets.RAW), each by its own page: event_id, status, fields, country, category, failed, conflicts, attempts, fingerprint, changed.

    A row whose link is the list or that shares its link is a shared page, one without a link needs review; neither is fetched. A page that couldn't be had, or whose row isn't verified, rejected or
    past, is asked for again, at most retries times (not after HTTP 404 and 410). An unchanged fingerprint keeps the state's record (event_id, fingerprint, status), as does a page that
    couldn't be had. Each round of fetching is written before it is used.
    """
    c = F.col
    rows = sheets.upcoming(raw).withColumn("source_country", F.lit(country))
    rows = report.own_page(rows, "link", "source_url").withColumn("event_id", text.event_id(c("organizer"), c("event_name"), F.when(c("own_page"), c("link")).otherwise(""), c("source_url"), F.lit("")))
    rows = shared.once(rows.withColumnRenamed("link", "_url"), "rows")
    own = dedupe.keep_first(rows.where("own_page"), ["event_id"], ["ord"])
    todo, done = own, []
    for attempt in range(retries + 1):
        pages = shared.once(fetch.many(todo, fetcher, url_col="_url", pause=pause), "pages")
        judged = shared.once(_read(todo, pages, today).withColumn("attempts", F.lit(attempt)), "judged")
        gone = F.coalesce(c("_http").isin(*fetch.FINAL), F.lit(False)) & (c("status") == UNREACHABLE)
        again = ~gone & c("status").isin(UNREACHABLE, "needs_review") if attempt < retries else F.lit(False)
        done.append(judged.where(~again))
        todo = judged.where(again).select(*own.columns)
        if attempt < retries and todo.isEmpty():
            break
    read = done[0]
    for d in done[1:]:
        read = read.unionByName(d)
    none = F.array().cast("array<string>")
    fields = [c(x)["value"].alias(x) for x in extract.COLUMNS]
    records = read.select("ord", "event_id", "status", "organizer", "source_url", c("_url").alias("page_url"), *fields, titles.resolved_country(c("location")["value"], c("source_country")).alias("country"), "category", F.when(c("status") == UNREACHABLE, F.array(F.lit(UNREACHABLE))).otherwise(c("failed")).alias("failed"), F.coalesce("conflicts", none).alias("conflicts"), "attempts", F.when(c("status") == UNREACHABLE, "").otherwise(text.fingerprint(c("page"))).alias("fingerprint"))
    without = rows.where(~c("own_page"))
    blank = c("_url") == ""
    rest = without.select(
        "ord", "event_id", F.when(blank, "needs_review").otherwise(SHARED).alias("status"), "organizer", "source_url", c("_url").alias("page_url"), *[F.lit(None).cast("string").alias(x) for x in extract.COLUMNS], c("source_country").alias("country"), F.lit("").alias("category"),
        F.array(F.when(blank, NO_LINK).otherwise(SHARED)).alias("failed"), none.alias("conflicts"), F.lit(0).alias("attempts"), F.lit("").alias("fingerprint"),
    )
    all_ = records.unionByName(rest).join(state.select("event_id", c("fingerprint").alias("_f"), c("status").alias("_s")), "event_id", "left")
    same = F.coalesce(c("_f").isNotNull() & (((c("fingerprint") == c("_f")) & (c("fingerprint") != "")) | (c("status") == UNREACHABLE)), F.lit(False))
    return all_.withColumns({"status": F.when(same, c("_s")).otherwise(c("status")), "changed": ~same}).drop("_f", "_s")
