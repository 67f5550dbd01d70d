"""What an outside model answers, held to a schema: which events are relevant, and which events a page's text names.

Questions go out by review.ask (tries, pauses, errors as data); an answer is JSON text that from_json reads, with what doesn't fit in a column of its own. An answer in doubt decides nothing: rows stay, and a page
without a readable answer has no events and says why. The wording of questions is a parameter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import extract, text
from . import review, shared

GROUP = 60
RELEVANCE = "results array<boolean>, _odd string"
EVENTS = "events array<struct<event_name: string, date: string, format: string, location_city: string, description: string, link: string>>, _odd string"
FORMATS = ("In Person", "Virtual", "Hybrid")
ASK_RELEVANCE = "For each numbered event, say whether its own subject is tax, finance or law. Answer with the JSON object {\"results\": [true or false for each event, in order]}.\n\n"
ASK_EVENTS = "List all events, past ones too, that the page text below names, as the JSON object {\"events\": [{event_name, date as written, format, location_city, description, link}]}. Links stand in the text as [words](address).\n\n"


def numbered(i: Column, name: Column, organizer: Column, category: Column, location: Column) -> Column:
    """One event's line of a question."""
    place = F.when(text.blank(location) != "", F.concat(F.lit("location: "), location))
    return F.concat_ws(" | ", F.concat(i.cast("string"), F.lit('. "'), F.coalesce(name, F.lit("")), F.lit('"')), F.concat(F.lit("host: "), F.coalesce(organizer, F.lit(""))), F.concat(F.lit("tag: "), F.coalesce(category, F.lit(""))), place)


def read(answer: Column, schema: str) -> Column:
    """An answer by a schema; _odd holds one that isn't of it."""
    return F.from_json(answer, schema, {"columnNameOfCorruptRecord": "_odd", "mode": "PERMISSIVE"})


def relevant(rows: DataFrame, call: Callable[[str], dict], *, size: int = GROUP, header: str = ASK_RELEVANCE, **how: object) -> DataFrame:
    """rows (id, name, organizer, category, location) with keep and why: answered, or the reason for which a row stays without an answer of its own: error, unreadable, length, null.

    Rows are asked about in groups of size, in order of id; as many answers as rows or none of them count. Each question is asked once.
    """
    c = F.col
    grouped = review.batches(rows, "id", size)
    lines = F.array_sort(F.collect_list(F.struct("id", "name", "organizer", "category", "location")))  # size rows at most
    questions = grouped.groupBy("batch").agg(lines.alias("_rows")).withColumn("_line", F.transform("_rows", lambda r, i: numbered(i, r["name"], r["organizer"], r["category"], r["location"])))
    questions = shared.once(questions.select(c("batch").cast("string").alias("id"), F.concat(F.lit(header), F.array_join("_line", "\n")).alias("prompt"), F.transform("_rows", lambda r: r["id"]).alias("ids")), "questions")
    answers = shared.once(review.ask(questions.select("id", "prompt"), call, **how), "relevance")
    told = questions.drop("prompt").join(answers, "id").withColumn("_got", read(c("answer"), RELEVANCE))
    results = c("_got.results")
    wrong = F.when(c("error").isNotNull(), "error").when(c("_got").isNull() | c("_got._odd").isNotNull() | results.isNull(), "unreadable").when(F.size(results) != F.size("ids"), "length")
    each = told.select(F.posexplode("ids").alias("_i", "id"), wrong.alias("_wrong"), results.alias("_results"))
    said = F.when(c("_wrong").isNull(), F.get("_results", c("_i")))
    verdicts = each.select("id", F.coalesce(said, F.lit(True)).alias("keep"), F.coalesce("_wrong", F.when(said.isNull(), "null"), F.lit("answered")).alias("why"))
    return rows.join(verdicts, "id")


def events_of_pages(pages: DataFrame, call: Callable[[str], dict], *, header: str = ASK_EVENTS, most: int = 40_000, **how: object) -> DataFrame:
    """source_url, organizer, part, event_name, date, format, location, description, link, problem of pages (url, organizer, html), each asked about in parts of at most so many characters.

    Equal texts of a page are asked about once. An event without a name isn't one; a format that isn't of FORMATS is blank; a link that doesn't stand on the page is the page's own address. A part whose answer failed or
    can't be read is a row without a name, with the problem.
    """
    c = F.col

    @F.udf("array<string>")
    def parts_of(html: str | None, url: str | None) -> list[str]:
        return extract.chunks(extract.linked_text(html, url or ""), most)

    asked = pages.select("url", "organizer", F.posexplode(parts_of("html", "url")).alias("part", "_text")).where("trim(_text) <> ''")
    asked = asked.groupBy("url", "organizer", "_text").agg(F.min("part").alias("part"))
    key = F.sha2(F.concat_ws("\x1f", c("url"), c("part").cast("string")), 256)
    about = F.concat(F.lit(header), F.lit("Page: "), F.coalesce("url", F.lit("")), F.lit("\nOrganisation: "), F.coalesce("organizer", F.lit("unknown")), F.lit("\n\n"), c("_text"))
    asked = shared.once(asked.withColumns({"id": key, "prompt": about}), "page-questions")
    answers = shared.once(review.ask(asked.select("id", "prompt"), call, **how), "page-answers")
    told = asked.join(answers, "id").withColumn("_got", read(c("answer"), EVENTS))
    odd = c("_got").isNull() | c("_got._odd").isNotNull() | c("_got.events").isNull()
    problem = F.when(c("error").isNotNull(), c("error")).when(odd, "unreadable")
    none = F.array(F.lit(None).cast("struct<event_name: string, date: string, format: string, location_city: string, description: string, link: string>"))
    named = F.filter("_got.events", lambda e: text.blank(e["event_name"]) != "")
    rows = told.select("url", "organizer", "part", "_text", problem.alias("problem"), F.explode(F.when(problem.isNotNull(), none).otherwise(named)).alias("e"))
    link = text.blank(c("e.link"))
    there = (link != "") & F.contains(c("_text"), F.concat(F.lit("]("), link, F.lit(")")))
    return rows.select(
        c("url").alias("source_url"), "organizer", "part", c("e.event_name").alias("event_name"), text.blank(c("e.date")).alias("date"), F.when(c("e.format").isin(*FORMATS), c("e.format")).otherwise("").alias("format"),
        text.blank(c("e.location_city")).alias("location"), text.blank(c("e.description")).alias("description"), F.when(there, link).otherwise(c("url")).alias("link"), "problem",
    )
