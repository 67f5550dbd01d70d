"""What an outside reviewer's answers do. An answer is only believed where the page proves it; doubt leaves a row where it is."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text, titles
from . import merge, report

PARTS = ("name", "date", "location", "format")


def candidates(review: DataFrame, *, again: bool = False) -> DataFrame:
    """Rows of the review bucket to ask about: with a link, not locked, not reviewed yet (or skipped last time)."""
    done = text.blank(F.col("ai_review"))
    return review.where((F.lit(again) | (done == "") | done.startswith("skipped")) & (text.blank(F.col("link")) != "") & ~text.truthy(F.col("locked")))


def _proved(value: Column, quote: Column, reason: str) -> Column:
    return text.evidence(value, quote, reason, "ai_review")


def evaluate(answers: DataFrame, today: dt.date) -> DataFrame:
    """Answers (event_id, page, decision, category, and for each of PARTS <part>_value and <part>_quote) with fields, problems and outcome: verified, reject or unclear.

    A quote that isn't on the page counts for nothing; the date is read from its quote; a title must itself be on the page; an accepted event must pass all checks. One that has passed already is a rejection,
    and a rejection for want of information is none.
    """
    c = F.col
    quote = lambda p: F.when(text.squeeze(c(f"{p}_quote")) != "", text.squeeze(c(f"{p}_quote")))
    there = lambda p: text.on_page(quote(p), c("page"))
    given = lambda p: F.when(text.squeeze(c(f"{p}_value")) != "", text.squeeze(c(f"{p}_value"))).otherwise(quote(p))
    rows = answers.withColumn("_d", dates.strict(F.when(there("date"), quote("date")), today))
    mode = titles.mode_from_text(quote("format"))
    rows = rows.withColumns(
        {
            "name": _proved(F.when(there("name") & text.on_page(given("name"), c("page")), given("name")), given("name"), "Title confirmed on the page"),
            "date": _proved(dates.display(c("_d.start")), quote("date"), "Date read from a quote of the page"),
            "end_date": _proved(F.when(c("_d.end") != c("_d.start"), dates.display(c("_d.end"))), quote("date"), "End date read from a quote of the page"),
            "location": _proved(F.when(there("location"), given("location")), quote("location"), "Venue confirmed on the page"),
            "format": _proved(F.when(there("format") & (mode != ""), mode), quote("format"), "Format read from a quote of the page"),
        }
    )
    rows = rows.withColumn("failed", report.failures(today))
    missing = [F.when(quote(p).isNotNull() & ~there(p), F.lit(f"quote_{p}")) for p in PARTS]
    late = F.array_contains("failed", "past_date")
    accepts = c("decision") == "verified"
    outcome = (
        F.when(accepts & (F.size("failed") == 0), "verified")
        .when(accepts & late, "reject")
        .when((c("decision") == "reject") & (text.blank(c("reason")) != "") & ~titles.missing_info(c("reason")), "reject")
        .otherwise("unclear")
    )
    said = F.concat_ws(",", *missing, F.when(accepts, F.array_join("failed", ",")))
    return rows.withColumns({"problems": said, "outcome": outcome}).drop("_d", "failed")


def settle(master: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The master after outcomes (event_id, outcome, reason, and new cells): promoted rows keep added_on and take non-blank cells, rejected ones a reason, the rest a note."""
    cells = [x for x in outcomes.columns if x not in ("event_id", "outcome", "reason") and x in master.columns]
    o = outcomes.select(F.col("event_id").alias("_id"), "outcome", "reason", *[F.col(x).alias(f"_{x}") for x in cells])
    joined = master.join(o, (F.col("event_id") == F.col("_id")) & (F.col("bucket") == "review"), "left")
    up, out = F.coalesce(F.col("outcome") == "verified", F.lit(False)), F.coalesce(F.col("outcome") == "reject", F.lit(False))
    new = {x: F.when(up, merge.overlay(F.col(x), F.col(f"_{x}"))).otherwise(F.col(x)) for x in cells}
    new |= {
        "bucket": F.when(up, "verified").when(out, "rejected").otherwise(F.col("bucket")),
        "verified_by": F.when(up, "AI review").otherwise(F.col("verified_by")),
        "review_reason": F.when(~up, F.col("review_reason")),
        "ai_review": F.when(F.col("outcome") == "unclear", F.col("reason")).when(~up, F.col("ai_review")),
        "reject_reason": F.when(out, F.col("reason")).otherwise(F.col("reject_reason")),
    }
    return joined.select(*[(new[x] if x in new else F.col(x)).alias(x) for x in master.columns])


def resolve(rows: DataFrame, verdicts: DataFrame, today: dt.date) -> DataFrame:
    """Rows in review (ord) with fate: promote with the corrected date, drop what is past, keep what is unclear or contradicts itself."""
    v = verdicts.select(F.col("ord").alias("_o"), "verdict", dates.from_display(F.col("corrected")).alias("_c"))
    fate = F.when((F.col("verdict") == "upcoming") & (F.col("_c") >= F.lit(today)), "promote").when(F.col("verdict") == "past", "drop").otherwise("keep")
    out = rows.join(v, F.col("ord") == F.col("_o"), "left").withColumn("fate", fate)
    return out.withColumn("date", F.when(F.col("fate") == "promote", dates.display(F.col("_c"))).otherwise(F.col("date"))).drop("_o", "_c", "verdict")
