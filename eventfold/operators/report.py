"""Buckets, health, verification and statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, fixed, text, titles
from ..sources import shared

ACCEPTED = ("Tax", "Finance", "Legal")
YEARS_AHEAD = 3
GRACE_DAYS = 14
DROP_RATIO, DROP_FROM = 0.5, 6


def bucket(name: Column, is_relevant: Column, day: Column, end: Column, format_: Column, location: Column, today: dt.date) -> Column:
    """flagged, incomplete, past or upcoming, in this order."""
    no_venue = (F.lower(F.coalesce(format_, F.lit(""))) == "in person") & (text.blank(location) == "")
    return (
        F.when(~is_relevant | titles.junk_title(name), "flagged")
        .when(day.isNull() | no_venue, "incomplete")
        .when(dates.is_past(day, today), "past")
        .otherwise("upcoming")
    )


def record_past(start: Column, end_text: Column, end: Column, today: dt.date) -> Column:
    """By the end if one is stated, parsed or not, else by the start."""
    return F.when(text.blank(end_text) != "", dates.is_past(end, today)).otherwise(dates.is_past(start, today))


def health(current: DataFrame, previous: DataFrame) -> DataFrame:
    """source_url, organizer, events, before and status of each site of this run."""
    p = previous.select("source_url", F.col("events").alias("_before"))
    joined = current.join(p, "source_url", "left").withColumn("before", F.coalesce("_before", F.lit(0)))
    status = (
        F.when(F.coalesce(F.col("error"), F.lit("")) != "", "failed")
        .when((F.col("events") == 0) & (F.col("before") > 0), "empty")
        .when((F.col("before") >= DROP_FROM) & (F.col("events") < F.col("before") * DROP_RATIO), "big_drop")
        .otherwise("ok")
    )
    return joined.select("source_url", "organizer", "events", "before", status.alias("status"))


def missing_and_past(verified: DataFrame, seen: DataFrame, sites: DataFrame, today: dt.date) -> DataFrame:
    """verified with outcome kept, past or missing. Past is by the last day. Missing is what a healthy site no longer shows, has a page of its own that no other row shares, and was
    last seen more than GRACE_DAYS ago. Locked rows are kept."""
    rows = verified.join(seen.select("event_id", F.lit(True).alias("_seen")).distinct(), "event_id", "left")
    rows = rows.join(sites.where("status = 'ok'").select("source_url", F.lit(True).alias("_ok")).distinct(), "source_url", "left")
    over = dates.is_past(F.coalesce("end_date", "start_date"), today)
    unseen = F.col("_seen").isNull() & F.coalesce(F.col("_ok"), F.lit(False)) & F.coalesce(F.datediff(F.lit(today), "last_seen") > GRACE_DAYS, F.lit(False))
    # all links are counted, but only those of rows that may be missing are looked up
    page = text.normalize_url(F.col("link"))
    rows = times(rows.withColumn("_link", F.when(unseen & ~over & ~text.truthy(F.col("locked")), page).otherwise("")), "_link", "_n", verified.select(page.alias("_link")))
    gone = unseen & (F.col("_n") == 1) & (F.col("_link") != text.normalize_url(F.col("source_url")))
    return rows.withColumn("outcome", F.when(text.truthy(F.col("locked")), "kept").when(over, "past").when(gone, "missing").otherwise("kept")).select(*verified.columns, "outcome")


def times(df: DataFrame, key: str, out: str, of: DataFrame | None = None) -> DataFrame:
    """df with the number of rows (of df or of a table that has the key too) that share its key, 0 for a blank one. Counted by an aggregate of keys alone; rows with a blank key meet nothing, so they spread over all tasks."""
    counts = (df if of is None else of).where(F.col(key) != "").groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_times"))
    spread = F.when(F.col(key) != "", F.col(key)).otherwise(F.concat(F.lit("\x00"), F.monotonically_increasing_id().cast("string")))
    return df.withColumn("_spread", spread).join(counts, F.col("_spread") == F.col("_key"), "left").withColumn(out, F.coalesce("_times", F.lit(0))).drop("_spread", "_key", "_times")


def own_page(df: DataFrame, link: str, source: str) -> DataFrame:
    """own_page: a link other than the list's page that no other row has and that isn't a search engine's."""
    own = (F.col("_l") != "") & (F.col("_l") != text.normalize_url(F.col(source))) & ~text.host(F.col(link)).rlike(r"google\.com$") & (F.col("_n") == 1)
    return times(df.withColumn("_l", text.normalize_url(F.col(link))), "_l", "_n").withColumn("own_page", own).select(*df.columns, "own_page")


def failures(today: dt.date, *, name: str = "name", day: str = "date", end: str = "end_date", location: str = "location", category: str = "category", page: str = "page", proofs: tuple[str, ...] = ("name", "date", "end_date", "location", "format")) -> Column:
    """The codes of all checks that a record of evidence fails; an empty array has passed.

    Codes: no_title, generic_title, weak_title, unproved_<column>, no_date, bad_date, past_date, far_date, weak_date, title_date, untracked, category.
    """
    value = lambda c: F.col(c)["value"]
    weak = lambda c: F.col(c).isNotNull() & (F.col(c)["confidence"] != "high")
    start, last = dates.from_display(value(day)), dates.from_display(value(end))
    has_day = F.col(day).isNotNull()
    checks: list[tuple[Column, str]] = [
        (F.col(name).isNull(), "no_title"),
        (F.col(name).isNotNull() & titles.junk_title(value(name)), "generic_title"),
        (weak(name), "weak_title"),
        *[(F.col(c).isNotNull() & ~text.on_page(F.col(c)["match"], F.col(page)), f"unproved_{c}") for c in proofs],
        (~has_day, "no_date"),
        (has_day & start.isNull(), "bad_date"),
        (start < F.lit(today), "past_date"),
        ((start >= F.lit(today)) & (F.year(start) > today.year + YEARS_AHEAD), "far_date"),
        (weak(day), "weak_date"),
        (start.isNotNull() & F.col(name).isNotNull() & dates.conflicts(start, last, value(name)), "title_date"),
        (F.col(location).isNotNull() & titles.untracked(value(location)) & titles.country_of(value(location)).isNull(), "untracked"),
        (~F.coalesce(F.col(category).isin(*ACCEPTED), F.lit(False)), "category"),
    ]
    said = F.concat_ws(",", *[F.when(F.coalesce(c, F.lit(False)), F.lit(code)) for c, code in checks])
    return F.array_remove(F.split(said, ","), "")


def messages(codes: Column, proofs: tuple[str, ...] = ("name", "date", "end_date", "location", "format")) -> Column:
    """What failures' codes say in words, about the evidence columns of the row."""
    about = {"no_title": "name", "generic_title": "name", "weak_title": "name", "untracked": "location"}

    def told(template: str, column: str) -> Column:
        filled = F.lit(template.replace("{column}", column))
        for part in ("value", "source", "confidence"):
            if "{" + part + "}" in template:
                filled = F.replace(filled, F.lit("{" + part + "}"), F.coalesce(F.col(column)[part], F.lit("")))
        return filled

    texts = {code: told(t, about.get(code, "date")) for code, t in fixed.MESSAGES.items() if code != "unproved"}
    texts |= {f"unproved_{c}": told(fixed.MESSAGES["unproved"], c) for c in proofs}
    known = F.create_map(*[x for code, t in texts.items() for x in (F.lit(code), t)])
    return F.transform(codes, lambda c: F.element_at(known, c))


def status(rejected: Column, past: Column, conflicts: Column, failed: Column) -> Column:
    """rejected before past (if nothing conflicts) before needs_review before verified."""
    return F.when(rejected, "rejected").when(past & (F.size(conflicts) == 0), "past").when((F.size(failed) > 0) | (F.size(conflicts) > 0), "needs_review").otherwise("verified")


def per_organizer(df: DataFrame, organizer: str, past: Column, order: str) -> DataFrame:
    """upcoming, past, total of each organizer, most first, then in order of appearance."""
    n = lambda c: F.sum(c.cast("int")).cast("long")
    return df.groupBy(organizer).agg(n(~past).alias("upcoming"), n(past).alias("past"), F.count("*").alias("total"), F.min(order).alias("first_seen")).orderBy(F.desc("total"), "first_seen")


def with_total(df: DataFrame, key: str, label: str = "TOTAL", **sums: Column) -> DataFrame:
    """Aggregates of each key and of all."""
    return df.rollup(key).agg(F.grouping(key).alias("_g"), *[c.alias(n) for n, c in sums.items()]).withColumn(key, F.when(F.col("_g") == 1, label).otherwise(F.col(key))).drop("_g")


def reason_counts(df: DataFrame, reasons: str, top: int = 8) -> DataFrame:
    """The most frequent kinds of reasons."""
    return df.select(F.explode(reasons).alias("_r")).groupBy(text.reason_group(F.col("_r")).alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(top)


def spend(df: DataFrame, order: str, cost: Column, cap: float) -> DataFrame:
    """Calls with the running cost; over marks those after the one that reached the cap. Ranges of the order are summed apart, then what lies before each is added."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = shared.once(df.withColumn("_cost", cost).repartitionByRange(n, order).withColumn("_part", F.spark_partition_id()), "spend")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    base = dealt.groupBy("_part").agg(F.sum("_cost").alias("_sum")).withColumn("_base", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).select("_part", "_base")
    within = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dealt.withColumn("_own", F.sum("_cost").over(within)).join(base, "_part").withColumn("spent", F.col("_own") + F.col("_base")).withColumn("over", F.col("spent") - F.col("_cost") >= cap).select(*df.columns, "spent", "over")


def summary(events: DataFrame, total_sources: int | None = None) -> DataFrame:
    """One row of counts of bucketed events (organizer, source_url, bucket): sources checked, with and without events, rows by bucket, organizers with upcoming rows, past ones and both."""
    n = lambda b: F.count_if(F.col("bucket") == b).alias(b)
    by_bucket = events.agg(*[n(b) for b in ("upcoming", "past", "incomplete", "flagged")], F.count_distinct("source_url").alias("with_events"))
    # a row for each organizer
    has = events.groupBy("organizer").agg(*[F.max(F.col("bucket") == b).alias(b) for b in ("upcoming", "past")])
    count = lambda c, name: F.count_if(c).alias(name)
    both = has.agg(count(F.col("upcoming"), "organizers_upcoming"), count(F.col("past"), "organizers_past"), count(F.col("upcoming") & F.col("past"), "organizers_both"))
    checked = F.col("with_events") if total_sources is None else F.lit(total_sources).cast("long")
    one = by_bucket.withColumn("_k", F.lit(1)).join(both.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return one.withColumn("checked", checked).withColumn("without_events", F.greatest(F.col("checked") - F.col("with_events"), F.lit(0)))


def counts(master: DataFrame, *keys: str) -> DataFrame:
    """Rows of the master by keys, country and bucket by default."""
    return master.groupBy(*(keys or ("country", "bucket"))).agg(F.count("*").alias("n"))


def healthy(*runs: DataFrame) -> DataFrame:
    """The sources that any of the runs (source_url, status) found well."""
    out = runs[0].where("status = 'ok'").select("source_url")
    for r in runs[1:]:
        out = out.union(r.where("status = 'ok'").select("source_url"))
    return out.distinct()


def chronological(df: DataFrame, day: str, *ties: str) -> DataFrame:
    """By day, undated rows last."""
    return df.orderBy(F.col(day).asc_nulls_last(), *ties)


def by_country(df: DataFrame, country: str = "country", shown: str = "date", *ties: str) -> DataFrame:
    """By country, then by the date as it is shown (a text, so 01-Dec comes before 02-Jan)."""
    return df.orderBy(country, text.blank(F.col(shown)), *ties)
