"""The master from run to run: rows as they were kept become whole rows, time moves some of them, and every step leaves an entry in the log.

Buckets are verified, review, past and rejected. A row's id is unique within its bucket once it is loaded.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, fixed, text
from ..sources import shared, sheets, snapshots
from . import dedupe, master, report

KEPT_WITH_A_ROW = ("event_id", "added_on", "last_seen", "verified_by", "locked", "status", "review_reason", "ai_review", "reject_reason")
LOG = ("stamp", "event_id", "event_name", "action", "field", "old_value", "new_value", "source", "changed_by")


def load(kept: DataFrame, today: dt.date) -> DataFrame:
    """ord, bucket, the master's cells and what is kept with a row, from a table that may lack any but ord and bucket (absent or null: empty text).

    Rows without a name go. A row without an id gets the one that its organizer, name and page give, and counts as verified by an old version unless someone else is named. A row that doesn't say since
    when it is there or when it was seen last says today, so its grace period begins now. The second row of an id in a bucket becomes <id>~2.
    """
    shared.short_methods()
    shown = today.strftime("%d-%b-%Y")
    c = F.col
    rows = sheets.tolerant(kept, (*master.CELLS, *KEPT_WITH_A_ROW), keep=("ord", "bucket")).where(c("event_name") != "")
    old = c("event_id") == ""
    rows = rows.withColumns(
        {
            "verified_by": F.when(old & (c("verified_by") == ""), fixed.LEGACY).otherwise(c("verified_by")),
            "event_id": F.when(old, text.event_id(c("organizer"), c("event_name"), c("register_link"), c("source_url"), F.lit(""))).otherwise(c("event_id")),
            **{x: F.when(c(x) == "", shown).otherwise(c(x)) for x in ("added_on", "last_seen")},
        }
    )
    return dedupe.suffix_ids(rows, "event_id", ["ord"], ["bucket"])


def age(rows: DataFrame, seen: DataFrame, sites: DataFrame, today: dt.date) -> DataFrame:
    """Loaded rows with outcome: kept, past or missing, the latter two in their new buckets.

    seen: event_id of this run's records; sites: source_url, status. A row that moves takes the place of one of its id there.
    """
    c = F.col
    day = lambda x: dates.from_display(c(x))
    verified = rows.where("bucket = 'verified'").select("event_id", c("register_link").alias("link"), "source_url", day("date").alias("start_date"), day("end_date").alias("end_date"), day("last_seen").alias("last_seen"), "locked")
    told = report.missing_and_past(verified, seen, sites, today).where("outcome <> 'kept'")
    # one table of what moves, from where, and of the places that it takes, so that what moves is worked out once and rows meet it in one join
    to = F.when(c("outcome") == "past", "past").otherwise("review")
    places = F.array(F.struct(F.lit("verified").alias("bucket"), c("outcome").alias("outcome")), F.struct(to.alias("bucket"), F.lit("replaced").alias("outcome")))
    told = told.select("event_id", F.explode(places).alias("_p")).select("event_id", "_p.bucket", "_p.outcome")
    all_ = rows.join(told, ["event_id", "bucket"], "left").withColumn("outcome", F.coalesce("outcome", F.lit("kept"))).where("outcome <> 'replaced'")
    past, gone = c("outcome") == "past", c("outcome") == "missing"
    changed = {
        "bucket": F.when(past, "past").when(gone, "review").otherwise(c("bucket")),
        "status": F.when(past, "Past").otherwise(c("status")),
        "review_reason": F.when(gone, F.concat(F.lit(fixed.NOT_FOUND_SINCE), c("last_seen"))).otherwise(c("review_reason")),
        "ai_review": F.when(gone, "").otherwise(c("ai_review")),
    }
    return all_.select(*[changed.get(x, c(x)).alias(x) for x in rows.columns], "outcome")


def _entries(rows: DataFrame, stamp: str, action: Column, **said: Column) -> DataFrame:
    given = {"stamp": F.lit(stamp), "event_id": F.col("event_id"), "event_name": F.col("event_name"), "action": action, "changed_by": F.lit(fixed.BY_RUN)} | said
    return rows.select(*[text.blank(given.get(x, F.lit(""))).alias(x) for x in LOG])


def log_of_ageing(aged: DataFrame, stamp: str) -> DataFrame:
    """An entry for each row that moved."""
    past = F.col("outcome") == "past"
    told = F.when(past, fixed.ACTIONS["past"]).otherwise(fixed.ACTIONS["missing"])
    return _entries(aged.where("outcome <> 'kept'"), stamp, told, new_value=F.when(~past, F.col("review_reason")), source=F.when(past, fixed.DATE_PASSED).otherwise(fixed.NOT_ON_SITE))


def log_of_records(decided: DataFrame, rows: DataFrame, stamp: str) -> DataFrame:
    """Entries of master.decide's records (with the cells, link and reason): one for a row that is added, moved or taken over, and one for each cell that an update changes."""
    names = F.create_map(*[F.lit(x) for pair in fixed.ACTIONS.items() for x in pair])
    reason = F.when(F.col("action").isin("sent_to_review", "rejected"), F.col("reason"))
    whole = decided.where(F.col("action").isin("added", "promoted", "legacy_replaced", "sent_to_review", "rejected"))
    had = rows.where("bucket = 'rejected'").select("event_id").distinct()
    whole = whole.join(had.withColumn("_had", F.lit(True)), "event_id", "left").where("action <> 'rejected' or _had is null")
    out = _entries(whole, stamp, names[F.col("action")], new_value=reason, source=F.col("link"))
    new = decided.where("action = 'updated'").select("event_id", F.col("event_name").alias("_name"), "link", *[F.col(x).alias(f"_{x}") for x in fixed.UPDATABLE])
    cells = F.array(*[F.struct(F.lit(x).alias("field"), F.col(x).alias("old"), F.col(f"_{x}").alias("new")) for x in fixed.UPDATABLE])
    each = rows.where("bucket = 'verified'").join(new, "event_id").select("event_id", "event_name", "link", F.explode(cells).alias("_c")).where("_c.new <> '' and not _c.new <=> _c.old")  # most cells are as they were, so only the rest is read as text
    each = each.select("event_id", "event_name", "link", "_c.field", text.blank(F.col("_c.old")).alias("old_value"), text.blank(F.col("_c.new")).alias("new_value")).where("new_value <> '' and new_value <> old_value")
    return out.unionByName(_entries(each, stamp, F.lit("updated"), field=F.col("field"), old_value=F.col("old_value"), new_value=F.col("new_value"), source=F.col("link")))


def counters(decided: DataFrame, aged: DataFrame) -> DataFrame:
    """action, n: how often each thing was done in a run, by records and by time."""
    moved = aged.where("outcome <> 'kept'").select(F.when(F.col("outcome") == "past", "moved_to_past").otherwise("not_found_to_review").alias("action"))
    return decided.select("action").unionByName(moved).groupBy("action").agg(F.count("*").alias("n"))


def save(rows: DataFrame, log: DataFrame, path: str, keep: int = 2, version: int | None = None) -> int:
    """A new version of the master below path (the next, or the one that is named), a folder for each bucket, rows in order of country and day; the version before stays as a backup. The run's log is kept under the same number."""
    n = max(snapshots.versions(rows.sparkSession, f"{path}/master"), default=-1) + 1 if version is None else version
    log.write.mode("overwrite").parquet(f"{path}/log/v={n}")
    by = ["bucket", "country", F.col("_day").asc_nulls_last(), "event_id"]  # ranges of all four, so a country that holds most rows still spreads
    ordered = rows.withColumn("_day", dates.from_display(F.col("date"))).repartitionByRange(*by).sortWithinPartitions(*by).drop("_day")
    return snapshots.write(ordered, f"{path}/master", n, keep, ("bucket",))


def read(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame | None]:
    """The newest version of the master and the whole log; None where nothing was ever saved."""
    rows = snapshots.latest(spark, f"{path}/master")
    return rows, spark.read.parquet(f"{path}/log").drop("v") if rows is not None else None


def fill(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of both by key: of each cell the newest that isn't blank, so a later blank never takes away what was known."""
    rows = old.unionByName(new, allowMissingColumns=True)
    said = lambda x: F.max_by(F.when(text.blank(F.col(x)) != "", F.col(x)), F.when(text.blank(F.col(x)) != "", F.col(order))).alias(x)
    return rows.groupBy(key).agg(*[F.max(order).alias(order) if x == order else said(x) for x in rows.columns if x != key]).select(*rows.columns)
