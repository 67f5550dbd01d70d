"""The master table: what a run's records do to it, and the log of what changed.

Buckets are verified, review, rejected and past. Of a record with status verified, needs_review, rejected or past the table below says what happens; a locked verified row
only counts as skipped (but for a past record, which refreshes last_seen first).

    status        id in verified                          id in review                     neither
    verified      update non-blank cells of UPDATABLE     promoted, non-blank cells win    duplicate by (name, date)? a legacy row is taken over, else skipped; else added
    needs_review  kept, last_seen refreshed               new cells and reason             to review
    rejected      to rejected, non-blank cells win        to rejected                      to rejected
    past          last_seen refreshed                     nothing                          nothing

Records of one id are resolved one after another, by ord: each finds the id where the one before left it. A rejection ends a stretch of records: what follows begins with no row. Where an id is
within a stretch follows from running facts (has a record entered, has one gone to review), so it takes windows over an id's records and no loop; a cell is the last non-blank one that was written.

Duplicates go by name (any case) and date, unless both are blank: of a verified row of another id as the master was before the run, or of a verified record of another id that came earlier in it.
Of records that find the same legacy row the first takes it over, if no record of the run has the row's own id.

Defined results: records without an id do nothing; ids are unique in a bucket (lifecycle.load makes them so); columns of the master that records lack stay with their row and are null for new ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..sources import shared
from . import merge

CELLS = ("country", "date", "end_date", "event_name", "organizer", "category", "format", "location", "description", "register_link", "source_url")
#: Actions that write a record's cells, and those of them that write cells outside UPDATABLE too.
WRITES = ("updated", "legacy_replaced", "promoted", "added", "sent_to_review", "review_updated", "rejected")
WHOLE = ("promoted", "added", "sent_to_review", "review_updated", "rejected")
STATES = ("_v", "_r", "_l")


def _first_two(rows: DataFrame, by: Sequence[str], order: Column, kinds: Sequence[str] = ()) -> DataFrame:
    """The rows of the two least values of each group and kind; the rank is limited before the shuffle, so a hot group costs two a task."""
    return rows.withColumn("_i", F.dense_rank().over(Window.partitionBy(*by, *kinds).orderBy(order))).where("_i <= 2")


def _old(rows: DataFrame, records: DataFrame) -> DataFrame:
    """By name and date of verified rows: _old (id, legacy) of the least id, _next of the one after it. A legacy row may be taken over if no record has its own id."""
    c, by = F.col, ["_n", "_w"]
    own = records.select("event_id").distinct().withColumn("_told", F.lit(True))
    old = rows.where("bucket = 'verified'").join(own, "event_id", "left").select(
        merge.key("event_name").alias("_n"), merge.key("date").alias("_w"), c("event_id").alias("_id"),
        (F.lower(F.coalesce("verified_by", F.lit(""))).startswith("legacy") & ~text.truthy(c("locked")) & c("_told").isNull()).alias("_legacy"),
    )
    held = F.struct("_id", "_legacy")
    nth = lambda i: F.min(F.when(c("_i") == i, held))
    return _first_two(old, by, c("_id")).groupBy(*by).agg(nth(1).alias("_old"), nth(2).alias("_next"))


def _leads(records: DataFrame, at: DataFrame) -> DataFrame:
    """By name and date of verified records: _lead (ord, id) of the first, _second of the first of another id, _takes the ord of the first whose id has no row yet."""
    by, new = ["_n", "_w"], F.col("_new")
    each = _at(records.where("status = 'verified' and event_id is not null").select("event_id", "ord", "changed", merge.key("event_name").alias("_n"), merge.key("date").alias("_w")), at)
    each = each.where("(_n <> '' or _w <> '') and not _l and (_new or coalesce(changed, true))")
    own = each.groupBy(*by, "_new", "event_id").agg(F.min("ord").alias("ord"))
    # of ids with a row and of those without the first two each, so the first two of all are among them
    least = _first_two(own, by, F.struct("ord", "event_id"), ["_new"]).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("ord", "event_id"))).alias("_least"), F.min(F.when(new, F.col("ord"))).alias("_takes"))
    return least.select(*by, F.get("_least", F.lit(0)).alias("_lead"), F.get("_least", F.lit(1)).alias("_second"), "_takes")


def _at(rows: DataFrame, at: DataFrame) -> DataFrame:
    """Rows with where their ids are before the run; _new: nowhere that counts."""
    return rows.join(at, "event_id", "left").withColumns({x: F.coalesce(x, F.lit(False)) for x in STATES}).withColumn("_new", ~F.col("_v") & ~F.col("_r"))


def decide(records: DataFrame, master: DataFrame) -> DataFrame:
    """records with action, target (the id of the row that is taken over or repeated) and stretch (how many rejections of the id came before).

    records: ord, event_id, status, event_name, date, changed. master: event_id, bucket, event_name, date, locked, verified_by. Whole records are dealt twice, by name and date and then by id.
    """
    c, s = F.col, F.col("status")
    at = master.groupBy("event_id").agg(*[F.max(x).alias(n) for n, x in zip(STATES, (c("bucket") == "verified", c("bucket") == "review", (c("bucket") == "verified") & text.truthy(c("locked"))), strict=True)])
    rows = records.withColumns({"_n": merge.key("event_name"), "_w": merge.key("date")}).withColumn("_bare", (c("_n") == "") & (c("_w") == ""))
    rows = rows.join(_old(master, records), ["_n", "_w"], "left").join(_leads(records, at), ["_n", "_w"], "left")
    other = F.when(c("_old._id") == c("event_id"), c("_next")).otherwise(c("_old"))
    before = F.when(c("_lead.event_id") == c("event_id"), c("_second")).otherwise(c("_lead"))
    rows = rows.withColumns({"_other": F.when(~c("_bare"), other), "_earlier": F.when(~c("_bare") & (before["ord"] < c("ord")), before["event_id"])})
    takes = F.coalesce(c("_other._legacy") & (c("_takes") == c("ord")) & c("_earlier").isNull(), F.lit(False))
    rows = rows.withColumns({"_takes_over": takes, "_repeats": (c("_other").isNotNull() | c("_earlier").isNotNull()) & ~takes})
    rows = _at(rows.drop("_n", "_w", "_old", "_next", "_lead", "_second", "_takes"), at)
    # where the id is when a record comes
    past = Window.partitionBy("event_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("stretch", F.coalesce(F.sum(((s == "rejected") & ~c("_l")).cast("int")).over(past), F.lit(0)))
    here = Window.partitionBy("event_id", "stretch").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda x: F.coalesce(F.max(x).over(here), F.lit(False))
    begins_v = c("_v") & (c("stretch") == 0)
    begins_r = c("_r") & F.when(c("_v"), c("stretch") == 1).otherwise(c("stretch") == 0)
    rows = rows.withColumns({"_begins_v": begins_v, "_to_review": begins_r | so_far(s == "needs_review")})
    rows = rows.withColumn("_entered", c("_begins_v") | so_far((s == "verified") & (c("_to_review") | ~c("_repeats"))))
    action = (
        F.when(c("event_id").isNull(), "nothing")
        .when((s == "past") & c("_entered"), "seen")
        .when(c("_l") & s.isin("verified", "needs_review", "rejected"), "locked_skipped")
        .when((s == "verified") & c("_entered"), F.when(F.coalesce("changed", F.lit(True)), "updated").otherwise("unchanged"))
        .when((s == "verified") & c("_to_review"), "promoted")
        .when((s == "verified") & c("_takes_over"), "legacy_replaced")
        .when((s == "verified") & c("_repeats"), "duplicates_skipped")
        .when(s == "verified", "added")
        .when((s == "needs_review") & c("_entered"), "kept_after_failed_rescrape")
        .when((s == "needs_review") & c("_to_review"), "review_updated")
        .when(s == "needs_review", "sent_to_review")
        .when(s == "rejected", "rejected")
        .otherwise("nothing")
    )
    target = F.when(action == "legacy_replaced", c("_other._id")).when(action == "duplicates_skipped", F.coalesce("_other._id", "_earlier"))
    return rows.withColumns({"action": action, "target": target}).select(*records.columns, "action", "target", "stretch")


def apply(records: DataFrame, master: DataFrame, today: Column, decided: DataFrame | None = None) -> DataFrame:
    """The master after a run, with all its columns: rows overlaid, moved, taken over and added, none lost. decided: what decide says of the same, where it is a table already.

    Records are folded by stretch without their rows, and one full join brings the folds to the rows that they began with: a row that no stretch began with stays as it is.
    """
    shared.short_methods()
    c, cells, kept = F.col, [x for x in CELLS if x in master.columns and x in records.columns], set(master.columns)
    told = (decide(records, master) if decided is None else decided.repartition("event_id")).where("action not in ('nothing', 'locked_skipped', 'duplicates_skipped')")
    did = lambda *actions: c("action").isin(*actions)
    last = lambda value, when: F.max_by(value, F.when(when, c("ord")))
    wrote = lambda x: did(*(WRITES if x in fixed.UPDATABLE else WHOLE)) & (F.coalesce(c(x), F.lit("")) != "")
    shown = [x for x in cells if x in fixed.UPDATABLE]
    # what each stretch wrote; all records of an id meet in one task, as they did when they were decided
    several = lambda x: F.coalesce(F.min(F.when(wrote(x), c(x))) != F.max(F.when(wrote(x), c(x))), F.lit(False))
    any_of = lambda flags: F.exists(F.array(*flags), lambda f: f) if flags else F.lit(False)
    reason = c("reason") if "reason" in records.columns else F.lit("")
    folds = told.groupBy("event_id", "stretch").agg(
        F.max("target").alias("_target"),
        *[last(c(x), wrote(x)).alias(x) for x in cells],
        F.max(did("rejected")).alias("_out"), F.max(did("promoted", "added", "legacy_replaced")).alias("_in"),
        F.max(did("updated")).alias("_up"), F.max(did(*WHOLE)).alias("_whole"), any_of([several(x) for x in shown]).alias("_several"),
        last(reason, did("sent_to_review", "review_updated")).alias("_review_reason"), last(reason, did("rejected")).alias("_reject_reason"),
        F.min(~did("review_updated") | ~F.coalesce("changed", F.lit(True))).alias("_same"),
    )
    # the last rejection of an id makes its row, one before it none
    folds = folds.withColumn("_last", F.max(F.when(c("_out"), c("stretch"))).over(Window.partitionBy("event_id"))).withColumn("_makes", ~c("_out") | (c("stretch") == c("_last"))).drop("_last")
    folds = folds.withColumns({"_base": F.coalesce("_target", "event_id"), "_nth": F.when(c("_target").isNotNull(), 0).otherwise(c("stretch")).cast("long")}).drop("_target", "stretch")
    # the rows that stretches may begin with: the verified one of an id, then the one in review
    verified, review = master.where("bucket = 'verified'"), master.where("bucket = 'review'")
    nth = review.join(verified.select("event_id", F.lit(1).alias("_v")).distinct(), "event_id", "left")
    whole = F.struct(*master.columns).alias("_row")
    bases = verified.select(c("event_id").alias("_base"), F.lit(0).cast("long").alias("_nth"), whole).unionByName(nth.select(c("event_id").alias("_base"), F.coalesce("_v", F.lit(0)).cast("long").alias("_nth"), whole))
    rows = folds.join(bases, ["_base", "_nth"], "full").where("_makes is null or _makes")
    was = lambda x: c(f"_row.{x}") if x in kept else F.lit(None).cast("string")
    differs = any_of([F.coalesce(c(x) != F.coalesce(was(x), F.lit("")), F.lit(False)) for x in shown]) | c("_several")
    out, in_ = c("_out"), c("_in") | ((was("bucket") == "verified") & ~c("_out"))
    bucket = F.when(out, "rejected").when(in_, "verified").otherwise("review")
    new = {
        "event_id": c("event_id"),
        "bucket": bucket,
        **{x: F.coalesce(c(x), was(x), F.lit("")) for x in cells},
        "added_on": F.when(out | c("_row").isNull(), today).otherwise(F.when(F.coalesce(was("added_on"), F.lit("")) == "", today).otherwise(was("added_on"))),
        "last_seen": today,
        "verified_by": F.when(bucket != "verified", "").when(c("_in") | (c("_up") & differs), "Rules").otherwise(was("verified_by")),
        "locked": F.when(c("_whole"), "").otherwise(was("locked")),
        "status": F.when(c("_whole"), "Upcoming").otherwise(was("status")),
        "review_reason": F.when(bucket == "review", F.coalesce("_review_reason", F.lit(""))).when(c("_whole"), "").otherwise(was("review_reason")),
        "ai_review": F.when((bucket == "review") & c("_row").isNotNull() & c("_same"), was("ai_review")).when(c("_whole"), "").otherwise(was("ai_review")),
        "reject_reason": F.when(out, F.coalesce("_reject_reason", F.lit(""))).when(c("_whole"), "").otherwise(was("reject_reason")),
    }
    made = rows.select(*[(F.when(c("_makes"), new[x]).otherwise(was(x)) if x in new else was(x)).alias(x) for x in master.columns])
    # rows of other buckets stay; a rejection (any but of an id with a locked verified row, as decide has it) replaces an earlier one
    locked = verified.where(text.truthy(c("locked"))).select("event_id")
    gone = records.where("status = 'rejected'").select("event_id").distinct().join(locked, "event_id", "left_anti")
    rejected = master.where("bucket = 'rejected'").join(gone, "event_id", "left_anti").select(*master.columns)
    rest = master.where("bucket is null or bucket not in ('verified', 'review', 'rejected')")
    return made.unionByName(rejected).unionByName(rest)


def changes(old: DataFrame, new: DataFrame, columns: Sequence[str] = fixed.UPDATABLE, id_col: str = "event_id") -> DataFrame:
    """A row for each cell that changed to something: event_id, field, old_value, new_value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), text.blank(old[c]).alias("old_value"), text.blank(new[c]).alias("new_value")) for c in columns])
    joined = old.join(new, old[id_col] == new[id_col]).select(old[id_col].alias(id_col), F.explode(pairs).alias("_c"))
    return joined.select(id_col, "_c.*").where("new_value != '' and new_value != old_value")
