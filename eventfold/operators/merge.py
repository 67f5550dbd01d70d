"""Merges of new rows into kept ones. Keys are names and dates in lower case; ord tells which row came first."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, text


def key(c: str) -> Column:
    return F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))


def fill_blank(old: Column, new: Column) -> Column:
    """The old cell unless it is blank."""
    return F.when(F.coalesce(old, F.lit("")) != "", old).otherwise(new)


def overlay(old: Column, new: Column) -> Column:
    """The new cell unless it is blank: a blank never overwrites."""
    return F.when(F.coalesce(new, F.lit("")) != "", new).otherwise(old)


def raw_upsert(old: DataFrame, new: DataFrame, *, cutoff: dt.date, today: dt.date, day: str = "event_date", name: str = "event_name", when: str = "date", fill: Sequence[str] = ("organizer", "location", "link")) -> DataFrame:
    """old with new rows merged in; column action says kept, repaired or added.

    Both hold ord, name, when (text), day (a date or null) and fill. New rows before the cutoff or with a known (name, when) are left out; a new row with a day
    repairs the last old row of its name that has none, once; the rest is added, one row for each key.
    """
    known = old.select(key(name).alias("_n"), key(when).alias("_w")).distinct()
    fresh = new.where(F.coalesce(F.col(day) >= F.lit(cutoff), F.lit(True))).withColumns({"_n": key(name), "_w": key(when)})
    fresh = fresh.join(known, ["_n", "_w"], "left_anti")
    fresh = fresh.withColumn("_i", F.row_number().over(Window.partitionBy("_n", "_w").orderBy("ord"))).where("_i = 1").drop("_i")
    last = Window.partitionBy("_n").orderBy(F.desc("ord"))
    open_ = old.withColumn("_n", key(name)).where(~dates.has_day(F.col(when))).withColumn("_i", F.row_number().over(last)).where("_i = 1").select("_n", F.col("ord").alias("_old"))
    dated = fresh.where(dates.has_day(F.col(when))).withColumn("_i", F.row_number().over(Window.partitionBy("_n").orderBy("ord"))).where("_i = 1")
    repairs = dated.join(open_, "_n").select("_old", F.col("ord").alias("_new"), *[F.col(c).alias(f"_{c}") for c in (when, day, *fill)])
    status = F.when(dates.is_past(F.col(day), today), "Past").otherwise("Upcoming")
    joined = old.join(repairs, old["ord"] == repairs["_old"], "left")
    hit = F.col("_new").isNotNull()
    kept = joined.select(
        "ord", name,
        F.when(hit, F.col(f"_{when}")).otherwise(F.col(when)).alias(when),
        F.when(hit, F.col(f"_{day}")).otherwise(F.col(day)).alias(day),
        *[F.when(hit, fill_blank(F.col(c), F.col(f"_{c}"))).otherwise(F.col(c)).alias(c) for c in fill],
        F.when(hit, "repaired").otherwise("kept").alias("action"),
    )
    added = fresh.join(repairs.select("_new"), fresh["ord"] == F.col("_new"), "left_anti").select("ord", name, when, day, *fill, F.lit("added").alias("action"))
    return kept.unionByName(added).withColumn("status", status)


def difference(previous: DataFrame, fresh: DataFrame, compare: Sequence[str], *, name: str = "event_name", when: str = "date", bucket: str = "bucket", with_used: bool = False) -> DataFrame:
    """What became of each row: fresh rows are unchanged, changed, completed (an incomplete row of that name got its day), reopened or new; previous rows that no fresh row used are untouched. With with_used, used is the ord of
    the previous row that it is about."""
    p = previous.withColumns({"_n": key(name), "_w": key(when)})
    p1 = p.withColumn("_i", F.row_number().over(Window.partitionBy("_n", "_w").orderBy(F.desc("ord")))).where("_i = 1").drop("_i")
    same = lambda a, b: F.struct(*[text.blank(F.col(f"{a}{c}")) for c in compare]).eqNullSafe(F.struct(*[text.blank(F.col(f"{b}{c}")) for c in compare]))
    named = p1.where(F.col(bucket) == "incomplete").withColumn("_i", F.row_number().over(Window.partitionBy("_n").orderBy(F.desc("ord")))).where("_i = 1")
    side = lambda df, tag: df.select(F.col("_n").alias(f"{tag}n"), F.col("_w").alias(f"{tag}w"), F.col("ord").alias(f"{tag}ord"), *[F.col(c).alias(f"{tag}{c}") for c in compare])
    f = fresh.withColumns({"_n": key(name), "_w": key(when)})
    got = f.join(side(p1, "k_"), (f["_n"] == F.col("k_n")) & (f["_w"] == F.col("k_w")), "left").join(side(named, "i_"), f["_n"] == F.col("i_n"), "left")
    exact, by_name = F.col("k_ord").isNotNull(), F.col("i_ord").isNotNull()
    fate = (
        F.when(exact & same("", "k_"), "unchanged")
        .when(exact, "changed")
        .when(by_name & dates.has_day(F.col(when)), "completed")
        .when(by_name & same("", "i_"), "unchanged")
        .when(by_name, "reopened")
        .otherwise("new")
    )
    told = got.withColumn("fate", fate).withColumn("used", F.coalesce("k_ord", "i_ord"))
    left = p1.join(told.select(F.col("used").alias("_u")).where("_u is not null").distinct(), p1["ord"] == F.col("_u"), "left_anti").withColumn("fate", F.lit("untouched"))
    left = left.withColumn("used", F.col("ord"))
    cols = ["ord", name, when, "fate", *["used"] * with_used]
    return told.select(*cols).unionByName(left.select(*cols))


def reuse(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows whose fingerprint is the kept one get the kept record; changed says which didn't."""
    held = state.select("event_id", F.col("fingerprint").alias("_f"), F.col("record").alias("_r"))
    same = F.coalesce(F.col("fingerprint") == F.col("_f"), F.lit(False))
    return rows.join(held, "event_id", "left").select("event_id", "fingerprint", F.when(same, F.col("_r")).otherwise(F.col("record")).alias("record"), (~same).alias("changed"))


def two_tiers(first: DataFrame, second: DataFrame, key_col: str, again: Column) -> DataFrame:
    """Results of the cheap fetch; those to fetch again from the dear one where it has them."""
    retry = first.where(again)
    better = second.join(retry.select(key_col), key_col, "left_semi")
    return first.join(better.select(key_col), key_col, "left_anti").unionByName(better)


def merge_fields(df: DataFrame, columns: Sequence[str], conflict_columns: Sequence[str] = ("date", "end_date", "format")) -> DataFrame:
    """l_<column> and d_<column> (evidence of list and detail page) as <column>: the surer one, the detail page's if equal; where dates or formats differ
    neither, and the column is named in conflicts."""
    sure = lambda c: F.when(c["confidence"] == "high", 3).when(c["confidence"] == "medium", 2).when(c["confidence"] == "low", 1).otherwise(0)
    out, clash = {}, []
    for c in columns:
        a, b = F.col(f"l_{c}"), F.col(f"d_{c}")
        best = F.when(b.isNull() | (a.isNotNull() & (sure(a) > sure(b))), a).otherwise(b)
        if c in conflict_columns:
            differ = F.coalesce(a["value"] != b["value"], F.lit(False))
            best, clash = F.when(~differ, best), [*clash, F.when(differ, F.lit(c))]
        out[c] = best
    rest = [c for c in df.columns if c not in {f"{s}_{x}" for s in "ld" for x in columns}]
    return df.select(*rest, *[v.alias(k) for k, v in out.items()], F.array_compact(F.array(*clash)).alias("conflicts"))
