"""Reports as text, from aggregates of a row for each country."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

HEALTH = ("ok", "failed", "empty", "big_drop")
STATUSES = ("verified", "needs_review", "rejected", "past", "unreachable", "shared_page")


def lines(countries: DataFrame, columns: dict[str, str], failed: DataFrame | None = None, top: int = 10) -> list[str]:
    """countries: country, status and counts, one row for each configured country; columns names the counts in order; failed: country, organizer of sites that didn't load."""
    out: list[str] = []
    bad: dict[str, list[str]] = {}
    if failed is not None:
        nth = F.row_number().over(Window.partitionBy("country").orderBy("organizer"))
        many = {r["country"]: r["n"] for r in failed.groupBy("country").agg(F.count("*").alias("n")).collect()}  # a number for each country
        for r in failed.select("country", "organizer", nth.alias("nth")).where(F.col("nth") <= top).orderBy("country", "nth").toLocalIterator():
            bad.setdefault(r["country"], []).append(r["organizer"])
    for r in countries.orderBy("country").toLocalIterator():
        out += ["", f"--- {r['country']} ---"]
        if r["status"] != "done":
            out.append("  The run failed: what was known stays as it was.")
            continue
        out += [f"  {label}: {r[c]}" for c, label in columns.items()]
        sites = bad.get(r["country"], [])
        if sites:
            out.append(f"  Sites that did not load ({many[r['country']]}):")
            out += [f"    - {s}" for s in sites]
    return out


def master_lines(actions: DataFrame, totals: DataFrame) -> list[str]:
    """What was done to the master and what it holds; actions: action, n; totals: bucket, n."""
    told = lambda df, k: ", ".join(f"{r[k]} {r['n']}" for r in df.orderBy(k).toLocalIterator()) or "nothing"
    return ["--- MASTER ---", f"  Done: {told(actions, 'action')}", f"  Held: {told(totals, 'bucket')}"]


def checked(sites: DataFrame, records: DataFrame, top: int = 8) -> DataFrame:
    """A row for each country of sites (country, source_url, status) with what records (country, status, reasons, attempts) came to: sites by health, events by status, those that a later
    attempt mended, and the most frequent kinds of reasons for review (reason and number, at most top)."""
    c = F.col
    health = sites.groupBy("country").agg(F.count("*").alias("sites"), *[F.count_if(c("status") == x).alias(f"sites_{x}") for x in HEALTH])
    fixed_ = (c("attempts") > 0) & (c("status") == "verified")
    events = records.groupBy("country").agg(F.count("*").alias("events"), *[F.count_if(c("status") == x).alias(x) for x in STATUSES], F.count_if(fixed_).alias("fixed_by_retry"))
    kinds = records.where("status = 'needs_review'").select("country", F.explode("reasons").alias("_r")).groupBy("country", text.reason_group(c("_r")).alias("reason")).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("country").orderBy(F.desc("n"), "reason"))  # the rank is limited before the shuffle
    best = kinds.withColumn("_i", rank).where(c("_i") <= top).groupBy("country").agg(F.array_sort(F.collect_list(F.struct("_i", "n", "reason"))).alias("reasons"))
    out = health.join(events, "country", "left").join(best, "country", "left")
    zero = ["events", *STATUSES, "fixed_by_retry"]
    return out.select("country", "sites", *[f"sites_{x}" for x in HEALTH], *[F.coalesce(x, F.lit(0)).alias(x) for x in zero], F.transform(F.coalesce("reasons", F.array().cast("array<struct<_i: int, n: bigint, reason: string>>")), lambda r: F.struct(r["n"].alias("n"), r["reason"].alias("reason"))).alias("reasons"))
