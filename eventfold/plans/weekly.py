"""The weekly run as one job: what each country's sites gave goes into the one master, time moves its rows, every step is logged, and a report says what came of it.

A country whose gathering fails leaves its rows as they are: it has no records, and none of its sites counts as healthy, so nothing of it goes missing. The steps of a run are tables below the run's folder, each
written once; a run that died is started again under its name and goes on after the last step that is whole. Whatever happens, a run makes one version of the master, from the version that it found.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lifecycle, master, report
from ..sources import run_state, snapshots
from . import digest

#: What a country's gathering gives: records (ord, event_id, status, changed, the master's cells, link, reason, reasons, attempts) and its sites now (source_url, organizer, events, error).
Gathered = tuple[DataFrame, DataFrame]
RECORD = (*master.CELLS, "link", "reason")
RECORDS = "country_run string, ord long, event_id string, status string, changed boolean, " + ", ".join(f"{c} string" for c in RECORD) + ", reasons array<string>, attempts int"
SITES = "country_run string, source_url string, organizer string, events long, error string"


def _as(df: DataFrame, schema: str, country: str) -> DataFrame:
    """df in the columns of a schema; those that it lacks are null."""
    has = set(df.columns)
    fields = [f.strip().split(" ", 1) for f in schema.replace("array<string>", "array").split(",")]
    kind = {"array": "array<string>"}
    return df.select(*[(F.lit(country) if n == "country_run" else F.col(n) if n in has else F.lit(None)).cast(kind.get(k, k)).alias(n) for n, k in fields])


class Steps:
    """Tables of a run, each made at most once whole."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.files = spark, folder, run_state.Files(spark, folder)

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if not self.files.exists(f"{name}/_SUCCESS"):
            make().write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def note(self, name: str, make: Callable[[], object]) -> object:
        """A small value, told once."""
        if self.files.get(name) is None:
            self.files.put(name, json.dumps(make()))
        return json.loads(self.files.get(name))


def run(spark: SparkSession, path: str, name: str, countries: Mapping[str, Callable[[], Gathered]], today: dt.date, review: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The report: country, outcome (done or failed), and digest.checked's counts. The master, its log and the report are new versions below path.

    countries: by label what gathers a country's records and sites, called once. review: rows to rows, the outcomes of a reviewer; where it fails the rest of the run stands.
    """
    steps, stamp = Steps(spark, f"{path}/runs/{name}"), name
    base = steps.note("base.json", lambda: max(snapshots.versions(spark, f"{path}/master"), default=-1))
    outcomes, records, sites = {}, [], []
    for label, gather in countries.items():
        try:
            known = steps.files.exists(f"records-{label}/_SUCCESS") and steps.files.exists(f"sites-{label}/_SUCCESS")
            got = None if known or steps.files.get(f"failed-{label}") else gather()
            if got is not None or known:
                records.append(steps.table(f"records-{label}", lambda got=got, label=label: _as(got[0], RECORDS, label)))
                sites.append(steps.table(f"sites-{label}", lambda got=got, label=label: _as(got[1], SITES, label)))
            outcomes[label] = "done" if got is not None or known else "failed"
        except Exception as e:  # one country's failure leaves the others
            outcomes[label] = "failed"
            records, sites = records[: len(sites)], sites
            steps.files.put(f"failed-{label}", f"{type(e).__name__}: {e}"[:500])
    none = lambda schema: spark.createDataFrame([], schema)
    union = lambda parts, schema: _union(parts) if parts else none(schema)
    told, now = union(records, RECORDS), union(sites, SITES)
    before = spark.read.parquet(f"{path}/sites/v={base}") if base >= 0 and base in snapshots.versions(spark, f"{path}/sites") else none(SITES)
    health = steps.table("health", lambda: report.health(now, before).join(now.select("source_url", "country_run").distinct(), "source_url"))
    kept = spark.read.parquet(f"{path}/master/v={base}") if base >= 0 else none("ord long, bucket string")
    if "ord" not in kept.columns:
        kept = kept.withColumn("ord", F.monotonically_increasing_id())
    loaded = steps.table("loaded", lambda: lifecycle.load(kept, today))
    decided = steps.table("decided", lambda: master.decide(told, loaded))
    applied = steps.table("applied", lambda: master.apply(told, loaded, F.lit(today.strftime("%d-%b-%Y")), decided))
    aged = steps.table("aged", lambda: lifecycle.age(applied, told.select("event_id"), health, today))
    rows = aged.drop("outcome")
    if review is not None:
        try:
            rows = steps.table("reviewed", lambda: review(rows))
        except Exception as e:  # the rest of the run still stands
            steps.files.put("review-failed", f"{type(e).__name__}: {e}"[:500])
    log = lifecycle.log_of_records(decided, loaded, stamp).unionByName(lifecycle.log_of_ageing(aged, stamp))
    if steps.files.get("saved") is None:
        lifecycle.save(rows.drop("ord"), log, path, version=base + 1)
        past = before.join(now.select("source_url").distinct(), "source_url", "left_anti")  # sites of countries that failed keep what was known of them
        snapshots.write(past.unionByName(now), f"{path}/sites", base + 1)
        checked = digest.checked(health.withColumnRenamed("country_run", "country"), told.drop("country").withColumnRenamed("country_run", "country").withColumn("reasons", F.coalesce("reasons", F.array().cast("array<string>"))))
        states = spark.createDataFrame(sorted(outcomes.items()), "country string, outcome string")
        snapshots.write(states.join(checked, "country", "left"), f"{path}/report", base + 1)
        snapshots.write(lifecycle.counters(decided, aged), f"{path}/counters", base + 1)
        steps.files.put("saved", str(base + 1))
    return spark.read.parquet(f"{path}/report/v={base + 1}")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
