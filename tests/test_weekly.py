import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from eventfold.operators import lifecycle
from eventfold.plans import weekly
from eventfold.sources import snapshots

KINDS = "ord int, event_id string, status string, changed boolean, event_name string, date string, country string, source_url string, register_link string, reason string, reasons array<string>, attempts int"


def gathered(spark, calls, label, rows, events=3):
    def gather():
        calls.append(label)
        site = f"http://{label}.example/list"
        records = [(i, e, s, True, f"Event {e}", d, label, site, f"http://{label}.example/{e}", "why", ["date '1' bad"], a) for i, (e, s, d, a) in enumerate(rows)]
        return spark.createDataFrame(records, KINDS), spark.createDataFrame([(site, "Org", events, None)], "source_url string, organizer string, events long, error string")

    return gather


def boom():
    raise OSError("no network")


def test_two_weeks(spark, tmp_path):
    path, calls = str(tmp_path), []
    far = "01-Dec-2026"
    first = {"UK": gathered(spark, calls, "UK", [("a", "verified", far, 0), ("b", "needs_review", far, 0), ("o", "verified", "01-Sep-2026", 1)]), "USA": gathered(spark, calls, "USA", [("c", "verified", far, 1), ("d", "verified", far, 0)])}
    report = {r["country"]: r for r in weekly.run(spark, path, "one", first, dt.date(2026, 9, 5)).collect()}
    assert report["UK"]["outcome"] == "done" and report["UK"]["verified"] == 2 and report["UK"]["fixed_by_retry"] == 1 and report["UK"]["reasons"][0]["reason"] == "date ... bad" and report["UK"]["sites_ok"] == 1
    second = {"UK": gathered(spark, calls, "UK", [("b", "verified", far, 0)]), "USA": boom}
    report = {r["country"]: r for r in weekly.run(spark, path, "two", second, dt.date(2026, 9, 22)).collect()}
    assert report["USA"]["outcome"] == "failed" and report["USA"]["verified"] is None
    rows, log = lifecycle.read(spark, path)
    held = {(r["event_id"], r["bucket"]): r for r in rows.collect()}
    assert set(held) == {("a", "review"), ("b", "verified"), ("o", "past"), ("c", "verified"), ("d", "verified")}  # nothing of the country that failed is missing
    assert held["a", "review"]["review_reason"] == "Not found on its website since 05-Sep-2026" and held["c", "verified"]["last_seen"] == "05-Sep-2026" and held["b", "verified"]["added_on"] == "05-Sep-2026"
    assert {(r["event_id"], r["action"]) for r in log.where("stamp = 'two'").collect()} == {("a", "sent to Needs Review"), ("b", "promoted to Verified")}
    done = {r["action"]: r["n"] for r in snapshots.latest(spark, f"{path}/counters").collect()}
    assert done == {"promoted": 1, "not_found_to_review": 1}
    sites = {r["source_url"] for r in snapshots.latest(spark, f"{path}/sites").collect()}
    assert sites == {"http://UK.example/list", "http://USA.example/list"}  # what was known of the site stays
    assert calls == ["UK", "USA", "UK"]


@pytest.mark.parametrize("where", ["aged", "saved"])
def test_a_run_that_died_goes_on(spark, tmp_path, monkeypatch, where):
    path, calls = str(tmp_path), []
    countries = {"UK": gathered(spark, calls, "UK", [("a", "verified", "01-Dec-2026", 0)])}
    real = lifecycle.age if where == "aged" else lifecycle.counters

    def dies(*a):
        raise KeyboardInterrupt

    monkeypatch.setattr(lifecycle, real.__name__, dies)
    with pytest.raises(KeyboardInterrupt):
        weekly.run(spark, path, "one", countries, dt.date(2026, 9, 5))
    monkeypatch.setattr(lifecycle, real.__name__, real)
    for _ in range(2):  # once more after it is done changes nothing
        weekly.run(spark, path, "one", countries, dt.date(2026, 9, 5))
        assert calls == ["UK"] and snapshots.versions(spark, f"{path}/master") == [0] and os.path.exists(f"{path}/runs/one/saved")
    rows, log = lifecycle.read(spark, path)
    assert [r["event_id"] for r in rows.collect()] == ["a"] and log.count() == 1


def test_a_reviewer_that_fails_leaves_the_run(spark, tmp_path):
    countries = {"UK": gathered(spark, [], "UK", [("a", "needs_review", "01-Dec-2026", 0)])}
    weekly.run(spark, str(tmp_path), "one", countries, dt.date(2026, 9, 5), review=lambda rows: boom())
    rows, _ = lifecycle.read(spark, str(tmp_path))
    assert [r["bucket"] for r in rows.collect()] == ["review"] and "no network" in (tmp_path / "runs" / "one" / "review-failed").read_text()
    weekly.run(spark, str(tmp_path), "two", {}, dt.date(2026, 9, 6), review=lambda rows: rows.withColumn("ai_review", F.lit("looked at")))
    rows, _ = lifecycle.read(spark, str(tmp_path))
    assert [r["ai_review"] for r in rows.collect()] == ["looked at"]
