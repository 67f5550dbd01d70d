"""What a weekly run's steps read: its records are decided once, and folding them reads its tables a few times and not dozens."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventfold.operators import lifecycle, master
from eventfold.plans import weekly
from eventfold.sources import shared

KINDS = "ord int, event_id string, status string, changed boolean, event_name string, date string, location string, reason string"


def test_a_run_decides_its_records_once(spark, tmp_path, monkeypatch):
    calls, real = [], master.decide
    monkeypatch.setattr(master, "decide", lambda *a: calls.append(1) or real(*a))
    records = spark.createDataFrame([(1, "a", "verified", True, "A", "01-Dec-2026", "x", "")], KINDS)
    sites = spark.createDataFrame([("s", "Org", 1, None)], "source_url string, organizer string, events long, error string")
    weekly.run(spark, str(tmp_path), "one", {"UK": lambda: (records, sites)}, dt.date(2026, 9, 5))
    assert len(calls) == 1
    assert [(r["event_id"], r["bucket"], r["location"]) for r in lifecycle.read(spark, str(tmp_path))[0].collect()] == [("a", "verified", "x")]


def test_the_master_is_applied_in_few_reads(spark, tmp_path):
    records = [
        (1, "a", "verified", True, "A", "d", "new", ""), (2, "b", "rejected", True, "B", "d", "", "out"), (3, "b", "verified", True, "B", "d", "again", ""), (4, "b", "rejected", True, "B", "d", "", "out again"),
        (5, "n", "verified", True, "C", "d", "", ""), (6, "r", "needs_review", False, "R", "d", "", "why"), (7, "l", "rejected", True, "L", "d", "", ""), (8, "a", "verified", True, "A", "d", "here", ""),
    ]
    rows = [("a", "verified", "A", "d", "old", "", "x"), ("b", "verified", "B", "d", "there", "", "x"), ("b", "review", "B", "d", "", "", "y"), ("b", "rejected", "B", "d", "before", "", ""), ("o", "verified", "C", "d", "kept", "", "Legacy"), ("r", "review", "R", "d", "at", "", ""), ("l", "verified", "L", "d", "", "yes", "x"), ("l", "rejected", "L", "d", "", "", ""), (None, "verified", "N", "d", "", "", "x"), ("p", None, "P", "d", "", "", "")]
    for name, data, kinds in (("records", records, KINDS), ("master", rows, "event_id string, bucket string, event_name string, date string, location string, locked string, verified_by string")):
        spark.createDataFrame(data, kinds).write.parquet(str(tmp_path / name))
    told, held = (spark.read.parquet(str(tmp_path / x)) for x in ("records", "master"))
    decided = master.decide(told, held)
    out = master.apply(told, held, F.lit("now"))
    # 6 and 13; 14 and 77 when each use worked it out anew
    reads = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    assert reads(decided) <= 8 and reads(out) <= 16
    cells = lambda df: sorted(((r["event_id"], r["bucket"], r["location"], r["verified_by"]) for r in df.collect()), key=repr)
    want = [
        ("a", "verified", "here", "Rules"), ("b", "rejected", "again", ""), ("n", "verified", "kept", "Rules"), ("r", "review", "at", ""), ("l", "verified", "", "x"), ("l", "rejected", "", ""), (None, "verified", "", "x"), ("p", None, "", ""),
    ]
    assert cells(out) == sorted(want, key=repr)
    table = shared.once(decided, "decided")
    assert cells(master.apply(told, held, F.lit("now"), table)) == sorted(want, key=repr)


@pytest.mark.parametrize("own", [None, "65535"])
def test_rows_of_many_cells_keep_compiled_methods(spark, own):
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(name)
    if own:
        spark.conf.set(name, own)
    try:
        lifecycle.load(spark.createDataFrame([(1, "verified", "A")], "ord int, bucket string, event_name string"), dt.date(2026, 9, 5))
        assert spark.conf.get(name) == (own or "8000")
    finally:
        spark.conf.unset(name)
