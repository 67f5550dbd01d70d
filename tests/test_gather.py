"""Pages as a data source, runs in micro-batches, leases and counts."""

import json
import os
import sys
import time
import uuid

import pytest
from pyspark.sql import functions as F

from eventfold.functions import text
from eventfold.sources import fetch, pages, run_state, snapshots
from eventfold.streaming import gather

ASKED = "EVENTFOLD_TEST_ASKED"


def fetcher(url):
    """Notes when it was asked and until when; pages by what their address says."""
    began = time.time()
    time.sleep(0.02)
    with open(f"{os.environ[ASKED]}/{uuid.uuid4().hex}", "w") as f:
        json.dump([url, began, time.time()], f)
    n = int(url.rsplit("/", 1)[1])
    kinds = [
        {"content": "Straße ".encode() * 100, "charset": None, "status": 200}, {"content": "café ".encode("cp1252") * 100, "charset": "ISO-8859-1", "status": 200},
        {"content": b'<meta charset="windows-1251">' + "дата ".encode("cp1251") * 50, "status": 200}, {"html": "Just a moment ...", "status": 200}, {"html": None, "status": 503},
    ]
    if n % 6 == 5:
        raise OSError("no route")
    return kinds[n % 6]


def asked(folder):
    return [json.loads(p.read_text()) for p in folder.iterdir()]


def test_pages_as_a_source(spark, tmp_path, monkeypatch):
    seen = tmp_path / "asked"
    seen.mkdir()
    module = tmp_path / "code"
    module.mkdir()
    (module / "some_fetcher.py").write_text(f"import os\nos.environ[{ASKED!r}] = {str(seen)!r}\n" + open(__file__).read().split("def asked")[0].replace("import pytest\n", ""))
    monkeypatch.setenv("PYTHONPATH", os.pathsep.join([str(module), *sys.path]))
    spark.sparkContext.addPyFile(str(module / "some_fetcher.py"))
    urls = spark.createDataFrame([(f"http://h{i % 7}.example/{i}",) for i in range(42)] * 2 + [(None,), (" ",)], "url string")
    pages.deal(urls, str(tmp_path / "dealt"), readers=4)
    spark.dataSource.register(pages.Pages)
    read = spark.read.format("pages").option("fetcher", "some_fetcher:fetcher").option("pause", "0").load(str(tmp_path / "dealt"))
    got = {r["url"]: r for r in read.collect()}
    assert len(got) == 42
    by = lambda k: [r for u, r in got.items() if int(u.rsplit("/", 1)[1]) % 6 == k]
    assert all(r["html"].startswith("Straße") and r["charset"] == "utf-8" for r in by(0)) and all(r["html"].startswith("café") and r["charset"] == "cp1252" for r in by(1))
    assert all("дата" in r["html"] and r["charset"] == "cp1251" for r in by(2)) and all(r["blocked"] and r["error"] == "blocked by the site" and r["html"] is None for r in by(3))
    assert all(r["error"] == "HTTP 503" for r in by(4)) and all(r["error"] == "OSError: no route" and not r["blocked"] for r in by(5))
    calls = sorted(asked(seen), key=lambda x: x[1])
    assert len(calls) == 42
    for site in range(7):  # one request at a time
        own = [c for c in calls if f"//h{site}." in c[0]]
        assert all(a[2] <= b[1] for a, b in zip(own, own[1:], strict=False))
    assert any(a[2] > b[1] for a, b in zip(calls, calls[1:], strict=False))  # but sites side by side
    assert pages.site_of("HTTP://A.b:80/x") == spark.range(1).select(pages.site(F.lit("HTTP://A.b:80/x"))).first()[0] == "a.b:80"
    with pytest.raises(Exception, match="fetcher is missing"):
        spark.read.format("pages").load(str(tmp_path / "dealt")).collect()


@pytest.mark.parametrize("html", ["Access Denied", "just a moment " * 300, "", "all is well"])
def test_refusals_agree(spark, html):
    assert pages.refused(html) == spark.range(1).select(text.blocked(F.lit(html))).first()[0]


def test_undecodable_bytes():
    assert pages.decoded(b"a\xff", "utf-8") == ("a�", "utf-8") and pages.decoded(b"\x81x", None)[0].endswith("x") and pages.decoded(b"", "no such set") == ("", "utf-8")


def _organisations(spark, n):
    return spark.createDataFrame([(i, f"Org {i}", f"http://s{i}.example/{i * 6}", "UK", "Tax") for i in range(n)], "ord int, organizer string, url string, country string, category string")


def _events(whole):
    rows = whole.where("html is not null").select(F.col("url").alias("source_url"), F.explode(F.sequence(F.lit(0), (F.col("nth") % 3).cast("int"))).alias("i"))
    return rows.select("source_url", F.concat_ws(" ", F.lit("Event"), "i").alias("event_name"))


def _counting(folder, fail_at=None):
    state = {"die": fail_at}

    def get(url):
        n = int(url.rsplit("/", 1)[1]) // 6
        (folder / f"{n}-{uuid.uuid4().hex}").touch()
        if n == 4:
            return {"status": 500}
        return {"html": "page " * 200, "status": 200}

    def extract(whole):
        if state["die"] is not None and whole.where(F.col("nth") == state["die"]).count():
            state["die"] = None
            raise OSError("killed")
        return _events(whole)

    return get, extract


def test_a_killed_run_goes_on(spark, tmp_path):
    seen = tmp_path / "asked"
    seen.mkdir()
    folder = str(tmp_path / "run")
    get, extract = _counting(seen, fail_at=7)
    with pytest.raises(Exception, match="killed"):
        gather.run(spark, _organisations(spark, 13), folder, get, extract, batch=3, pause=0)
    assert run_state.progress(spark, folder)["status"] == "crashed" and not snapshots.versions(spark, f"{folder}/counts")
    asked_before = len(list(seen.iterdir()))
    assert 0 < asked_before < 13
    assert gather.run(spark, _organisations(spark, 13), folder, get, extract, batch=3, pause=0) == "done"
    by_site = [p.name.split("-")[0] for p in seen.iterdir()]
    assert sorted(map(int, by_site)) == list(range(13))  # no site twice
    counts = {r["url"]: r for r in snapshots.latest(spark, f"{folder}/counts").collect()}
    assert len(counts) == 13 and sum(r["events"] for r in counts.values()) == sum(i % 3 + 1 for i in range(13) if i != 4) and counts["http://s4.example/24"]["error"] == "HTTP 500"
    told = run_state.progress(spark, folder)
    assert told["status"] == "done" and told["total_batches"] == 5 and not os.path.exists(f"{folder}/lease.json")


def test_a_run_stops_between_batches(spark, tmp_path):
    seen = tmp_path / "asked"
    seen.mkdir()
    folder = str(tmp_path / "run")
    get, extract = _counting(seen)

    def stopping(whole):
        if whole.where("nth = 4").count():
            run_state.want_stop(spark, folder)
        return extract(whole)

    assert gather.run(spark, _organisations(spark, 9), folder, get, stopping, batch=3, pause=0) == "stopped"
    told = run_state.progress(spark, folder)
    assert told["status"] == "stopped" and told["processed"] == 6 and told["failures"] == 1 and told["batches"] == 2 and not os.path.exists(f"{folder}/counts")
    assert gather.run(spark, _organisations(spark, 9), folder, get, extract, batch=3, pause=0) == "done"
    assert len(list(seen.iterdir())) == 9
    assert gather.run(spark, _organisations(spark, 9), folder, get, extract, batch=3, pause=0) == "done"  # a new run begins at the top


def test_one_run_at_a_time(spark, tmp_path):
    folder, now = str(tmp_path / "run"), [1000.0]
    first = run_state.Run(spark, folder, clock=lambda: now[0])
    now[0] += 19
    with pytest.raises(run_state.RunActive):
        run_state.Run(spark, folder, clock=lambda: now[0])
    first.beat(processed=3)
    now[0] += 19
    with pytest.raises(run_state.RunActive):
        run_state.Run(spark, folder, clock=lambda: now[0])
    now[0] += 2
    second = run_state.Run(spark, folder, clock=lambda: now[0])  # nobody renewed it
    with pytest.raises(run_state.RunActive):
        first.beat()
    first.close("crashed")
    assert run_state.progress(spark, folder)["status"] == "running"
    second.close("done")
    (tmp_path / "run" / "lease.json").write_text('{"holder')  # half a file
    run_state.Run(spark, folder).close("done")
    assert run_state.progress(spark, folder)["status"] == "done"


def test_counts_come_from_the_pass_that_writes(spark, tmp_path):
    tracker, group = spark.sparkContext.statusTracker(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        got = gather.counted(spark.range(0, 1000, 1, 4), str(tmp_path / "t"), n=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1), most=F.max("id"))
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == {"n": 1000, "odd": 500, "most": 999} and jobs == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000
    none = gather.counted(spark.range(0), str(tmp_path / "none"), n=F.count(F.lit(1)))
    assert none["n"] == 0


def test_fetching_mends_character_sets(spark):
    urls = spark.createDataFrame([("http://a.example/1",), ("http://a.example/2",)], "url string")
    answers = {"1": {"content": "é".encode("cp1252") * 3, "status": 200}, "2": {"html": "Are you a human?", "status": 200}}
    got = {r["url"][-1]: r for r in fetch.many(urls, lambda u: answers[u[-1]], pause=0).collect()}
    assert got["1"]["html"] == "ééé" and got["2"]["html"] is None and got["2"]["error"] == "blocked by the site"
