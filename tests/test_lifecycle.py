import datetime as dt


from eventfold.functions import extract
from eventfold.operators import lifecycle, master, report
from eventfold.plans import digest, jobs
from eventfold.sources import review, sheets, snapshots
from eventfold.streaming import grace

TODAY = dt.date(2026, 9, 24)
KEPT = "ord int, bucket string, event_id string, event_name string, organizer string, date string, register_link string, source_url string, last_seen string, locked string"


def kept(spark):
    own = "https://o.example/"
    rows = [
        (1, "verified", "a", "Old Day", "Org", "01-May-2026", own + "a", own, "", ""), (2, "verified", "b", "Lost Day", "Org", "01-Nov-2026", own + "b", own, "01-Sep-2026", ""),
        (3, "verified", "c", "Fresh Day", "Org", "01-Nov-2026", own + "c", own, "20-Sep-2026", ""), (4, "verified", "d", "Locked Day", "Org", "01-May-2026", own + "d", own, "", "yes"),
        (5, "verified", None, "Legacy Day", "Org", None, "", own, None, None), (6, "verified", "c", "Fresh Day 2", "Org", "02-Nov-2026", own + "e", own, "", ""),
        (7, "review", "b", "Lost Day before", "Org", "", "", "", "", ""), (8, "verified", "e", "", "Org", "", "", "", "", ""), (9, "past", "a", "Old Day before", "Org", "", "", "", "", ""),
        (10, "verified", "f", "Seen Day", "Org", "01-Nov-2026", own + "f", own, "01-Sep-2026", ""),
    ]
    return lifecycle.load(spark.createDataFrame(rows, KEPT), TODAY)


def test_load(spark):
    got = {r["ord"]: r for r in kept(spark).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, 9, 10}  # the row without a name goes
    assert got[5]["event_id"].startswith("ev_") and got[5]["verified_by"] == "Legacy (before v2)" and got[5]["last_seen"] == got[5]["added_on"] == "24-Sep-2026"
    assert (got[3]["event_id"], got[6]["event_id"], got[9]["event_id"]) == ("c", "c~2", "a") and got[1]["verified_by"] == "" and got[1]["review_reason"] == ""


def test_time_moves_rows(spark, tmp_path):
    seen = spark.createDataFrame([("f",)], "event_id string")
    sites = spark.createDataFrame([("https://o.example/", "ok")], "source_url string, status string")
    aged = lifecycle.age(kept(spark), seen, sites, TODAY)
    got = {r["ord"]: (r["bucket"], r["outcome"]) for r in aged.collect()}
    # 1 and 2 take the places of 9 and 7, which have their ids
    assert got == {1: ("past", "past"), 2: ("review", "missing"), 3: ("verified", "kept"), 4: ("verified", "kept"), 5: ("verified", "kept"), 6: ("verified", "kept"), 10: ("verified", "kept")}
    row = aged.where("ord = 2").first()
    assert row["review_reason"] == "Not found on its website since 01-Sep-2026" and aged.where("ord = 1").first()["status"] == "Past"
    log = lifecycle.log_of_ageing(aged, "now")
    assert {(r["event_id"], r["action"], r["source"]) for r in log.collect()} == {("a", "moved to Past Events", "date passed"), ("b", "sent to Needs Review", "not on website")}
    path = str(tmp_path / "m")
    assert lifecycle.read(spark, path) == (None, None)
    lifecycle.save(aged.drop("outcome"), log, path)
    lifecycle.save(aged.drop("outcome"), log, path)
    rows, entries = lifecycle.read(spark, path)
    assert rows.count() == 7 and entries.count() == 4 and snapshots.versions(spark, f"{path}/master") == [0, 1] and set(entries.columns) == set(lifecycle.LOG)


def test_log_of_records(spark):
    rows = kept(spark)
    cells = ", ".join(f"{c} string" for c in master.CELLS if c not in ("date", "event_name"))
    blank = [""] * (len(master.CELLS) - 2)
    said = [(1, "c", "verified", "Fresh Day", "03-Nov-2026", True, "l", "", *blank), (2, "n", "verified", "New Day", "01-Dec-2026", True, "l", "", *blank), (3, "b", "rejected", "Lost Day", "", True, "l", "junk", *blank)]
    records = spark.createDataFrame(said, f"ord int, event_id string, status string, event_name string, date string, changed boolean, link string, reason string, {cells}")
    decided = master.decide(records, rows)
    got = {(r["event_id"], r["action"], r["field"], r["old_value"], r["new_value"]) for r in lifecycle.log_of_records(decided, rows, "now").collect()}
    assert got == {("c", "updated", "date", "01-Nov-2026", "03-Nov-2026"), ("n", "added", "", "", ""), ("b", "rejected", "", "", "junk")}
    none = lifecycle.age(rows.limit(0), spark.createDataFrame([], "event_id string"), spark.createDataFrame([], "source_url string, status string"), TODAY)
    assert {r["action"]: r["n"] for r in lifecycle.counters(decided, none).collect()} == {"updated": 1, "added": 1, "rejected": 1}


def test_raw_sheets(spark, tmp_path):
    raw = spark.createDataFrame([(1, "5 October 2026", " Tax  Day ", None), (2, "1 May 2026", "Law Day", "Past"), (3, "", "Open Day", ""), (4, "1 May 2025", "Old Day", ""), (5, "x", " ", "")], "ord int, date string, event_name string, status string")
    assert [(r["ord"], r["status"], r["organizer"]) for r in sheets.refreshed(raw, TODAY).collect()] == [(2, "Past", ""), (1, "Upcoming", ""), (3, "Upcoming", ""), (5, "Upcoming", "")]
    assert {(r["ord"], r["event_name"]) for r in sheets.upcoming(raw).collect()} == {(1, "Tax Day"), (3, "Open Day"), (4, "Old Day")}
    path = str(tmp_path / "failed")
    assert snapshots.failures(spark.createDataFrame([("Org", "u", "a,\n\"b\""), ("Fine", "v", "")], "organizer string, url string, error string"), path)
    assert sheets.failed(spark, path).count() >= 1
    pages = spark.createDataFrame([("s", 2, "l", "Tax day", "d"), ("s", 1, "l", "Tax Day", "D"), ("s", 2, "l", "Law Day", "d")], "source_url string, page int, link string, event_name string, date string")
    assert {(r["page"], r["event_name"]) for r in sheets.of_organisation(pages).collect()} == {(1, "Tax Day"), (2, "Law Day")}


def test_surroundings_of_dates():
    part = '<section><h3>Day {0}</h3><p>on <b>{0} October 2026</b></p><a href="/e/{0}">Details</a></section>'
    html = "<body><main>" + "".join(part.format(i) for i in range(1, 6)) + "</main></body>"
    got = extract.events_by_shape(html, "https://o.example/")
    assert [(e["name"], e["date"], e["link"]) for e in got] == [(f"Day {i}", f"{i} October 2026", f"https://o.example/e/{i}") for i in range(1, 6)]
    card = '<li class="e"><a href="/e/{0}">Conference number {0}</a> 5 October 2026</li>'
    both = "<body><ul>" + card.format(1) + card.format(2) + card.format(2) + "</ul></body>"
    assert [e["link"] for e in extract.events_by_shape(both, "https://o.example/")] == ["https://o.example/e/1", "https://o.example/e/2"]
    assert extract.events_by_shape(None, "") == [] and extract.events_by_shape("<p>no day</p>", "") == []


def test_messages(spark):
    evidence = "struct<value: string, match: string, reason: string, source: string, confidence: string>"
    cell = lambda v, c="high": (v, v, "", "meta", c)
    df = spark.createDataFrame([(cell("Register", "low"), cell("someday"), None, cell("Tokyo"), None, "Tax", "register")], ", ".join(f"{c} {evidence}" for c in ("name", "date", "end_date", "location", "format")) + ", category string, page string")
    codes = df.withColumn("codes", report.failures(TODAY))
    assert codes.select(report.messages(codes["codes"]).alias("m")).first()["m"] == [
        "title 'Register' is a generic label, not an event name", "title only came from a meta (low confidence)", "date 'someday' could not be found on the event page",
        "location 'Tokyo' could not be found on the event page", "date 'someday' is not a real date", "location 'Tokyo' is in a country we don't track",
    ]


class Busy(Exception):
    code = 503


def test_asking(spark, tmp_path):
    book = str(tmp_path / "calls")

    def call(prompt):
        with open(book, "a") as f:
            f.write(prompt + "\n")
        if prompt == "busy" and open(book).read().count("busy") < 3:
            raise Busy
        if prompt == "bad":
            raise ValueError("no")
        return {"answer": prompt.upper(), "tokens_in": 1_000_000, "tokens_out": 0}

    rows = spark.createDataFrame([(1, "busy"), (2, "bad"), (3, "fine")], "id int, prompt string").coalesce(1)
    got = {r["id"]: (r["answer"], r["error"]) for r in review.ask(rows, call, pause=0).collect()}
    assert got == {"1": ("BUSY", None), "2": (None, "ValueError: no"), "3": ("FINE", None)} and open(book).read().count("bad") == 1
    many = spark.createDataFrame([(i, f"p{i}.") for i in range(10)], "id int, prompt string")
    out = {int(r["id"]): (r["error"], r["cost"]) for r in review.ask_within(many, call, cap=1.0, price_in=0.25, price_out=1.5, at_once=3, pause=0).collect()}
    assert out == {i: (None, 0.25) if i < 6 else ("budget", 0.0) for i in range(10)} and open(book).read().count("p0.") == 1
    assert review.ask_within(many.limit(0), call, cap=1.0, price_in=1, price_out=1, at_once=3).count() == 0


def test_from_rows(spark, tmp_path):
    book = str(tmp_path / "calls")
    page = "<body><main><h1>{0}</h1><p>Date: {1}</p><p>Venue: London</p></main></body>"
    pages = {"https://o.example/vat": page.format("VAT Update Day", "5 October 2026"), "https://o.example/old": page.format("Tax Law Day", "5 May 2026"), "https://o.example/none": page.format("VAT Open Day", "soon")}

    def fetcher(url):
        with open(book, "a") as f:
            f.write(url + "\n")
        if url in pages:
            return {"html": pages[url], "status": 200}
        return {"status": 404 if url.endswith("gone") else 500}

    home = "https://o.example/list"
    names = [("VAT", "https://o.example/vat"), ("Old", "https://o.example/old"), ("Open", "https://o.example/none"), ("Gone", "https://o.example/gone"), ("Down", "https://o.example/down"), ("List", home), ("Twice", "https://o.example/t"), ("Two", "https://o.example/t"), ("Bare", "")]
    raw = spark.createDataFrame([(i, n, "Org", link, home) for i, (n, link) in enumerate(names)], "ord int, event_name string, organizer string, link string, source_url string")
    none = spark.createDataFrame([], "event_id string, fingerprint string, status string")
    got = {r["ord"]: r for r in jobs.from_rows(raw, fetcher, none, "India", TODAY, pause=0).collect()}
    assert {i: (r["status"], r["attempts"]) for i, r in got.items()} == {
        0: ("verified", 0), 1: ("past", 0), 2: ("needs_review", 2), 3: ("unreachable", 0), 4: ("unreachable", 2), 5: ("shared_page", 0), 6: ("shared_page", 0), 7: ("shared_page", 0), 8: ("needs_review", 0),
    }
    told = open(book).read()
    assert (told.count("/vat"), told.count("/none"), told.count("/gone"), told.count("/down"), told.count("/t\n")) == (1, 3, 1, 3, 0) and got[0]["country"] == "UK"
    state = spark.createDataFrame([(got[0]["event_id"], got[0]["fingerprint"], "kept"), (got[4]["event_id"], "f", "kept before")], "event_id string, fingerprint string, status string")
    again = {r["ord"]: (r["status"], r["changed"]) for r in jobs.from_rows(raw, fetcher, state, "India", TODAY, pause=0).collect()}
    assert again[0] == ("kept", False) and again[4] == ("kept before", False) and again[1] == ("past", True)


def test_checked(spark):
    sites = spark.createDataFrame([("UK", "a", "ok"), ("UK", "b", "failed"), ("SG", "c", "ok")], "country string, source_url string, status string")
    records = spark.createDataFrame([("UK", "verified", [], 1), ("UK", "needs_review", ["date 'x' bad", "no title"], 0), ("UK", "needs_review", ["date 'y' bad"], 0)], "country string, status string, reasons array<string>, attempts int")
    got = {r["country"]: r for r in digest.checked(sites, records, top=1).collect()}
    assert (got["UK"]["sites_failed"], got["UK"]["verified"], got["UK"]["fixed_by_retry"], got["UK"]["reasons"]) == (1, 1, 1, [(2, "date ... bad")])
    assert (got["SG"]["events"], got["SG"]["reasons"]) == (0, [])


def test_streams_of_fingerprints_and_late_cells(spark, tmp_path):
    kinds = "event_id string, fingerprint string, date string, ts timestamp"
    at = lambda h: dt.datetime(2026, 9, 1, h)
    source, sink, table = (str(tmp_path / x) for x in ("in", "out", "table"))

    def run():
        stream = spark.readStream.schema(kinds).parquet(source)
        grace.changed(stream).writeStream.format("parquet").option("path", sink).option("checkpointLocation", sink + "-c").trigger(availableNow=True).start().awaitTermination()
        stream.writeStream.foreachBatch(grace.fill_into(table, "event_id", "ts")).option("checkpointLocation", table + "-c").trigger(availableNow=True).start().awaitTermination()

    spark.createDataFrame([("a", "1", "", at(1)), ("b", "1", "d", at(1)), ("a", "2", "", at(2))], kinds).coalesce(1).write.parquet(source)
    run()
    spark.createDataFrame([("a", "2", "05-Oct-2026", at(3)), ("b", "2", "", at(3)), ("b", "9", "", at(0))], kinds).coalesce(1).write.mode("append").parquet(source)
    run()
    assert {(r["event_id"], r["fingerprint"], r["fate"]) for r in spark.read.parquet(sink).collect()} == {("a", "2", "new"), ("b", "1", "new"), ("b", "2", "changed")}
    assert {(r["event_id"], r["date"], r["ts"].hour) for r in snapshots.latest(spark, table).collect()} == {("a", "05-Oct-2026", 3), ("b", "d", 3)}


def test_what_moves_is_worked_out_once(spark):
    """Ageing joins links, records and sites once each, and meets the rows in one more join."""
    rows = spark.createDataFrame([(1, "verified", "a", "A")], "ord long, bucket string, event_id string, event_name string")
    seen, sites = spark.createDataFrame([("b",)], "event_id string"), spark.createDataFrame([("s", "ok")], "source_url string, status string")
    today = dt.date(2026, 9, 24)
    loaded = spark.createDataFrame(lifecycle.load(rows, today).rdd, lifecycle.load(rows, today).schema)
    aged = lifecycle.age(loaded, seen, sites, today)
    assert aged._jdf.queryExecution().analyzed().toString().count("Join ") == 4 and aged.count() == 1
