import datetime as dt
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventfold.functions import dates, fixed, taxonomy, text, titles
from eventfold.operators import dedupe, master, merge, report
from eventfold.sources import fetch, organisations, snapshots
from eventfold.streaming import grace


def col(spark, f, values):
    rows = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)], "i int, " + ", ".join(f"c{j} string" for j in range(len(values[0]) if isinstance(values[0], tuple) else 1)))
    cols = [F.col(c) for c in rows.columns[1:]]
    return [r[0] for r in rows.orderBy("i").select(f(*cols)).collect()]


def test_urls(spark):
    assert col(spark, text.normalize_url, [" HTTPS://WWW.A.example/Path/?q=1#x", "http://a.example", None, "", "https://u@b.example:8080//"]) == ["a.example/Path?q=1", "a.example", "", "", "u@b.example:8080"]
    assert col(spark, text.same_page, [("http://a/x/?y", "HTTP://a/x#z"), ("http://a/x", "http://a/y")]) == [True, False]
    assert col(spark, text.valid_href, ["/x", "#", "MAILTO:x", None, " "]) == [True, False, False, False, False]


def test_white_space_of_all_kinds(spark):
    assert col(spark, text.squeeze, [" a   b\n"]) == ["a b"]


def test_event_ids_follow_the_page(spark):
    f = lambda link, name: text.event_id(F.lit("Org"), name, link, F.lit("http://a/list"), F.lit("1 May"))
    a, b, c, d = col(spark, f, [("http://a/1", "x"), ("https://www.a/1/#t", "y"), ("http://a/list/", "Tax: Day!"), ("", "tax day")])
    assert a == b and c == d and a != c and len(a) == 15


def test_titles(spark):
    assert col(spark, titles.junk_title, ["Read more »", " 12 ", "Tax Day"]) == [True, True, False]
    assert col(spark, titles.generic_title, ["Upcoming Events", "All conferences archive", "Become a member", "Summer tax events", "VAT", "Tax Day"]) == [True, True, True, True, True, False]


def test_phrases():
    import re

    m = lambda p, t: bool(re.search(taxonomy.pattern(p), t, re.I))
    assert m("tax", "Taxes") and not m("tax", "Taxonomy") and m("cross-border tax", "Cross border  tax") and m("mergers and acquisitions", "mergers & acquisitions") and m("arbitrat*", "arbitrators")


def test_dates_in_text(spark):
    got = col(spark, dates.stated, ["On 10/11/2026, 13/14/2026, 2/25/2026 and 3 May 2026", "May 5 to 7, 2026", None, "31 Sept 2026"])
    d = dt.date
    assert got == [[d(2026, 2, 25), d(2026, 5, 3), d(2026, 11, 10)], [d(2026, 5, 5)], [], []]


def test_keep_fullest_first_of_equals(spark):
    df = spark.createDataFrame([(1, "k", "", "x"), (2, "k", "y", "x"), (3, "k", "z", "w"), (4, None, None, None)], "ord int, k string, a string, b string")
    assert sorted(r["ord"] for r in dedupe.keep_fullest(df, ["k"], ["ord"], ["a", "b"]).collect()) == [2, 4]


def test_suffixes_pass_over_taken_ones(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x~2"), (4, "x")], "ord int, event_id string")
    assert {r["ord"]: r["event_id"] for r in dedupe.suffix_ids(df, "event_id", ["ord"]).collect()} == {1: "x", 2: "x~3", 3: "x~2", 4: "x~4"}


def test_upsert_repairs_a_dayless_row_once(spark):
    kinds = "ord int, event_name string, date string, event_date date, location string"
    d = dt.date
    old = spark.createDataFrame([(1, "A", "May 2026", None, ""), (2, "B", "1 May 2026", d(2026, 5, 1), "x")], kinds)
    new = spark.createDataFrame([(10, "a ", "5 May 2026", d(2026, 5, 5), "Leeds"), (11, "A", "6 May 2026", d(2026, 5, 6), "York"), (12, "B", "1 may 2026", d(2026, 5, 1), "y"), (13, "C", "1 May 2020", d(2020, 5, 1), "")], kinds)
    got = {r["ord"]: (r["action"], r["date"], r["location"]) for r in merge.raw_upsert(old, new, cutoff=d(2026, 1, 1), today=d(2026, 1, 1), fill=("location",)).collect()}
    assert got == {1: ("repaired", "5 May 2026", "Leeds"), 2: ("kept", "1 May 2026", "x"), 11: ("added", "6 May 2026", "York")}


def _master(spark, rows):
    cols = "event_id string, bucket string, " + ", ".join(f"{c} string" for c in master.CELLS) + ", added_on string, last_seen string, verified_by string, locked string"
    full = [(e, b, *[v.get(c, "") for c in master.CELLS], "d0", "d0", v.get("by", "Rules"), v.get("locked", "")) for e, b, v in rows]
    return spark.createDataFrame(full, cols)


def _records(spark, rows):
    cols = "ord int, event_id string, status string, changed boolean, " + ", ".join(f"{c} string" for c in master.CELLS)
    return spark.createDataFrame([(i, e, s, ch, *[v.get(c, "") for c in master.CELLS]) for i, (e, s, ch, v) in enumerate(rows)], cols)


def test_master_rules(spark):
    held = _master(
        spark,
        [
            ("u", "verified", {"event_name": "U", "date": "1", "location": "old"}), ("l", "verified", {"event_name": "L", "locked": "Yes", "location": "kept"}),
            ("r", "review", {"event_name": "R", "date": "2"}), ("g", "verified", {"event_name": "Legacy", "date": "3", "organizer": "first", "by": "Legacy (before v2)"}), ("p", "past", {"event_name": "P"}),
        ],
    )
    told = _records(
        spark,
        [
            ("u", "verified", True, {"event_name": "U", "date": "1", "location": ""}), ("l", "rejected", True, {"event_name": "L"}), ("r", "verified", True, {"event_name": "R", "location": "new"}),
            ("g2", "verified", False, {"event_name": "legacy", "date": "3", "organizer": "second"}), ("n", "verified", True, {"event_name": "N", "date": "9"}), ("n2", "verified", True, {"event_name": "n", "date": "9"}),
            ("x", "rejected", True, {"event_name": "X"}), ("q", "needs_review", True, {"event_name": "Q"}),
        ],
    )
    actions = {r["event_id"]: (r["action"], r["target"]) for r in master.decide(told, held).collect()}
    assert {k: v[0] for k, v in actions.items()} == {"u": "updated", "l": "locked_skipped", "r": "promoted", "g2": "legacy_replaced", "n": "added", "n2": "duplicates_skipped", "x": "rejected", "q": "sent_to_review"}
    assert actions["g2"][1] == "g" and actions["n2"][1] == "n"
    got = {r["event_id"]: r for r in master.apply(told, held, F.lit("d1")).collect()}
    assert {k: r["bucket"] for k, r in got.items()} == {"u": "verified", "l": "verified", "r": "verified", "g2": "verified", "n": "verified", "x": "rejected", "q": "review", "p": "past"}
    assert got["u"]["location"] == "old" and got["r"]["location"] == "new" and got["g2"]["organizer"] == "first" and got["g2"]["verified_by"] == "Rules" and got["l"]["location"] == "kept"


def _plain_run(told, held):
    """Records one after another. held: dicts with id and bucket; told: dicts with ord, id, status, changed, reason and cells."""
    rows = {(r["event_id"], r["bucket"]): dict(r) for r in held}
    ids = {t["event_id"] for t in told}
    key = lambda r: (r["event_name"].lower(), r["date"].lower())
    verified = sorted((r["event_id"], r) for r in held if r["bucket"] == "verified")
    had = {r["event_id"] for r in held if r["bucket"] in ("verified", "review")}
    locked = {r["event_id"] for _, r in verified if r["locked"] == "Yes"}
    came = [t for t in told if t["status"] == "verified" and t["event_id"] not in locked and key(t) != ("", "") and (t["changed"] or t["event_id"] not in had)]
    for t in told:
        e, s = t["event_id"], t["status"]
        new = {c: t[c] for c in master.CELLS if t[c]}
        v, r = rows.get((e, "verified")), rows.get((e, "review"))
        if s == "past":
            if v:
                v["last_seen"] = "d1"
            continue
        if v and e in locked:
            continue
        whole = lambda base, by: {**dict.fromkeys(held[0], ""), **(base or {}), **new, "event_id": e, "status": "Upcoming", "added_on": "d1", "last_seen": "d1", "verified_by": by, "locked": "", "review_reason": "", "reject_reason": ""}
        if s == "verified":
            if v:
                v["last_seen"] = "d1"
                cells = {c: x for c, x in new.items() if c in fixed.UPDATABLE and x != v[c]}
                if t["changed"] and cells:
                    v.update(cells, verified_by="Rules")
                continue
            if r:
                del rows[e, "review"]
                rows[e, "verified"] = {**whole(r, "Rules"), "bucket": "verified", "added_on": r["added_on"], "ai_review": ""}
                continue
            other = next((o for i, o in verified if i != e and key(o) == key(t)), None) if key(t) != ("", "") else None
            earlier = [x for x in came if key(x) == key(t) and x["ord"] < t["ord"] and x["event_id"] != e]
            first = min((x["ord"] for x in came if key(x) == key(t) and x["event_id"] not in had), default=None)
            if other and other["verified_by"].startswith("Legacy") and other["locked"] != "Yes" and other["event_id"] not in ids and not earlier and first == t["ord"]:
                row = rows.pop((other["event_id"], "verified"))
                rows[e, "verified"] = {**row, **{c: x for c, x in new.items() if c in fixed.UPDATABLE}, "event_id": e, "last_seen": "d1", "verified_by": "Rules"}
            elif not other and not earlier:
                rows[e, "verified"] = {**whole(None, "Rules"), "bucket": "verified"}
        elif s == "needs_review":
            if v:
                v["last_seen"] = "d1"
                continue
            rows[e, "review"] = {**whole(r, ""), "bucket": "review", "review_reason": t["reason"], "added_on": r["added_on"] if r else "d1", "ai_review": r["ai_review"] if r and not t["changed"] else ""}
        elif s == "rejected":
            base = rows.pop((e, "verified"), None) or rows.pop((e, "review"), None)
            rows[e, "rejected"] = {**whole(base, ""), "bucket": "rejected", "reject_reason": t["reason"], "ai_review": ""}
    return sorted(tuple(sorted(r.items())) for r in rows.values())


@pytest.mark.parametrize("seed", range(4))
def test_records_of_an_id_follow_one_another(spark, seed):
    r = random.Random(seed)
    ids = [f"e{i}" for i in range(70)]
    cell = lambda c: r.choice({"event_name": ["Gala", "gala", "Summit", "Day", ""], "date": ["1", "2", ""]}.get(c, ["", f"{c}{r.randint(0, 3)}"]))
    held = []
    for e in ids:
        buckets = r.choice([[], ["verified"], ["verified"], ["review"], ["past"], ["rejected"], ["verified", "review"], ["verified", "rejected", "past"]])
        for b in buckets:
            own = {c: cell(c) for c in master.CELLS} | {"event_name": f"{r.choice(['Gala', 'Summit', 'Own'])}", "date": str(r.randint(1, 9))}
            kept = {"added_on": "d0", "last_seen": "d0", "verified_by": r.choice(["Rules", "Legacy (before v2)"]) if b == "verified" else "", "locked": r.choice(["", "", "", "Yes"]) if b == "verified" else "", "status": "Old"}
            said = {"review_reason": "why" if b == "review" else "", "ai_review": "note" if b == "review" else "", "reject_reason": "because" if b == "rejected" else ""}
            held.append({"event_id": e, "bucket": b} | own | kept | said)
    told = []
    for o in range(260):
        told.append({"ord": o, "event_id": r.choice(ids[:50] if o % 3 else ids[:8]), "status": r.choice(["verified", "verified", "needs_review", "rejected", "past", "unreachable"]), "changed": r.random() < 0.7, "reason": f"r{o}"} | {c: cell(c) for c in master.CELLS})
    records = spark.createDataFrame(told, "ord int, event_id string, status string, changed boolean, reason string, " + ", ".join(f"{c} string" for c in master.CELLS))
    rows = spark.createDataFrame(held, ", ".join(f"{c} string" for c in held[0]))
    got = sorted(tuple(sorted(x.asDict().items())) for x in master.apply(records, rows, F.lit("d1")).collect())
    assert got == _plain_run(told, held)


def test_no_row_is_lost_between_records(spark):
    held = _master(spark, [("v", "verified", {"event_name": "V", "date": "1", "organizer": "o", "source_url": "s"})])
    pairs = [("a", "verified", "verified"), ("b", "needs_review", "verified"), ("c", "verified", "needs_review"), ("d", "rejected", "verified"), ("f", "needs_review", "rejected"), ("v", "verified", "past")]
    told = _records(spark, [(e, s, True, {"event_name": e, "date": "5", "location": f"{i}", "organizer": "new"}) for e, *both in pairs for i, s in enumerate(both)])
    actions = {(r["event_id"], r["location"]): r["action"] for r in master.decide(told, held).collect()}
    assert [actions["a", "0"], actions["a", "1"], actions["b", "0"], actions["b", "1"], actions["c", "0"], actions["c", "1"]] == ["added", "updated", "sent_to_review", "promoted", "added", "kept_after_failed_rescrape"]
    got = {(r["event_id"], r["bucket"]): r for r in master.apply(told, held, F.lit("d1")).collect()}
    assert set(got) == {("a", "verified"), ("b", "verified"), ("c", "verified"), ("d", "verified"), ("d", "rejected"), ("f", "rejected"), ("v", "verified")}
    assert got["v", "verified"]["organizer"] == "o" and got["v", "verified"]["location"] == "0" and got["a", "verified"]["location"] == "1" and got["c", "verified"]["location"] == "0"
    none = _records(spark, []), _master(spark, [])
    assert master.apply(*none, F.lit("d1")).count() == 0 and master.apply(none[0], held, F.lit("d1")).count() == 1 and master.apply(told, none[1], F.lit("d1")).count() == 7


def test_grace_and_health(spark):
    d = dt.date
    cols = "event_id string, link string, source_url string, start_date date, end_date date, last_seen date, locked string"
    far = d(2027, 1, 1)
    rows = [("a", "http://x/a", "s1", far, None, d(2026, 9, 1), ""), ("b", "http://x/b", "s1", far, None, d(2026, 9, 20), ""), ("c", "http://x/c", "s2", far, None, d(2026, 1, 1), ""), ("d", "http://x/d", "s1", d(2026, 1, 1), d(2026, 12, 1), d(2026, 1, 1), "yes"), ("e", "http://x/s", "s1", far, None, d(2026, 1, 1), ""), ("f", "http://x/s", "s1", far, None, d(2026, 1, 1), ""), ("g", "", "s1", d(2026, 1, 1), None, None, "")]
    sites = spark.createDataFrame([("s1", "ok"), ("s2", "failed")], "source_url string, status string")
    got = report.missing_and_past(spark.createDataFrame(rows, cols), spark.createDataFrame([], "event_id string"), sites, d(2026, 9, 24)).collect()
    assert {r["event_id"]: r["outcome"] for r in got} == {"a": "missing", "b": "kept", "c": "kept", "d": "kept", "e": "kept", "f": "kept", "g": "past"}


def test_headers(spark):
    assert organisations.mapping(["No", "Organisation / Website", "Focus area", "Events page"]) == {"organizer": "Organisation / Website", "category": "Focus area", "url": "Events page"}
    with pytest.raises(ValueError, match="url"):
        organisations.read(spark.createDataFrame([("x",)], "name string"))


def test_fetching_in_two_tiers(spark, tmp_path):
    urls = spark.createDataFrame([(f"http://h{i % 2}.example/{i}",) for i in range(8)] * 2, "url string")

    def cheap(url):
        n = int(url[-1])
        if n == 0:
            raise OSError("no route")
        return {"status": 404} if n == 1 else {"html": "short"} if n == 2 else {"html": "word " * 200, "status": 200}

    asked = tmp_path / "asked"
    asked.mkdir()

    def told(tier, fetcher):
        def f(url):
            (asked / f"{tier}-{uuid.uuid4().hex}").touch()
            return fetcher(url)

        return f

    pages = fetch.two_tiers(urls, told("cheap", cheap), told("dear", lambda u: {"html": "browser " * 100, "status": 200}), pause=0)
    assert pages.count() == 8
    got = {r["url"][-1]: r for r in pages.collect()}
    assert Counter(p.name.split("-")[0] for p in asked.iterdir()) == {"cheap": 8, "dear": 2}  # each page once, however often the result is read
    assert len(got) == 8 and got["1"]["error"] == "HTTP 404" and got["0"]["html"].startswith("browser") and got["2"]["html"].startswith("browser") and got["3"]["html"].startswith("word")


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert snapshots.latest(spark, path) is None
    for i in range(4):
        snapshots.write(spark.range(i + 1), path)
    assert snapshots.latest(spark, path).count() == 4 and snapshots.versions(spark, path) == [2, 3]


def test_stream_of_sightings(spark, tmp_path):
    stream = lambda name: spark.readStream.schema("event_id string, ts timestamp").parquet(str(tmp_path / name))
    for day, ids in (("2024-01-01", ["a", "b"]), ("2024-01-10", ["b"]), ("2024-02-01", ["c"]), ("2024-02-20", ["d"])):
        spark.createDataFrame([(i, dt.datetime.fromisoformat(day)) for i in ids], "event_id string, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = grace.unseen(stream("in")).writeStream.format("memory").queryName("unseen").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {"a", "b"} <= {r["event_id"] for r in spark.table("unseen").collect()} and "d" not in {r["event_id"] for r in spark.table("unseen").collect()}
    q = stream("in").writeStream.foreachBatch(grace.upsert_into(str(tmp_path / "out"), "event_id", "ts")).option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r["event_id"]: r["ts"].month for r in snapshots.latest(spark, str(tmp_path / "out")).collect()} == {"a": 1, "b": 1, "c": 2, "d": 2}


def test_strict_dates_are_those_of_the_parser(spark):
    r, today = random.Random(11), dt.date(2026, 9, 24)
    months = [*fixed.MONTH_NAMES, "october", "MAY", "Octember"]
    day, year = lambda: f"{r.randint(0, 33)}{r.choice(['', '', 'th', 'st'])}", lambda: str(r.choice([2026, 2027, 2015, 2033, 1999, 2016, 2032]))
    shapes = [
        lambda: f"{day()} {r.choice(months)} {year()}", lambda: f"{r.choice(months)} {day()}, {year()}", lambda: f"{r.choice(months)}. {day()} {year()}", lambda: f" {year()}-{r.randint(1, 13):02d}-{r.randint(0, 32):02d} ",
        lambda: f"{r.randint(1, 28)}-{r.randint(1, 28)} {r.choice(months)} {year()}", lambda: f"on {day()} {r.choice(months)}, {year()} at 5 pm", lambda: f"{r.randint(1, 31)}/{r.randint(1, 12)}/{year()}", lambda: f"{r.choice(months)} {year()}",
        lambda: f"{r.randint(1, 28)} {r.choice(months)}", lambda: "no date at all", lambda: "", lambda: f"{r.randint(1, 28)} {r.choice(months)} to {r.randint(1, 28)} {r.choice(months)} {year()}",
    ]
    texts = [r.choice(shapes)() for _ in range(1500)] + [None, "5 October, 2026", "29 February 2027", "29 February 2028", "05-Oct-2026"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(4)
    got = {x["i"]: (x["d"]["start"], x["d"]["end"], x["rest"]) for x in rows.select("i", dates.strict(F.col("t"), today).alias("d"), dates.unread(F.col("t")).alias("rest")).collect()}
    at = dt.datetime(today.year, today.month, today.day)
    for i, t in enumerate(texts):
        assert got[i][:2] == dates.strict_range(t, at), t
    plain = [x for x in got.values() if x[0] and not x[2]]
    assert len(plain) > 250 and sum(x[2] is not None for x in got.values()) < 0.6 * len(texts)  # the share that Python sees
