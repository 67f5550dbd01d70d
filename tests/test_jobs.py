import datetime as dt

from eventfold.plans import jobs

TODAY = dt.date(2026, 9, 24)
RAW = "ord int, date string, event_name string, organizer string, category string, format string, location string, description string, link string, source_url string"


def test_clean(spark):
    rows = [
        (1, "5-6 October 2026", "VAT Day", "Org", "Tax", "Virtual", "", "", "l", "s"), (2, "5 October 2026", "vat day", "Org 2", "Tax", "Virtual", "", "more", "l", "s"),
        (3, "", "Learn more", "Org", "Tax", "", "", "", "", "s"), (4, "October 2026", "Law Day", "Org", "Legal", "Virtual", "", "", "", "s"),
        (5, "1 May 2026", "Audit Day", "Org", "Audit", "Virtual", "", "", "", "s"), (6, "7 October 2026", "Bank Day", "Org", "Bank", "In Person", " ", "", "", "s"),
        (7, "8 October 2026", "Garden Day", "Org", "Plants", "Virtual", "", "", "", "s"), (8, "1 December", "Tax course", "Org", "Tax", "Virtual", "", "was held from December 1 to 9 2023", "", "s"),
        (9, "", "Tax Day on 9 October 2026", "Org", "Tax", "Virtual", "", "", "", "s"), (10, "29 February", "Leap tax", "Org", "Tax", "Virtual", "", "was held in 2023", "", "s"), (11, "x", "  ", "Org", "Tax", "", "", "", "", "s"),
    ]
    got = {r["ord"]: r for r in jobs.clean(spark.createDataFrame(rows, RAW), TODAY).collect()}
    assert {k: r["bucket"] for k, r in got.items()} == {2: "upcoming", 3: "flagged", 4: "incomplete", 5: "past", 6: "incomplete", 7: "flagged", 8: "past", 9: "upcoming", 10: "incomplete"}
    assert got[8]["date"] == "01-Dec-2023" and got[9]["date"] == "09-Oct-2026"


def test_a_run_after_another(spark):
    def raw(ord_, date, name, place="Leeds", text=""):
        return (ord_, date, name, "Org", "Tax", "Virtual", place, text, "l", "s")

    first = jobs.clean(spark.createDataFrame([raw(1, "5 October 2026", "Same Day"), raw(2, "1 October 2026", "Over Day"), raw(3, "", "Open Day"), raw(4, "9 October 2026", "Lost Day"), raw(5, "7 October 2026", "Moved Day"), raw(7, "", "Still Open Day")], RAW), TODAY)
    later = spark.createDataFrame([raw(11, "5 October 2026", "same day"), raw(12, "1 October 2026", "Over Day"), raw(13, "8 October 2026", "Open Day"), raw(15, "7 October 2026", "Moved Day", "York"), raw(16, "6 October 2026", "New Day"), raw(17, "", "Still Open Day")], RAW)
    got = {r["event_name"].lower(): (r["fate"], r["bucket"], r["ord"]) for r in jobs.refresh(later, first, dt.date(2026, 10, 3)).collect()}
    assert got == {
        "same day": ("changed", "upcoming", 11), "over day": ("unchanged", "past", 2), "open day": ("completed", "upcoming", 13), "lost day": ("untouched", "upcoming", 4),
        "moved day": ("changed", "upcoming", 15), "new day": ("new", "upcoming", 16), "still open day": ("unchanged", "incomplete", 7),
    }


def test_one_master_of_all_countries(spark):
    rows = [(1, "Tax Day", "05-Oct-2026", "London", "", "India"), (2, "tax day", "05-Oct-2026", "London", "text", "UAE"), (3, "Law Day", "05-Oct-2026", "Tokyo", "", "SG"), (4, "Bank Day on 6 October 2026", "05-Oct-2026", "", "", "SG"), (5, "Events", "", "", "", "SG")]
    got = {r["ord"]: (r["country"], r["bucket"]) for r in jobs.across_countries(spark.createDataFrame(rows, "ord int, event_name string, date string, location string, description string, source_country string")).collect()}
    assert got == {2: ("UK", "verified"), 3: ("SG", "review"), 4: ("SG", "review")}


def test_lists_to_records(spark):
    card = '<div class="event-card"><h3><a href="{0}">{1}</a></h3><p>{2}</p></div>'
    html = "<body>" + card.format("/vat", "VAT Update Day", "Date: 5 October 2026 Venue: London") + card.format("/law", "Law Forum", "6 October 2026") + card.format("/old", "Audit Day", "1 May 2026") + "</body>"
    lists = spark.createDataFrame([(1, "https://o.example/list", "Org", "India", html)], "ord int, url string, organizer string, country string, html string")
    detail = "<main><h1>Law Forum</h1><p>Date: 7 October 2026</p></main>"
    details = spark.createDataFrame([("https://o.example/law", detail)], "url string, html string")
    none = spark.createDataFrame([], "event_id string, fingerprint string, status string")
    got = {r["event_name"]: r for r in jobs.from_lists(lists, details, none, TODAY).collect()}
    assert {k: r["status"] for k, r in got.items()} == {"VAT Update Day": "verified", "Law Forum": "needs_review", "Audit Day": "past"}
    assert got["VAT Update Day"]["country"] == "UK" and got["Law Forum"]["date"] is None and got["Law Forum"]["conflicts"] == ["date"]
    state = spark.createDataFrame([(r["event_id"], r["fingerprint"], "kept") for r in got.values()], "event_id string, fingerprint string, status string")
    assert {(r["status"], r["changed"]) for r in jobs.from_lists(lists, details, state, TODAY).collect()} == {("kept", False)}


def test_reviews(spark):
    from eventfold.operators import review

    page = "VAT Update Day will be on 5 October 2026 in Leeds, in person"
    kinds = "event_id string, page string, decision string, category string, reason string, " + ", ".join(f"{p}_value string, {p}_quote string" for p in review.PARTS)
    none = [None] * 2
    rows = [
        ("a", page, "verified", "Tax", "", "VAT Update Day", "vat update day", None, "5 October 2026", "Leeds", "Leeds", None, "in person"),
        ("b", page, "verified", "Tax", "", "VAT Update Day", "VAT Update Day", None, "6 October 2026", *none, *none),
        ("c", page.replace("2026", "2025"), "verified", "Tax", "", "VAT Update Day", "VAT Update Day", None, "5 October 2025", *none, *none),
        ("d", page, "reject", "None", "a cookie notice only", *none, *none, *none, *none), ("e", page, "reject", "None", "a wine tasting", *none, *none, *none, *none),
    ]
    got = {r["event_id"]: r for r in review.evaluate(spark.createDataFrame(rows, kinds), TODAY).collect()}
    assert {k: r["outcome"] for k, r in got.items()} == {"a": "verified", "b": "unclear", "c": "reject", "d": "unclear", "e": "reject"}
    assert got["a"]["date"]["value"] == "05-Oct-2026" and got["a"]["format"]["value"] == "In Person" and "quote_date" in got["b"]["problems"]
    held = spark.createDataFrame([(x, "review", "old", "d0", "", "why", "", "") for x in "abe"], "event_id string, bucket string, date string, added_on string, verified_by string, review_reason string, ai_review string, reject_reason string")
    out = spark.createDataFrame([("a", "verified", "r", "05-Oct-2026"), ("b", "unclear", "note", ""), ("e", "reject", "wine", "")], "event_id string, outcome string, reason string, date string")
    after = {r["event_id"]: r for r in review.settle(held, out).collect()}
    assert (after["a"]["bucket"], after["a"]["date"], after["a"]["added_on"], after["a"]["verified_by"]) == ("verified", "05-Oct-2026", "d0", "AI review")
    assert (after["b"]["bucket"], after["b"]["ai_review"]) == ("review", "note") and (after["e"]["bucket"], after["e"]["reject_reason"]) == ("rejected", "wine")
    rows = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (4, "x")], "ord int, date string")
    verdicts = spark.createDataFrame([(1, "upcoming", "01-Oct-2026"), (2, "upcoming", "01-Oct-2025"), (3, "past", None)], "ord int, verdict string, corrected string")
    assert {r["ord"]: r["fate"] for r in review.resolve(rows, verdicts, TODAY).collect()} == {1: "promote", 2: "keep", 3: "drop", 4: "keep"}
