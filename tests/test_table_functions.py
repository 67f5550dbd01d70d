import datetime as dt

from eventfold.functions import extract, table_functions

PAGE = """<html><head><script type="application/ld+json">{"@type": "Event", "name": "Gala", "startDate": "2027-05-05", "location": "Leeds"}</script></head>
<body><main><h1>Events</h1><p>Venue: Hall 5</p><div class="c"><h3><a href="/a">Tax Forum London</a></h3><p>5 May 2027</p></div><div class="c"><h3><a href="/b">Audit Day York</a></h3><p>6 May 2027</p></div></main></body></html>"""


def test_functions_say_what_the_extraction_says(spark):
    table_functions.register(spark)
    spark.createDataFrame([(1, PAGE, "https://x.example/"), (2, None, None), (3, "", "u")], "k int, html string, url string").createOrReplaceTempView("some_pages")
    at = dt.datetime(2026, 9, 24)
    ask = lambda f, args: [tuple(r) for r in spark.sql(f"SELECT e.* FROM some_pages p, LATERAL {f}({args}) e").collect()]
    listed = ask("list_events", "p.html, p.url, DATE '2026-09-24'")
    want = extract.list_events(PAGE, "https://x.example/", at)
    assert [(r[0], r[1], r[-3], r[-1]) for r in listed] == [(e["fields"]["name"]["value"], e["fields"]["date"]["value"], e["link"], e["conflict"]) for e in want] and len(want) == 3
    assert [(r[0], r[2]) for r in ask("shaped_events", "p.html, p.url")] == [(e["name"], e["link"]) for e in extract.events_by_shape(PAGE, "https://x.example/")]
    assert ("Venue", "Hall 5") in ask("page_labels", "p.html")
    assert ask("json_events", "p.html, p.url") == [("Gala", "05-May-2027", None, "Leeds", None, None, None)]
