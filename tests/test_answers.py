import json
import uuid

from eventfold.sources import answers

KINDS = "id int, name string, organizer string, category string, location string"


def _rows(spark, n):
    return spark.createDataFrame([(i, f"Event {i}", "Org", "Tax", "Leeds" if i % 2 else None) for i in range(n)], KINDS).repartition(5)


def test_groups_of_answers(spark, tmp_path):
    def call(prompt):
        (tmp_path / uuid.uuid4().hex).write_text(prompt)
        lines = prompt.split("\n\n", 1)[1].split("\n")
        first = int(lines[0].split("Event ")[1].split('"')[0])
        good = [int(x.split("Event ")[1].split('"')[0]) % 3 != 0 for x in lines]
        if first == 0:
            return {"answer": json.dumps({"results": good}), "tokens_in": 5}
        if first == 10:
            return {"answer": json.dumps({"results": good[:-1]})}
        if first == 20:
            return {"answer": '{"results": [tru'}
        if first == 30:
            raise ValueError("refused")
        if first == 40:
            return {"answer": '{"results": "all of them"}'}
        if first == 50:
            return {"answer": json.dumps({"results": [None, *good[1:]]})}
        return {"answer": None}

    got = {r["id"]: (r["keep"], r["why"]) for r in answers.relevant(_rows(spark, 67), call, size=10, tries=1).collect()}
    assert len(got) == 67
    assert [got[i] for i in range(10)] == [(i % 3 != 0, "answered") for i in range(10)]
    assert {got[i] for i in range(10, 20)} == {(True, "length")} and {got[i] for i in range(20, 30)} == {(True, "unreadable")} and {got[i] for i in range(30, 40)} == {(True, "error")}
    assert {got[i] for i in range(40, 50)} == {(True, "unreadable")} and got[50] == (True, "null") and got[51] == (False, "answered") and {got[i] for i in range(60, 67)} == {(True, "unreadable")}
    asked = [p.read_text() for p in tmp_path.iterdir()]
    assert len(asked) == 7  # each question once
    assert any('0. "Event 0" | host: Org | tag: Tax\n1. "Event 1" | host: Org | tag: Tax | location: Leeds\n' in x for x in asked)
    assert answers.relevant(_rows(spark, 0), call).count() == 0


def test_events_that_pages_name(spark):
    def call(prompt):
        url = prompt.split("Page: ")[1].split("\n")[0]
        if url.endswith("bad"):
            return {"answer": "Sorry, no."}
        if url.endswith("down"):
            raise OSError("timeout")
        if url.endswith("none"):
            return {"answer": '{"events": []}'}
        events = [{"event_name": "Gala", "date": "5 May", "format": "Virtual", "link": "https://x.example/gala"}, {"event_name": " ", "date": "6 May"}, {"event_name": "Talk", "format": "On Mars", "link": "https://elsewhere.example/"}]
        return {"answer": json.dumps({"events": events})}

    html = "<html><body><main><p>Gala <a href='/gala'>Details</a></p><p>Talk</p></main></body></html>"
    pages = spark.createDataFrame([(f"https://x.example/{p}", "Org", html) for p in ("ok", "bad", "down", "none")] + [("https://x.example/empty", None, None)], "url string, organizer string, html string")
    rows = answers.events_of_pages(pages, call, tries=1).collect()
    ok = {r["event_name"]: r for r in rows if r["source_url"].endswith("ok")}
    assert set(ok) == {"Gala", "Talk"} and ok["Gala"]["link"] == "https://x.example/gala" and ok["Gala"]["format"] == "Virtual" and ok["Talk"]["link"] == "https://x.example/ok" and ok["Talk"]["format"] == ""
    assert {(r["source_url"][-4:], r["problem"]) for r in rows if r["problem"]} == {("/bad", "unreadable"), ("down", "OSError: timeout")} and len(rows) == 4
