"""Texts of pages with links, proofs' haystack, topics and sorts."""

import datetime as dt

from pyspark.sql import functions as F

from eventfold.functions import extract, taxonomy
from eventfold.operators import report


def test_text_with_links():
    html = '<body><nav><a href="/n">Nav</a></nav><main><h1>Events</h1><p>See <a href="/vat">VAT Day</a> or <a href="mailto:x@y">mail</a></p><ul><li><a href="https://b.example/x">B</a></li></ul></main></body>'
    assert extract.linked_text(html, "https://o.example/list") == "Events\nSee [VAT Day](https://o.example/vat) or mail\n[B](https://b.example/x)"
    assert extract.linked_text(None, "u") == "" and extract.linked_text("", "u") == ""


def test_haystack():
    got = extract.haystack('<p>A &amp; B</p><script>{"d": "5\\/6\\/2026"}</script>')
    assert "A & B" in got and "5/6/2026" in got
    assert extract.haystack(None).strip() == ""


def test_topics(spark):
    rows = spark.createDataFrame([("Transfer Pricing Masterclass", "a tax treaty"), (None, None), ("Garden", "")], "t string, d string")
    got = [r["x"] for r in rows.select(taxonomy.topics(F.col("t"), F.col("d"), "Tax").alias("x")).collect()]
    assert any("transfer pricing" in x for x in got[0]) and len(got[0]) <= 4 and got[1] == [] and got[2] == []


def test_sorts(spark):
    rows = spark.createDataFrame([(1, "B", dt.date(2026, 1, 2), "02-Jan-2026"), (2, "A", None, None), (3, "B", dt.date(2025, 12, 1), "01-Dec-2025"), (4, "B", dt.date(2026, 12, 1), "01-Dec-2026")], "k int, country string, day date, date string")
    assert [r["k"] for r in report.chronological(rows, "day").collect()] == [3, 1, 4, 2]
    assert [r["k"] for r in report.by_country(rows).collect()] == [2, 3, 4, 1]
