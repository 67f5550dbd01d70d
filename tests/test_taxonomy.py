"""Phrases by the automaton against each phrase's own pattern; categories, topics and reasons."""

import random
import re

import pytest
from pyspark.sql import functions as F

from eventfold.functions import phrases, taxonomy

PHRASES = (
    "tax", "cross-border tax", "m&a", "goods and services tax", "arbitrat*", "u.s. tax", "fp&a", "law and order", "vat", "state-of-the-art", "part iva", "bus", "class", "research & development", "risk*", "ipo", "new york", "a", "10-k",
)


def test_the_automaton_gives_what_the_patterns_give():
    r, own = random.Random(7), phrases.Matcher(PHRASES)
    parts = [*PHRASES, "Tax", "TAXES", "taxonomy", "cross border", "cross  border\ttax", "M & A", "m&as", "goods & services taxes", "Arbitration", "elevator", "vat-free", "busses", "buses", "state of the art", "state--of-the-art", "s", "es",
             "-", " ", "\n", ".", "(", "and", "&", "x", "9", "U.S. tax", "ſ", "claſſ", "é", "risky", "new york", "İ", "law  and", "order", "10 K"]
    for _ in range(4000):
        text = r.choice(["", " ", ". "]).join(r.choice(parts) for _ in range(r.randint(0, 9)))
        want = {n: m.group(0).strip().lower() for n, p in enumerate(PHRASES) if (m := re.search(phrases.pattern(p), text, re.I))}
        assert own(text) == want, text
    assert phrases.Matcher(())("anything") == {}


CASES = [
    ("Tax Treaty Forum", "cross-border tax and more", "Tax", "Tax (general)"), ("Golf day", "tax", "Reject", ""), ("Garden party", "nothing of it", "Unclear", ""), ("Duty", "levy", "Unclear", ""),
    (None, None, "Unclear", ""), ("Tax law", "", "Tax", "Tax (general)"), ("Mock exam", "", "Reject", ""), ("Day", "an exam prep evening", "Reject", ""),
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(CASES)], "i int, t string, d string")
    return {r["i"]: r["x"] for r in rows.select("i", taxonomy.classify(F.col("t"), F.col("d")).alias("x")).collect()}


def test_categories_and_topics(judged):
    assert [(judged[i]["category"], judged[i]["topic"]) for i in range(len(CASES))] == [c[2:] for c in CASES]


def test_reasons(judged):
    assert judged[0]["reason"].startswith("Tax topic in the event's own text: Tax (general) ('tax')")
    assert judged[1]["reason"] == "social event: 'Golf' in the event text" and judged[7]["reason"] == "exam prep: 'exam prep' in the event text"
    assert judged[2]["reason"] == judged[4]["reason"] == "no Tax, Finance or Legal topic found in the event's title or description"
    assert judged[3]["reason"] == "only a generic word or a single passing mention (generic word ('levy'); generic word ('duty')) -- not enough to accept on rules alone"


def test_ties_go_by_order_and_four_hits_are_shown(spark):
    raw = {"Tax": {"topics": {"T": ["alpha", "beta", "gamma", "delta", "omega"]}}, "Legal": {"topics": {"L": ["alpha", "beta", "gamma", "delta", "omega"]}}, "Finance": {"weak": ["alpha", "beta", "gamma", "delta"]}}
    own = taxonomy.entries(raw)
    got = spark.createDataFrame([("alpha beta gamma delta omega", "")], "t string, d string").select(taxonomy.classify(F.col("t"), F.col("d"), own).alias("x")).first()["x"]
    assert got["category"] == "Tax" and got["topic"] == "T" and list(got["scores"]) == [15.0, 15.0, 2.5]
    assert got["reason"] == "Tax topic in the event's own text: T ('alpha'); T ('beta'); T ('gamma'); T ('delta') (also matches Legal; Tax chosen by fixed order)"
    assert taxonomy.topic_names(own) == {"Tax": ["T"], "Legal": ["L"], "Finance": []} and taxonomy.topics_in_words(own) == "  Tax: T\n  Legal: L\n  Finance: "
    none = spark.range(1).select(taxonomy.classify(F.lit("alpha"), F.lit(None).cast("string"), ()).alias("x")).first()["x"]
    assert none["category"] == "Unclear"


def test_six_hundred_phrases_cost_what_their_hits_do(spark):
    import time

    many = tuple(f"word{i} of{i % 7}" for i in range(600))
    text = " ".join(f"word{i}" for i in range(40_000)) + " word5 of5"
    own = phrases.Matcher(many)
    began = time.process_time()
    assert own(text) == {5: "word5 of5"}
    assert time.process_time() - began < 1


def test_hits_are_worked_out_once(spark):
    """What was found is named once in the plan, however often scores and reasons use it, and a hit's topic is looked up and not searched for."""
    rows = taxonomy.entries({"Tax": {"topics": {f"T{i}": [f"alpha{i}", f"beta{i}"] for i in range(40)}}})
    text = spark.createDataFrame([("alpha3 beta3 beta39", "alpha0")], "title string, body string")
    hits = text.select(taxonomy.hits(F.col("title"), F.col("body"), rows).alias("found"))
    assert [(h["n"], h["topic"]) for h in hits.first()["found"]] == [(1, "T0"), (10, "T3"), (11, "T3"), (119, "T39")] and "filter(" not in hits._jdf.queryExecution().optimizedPlan().toString()
    held = spark.createDataFrame(hits.rdd, hits.schema)
    plan = held.select(taxonomy.judged(F.col("found")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert len(re.findall(r"found#\d+", plan.split("\n")[0])) == 1
