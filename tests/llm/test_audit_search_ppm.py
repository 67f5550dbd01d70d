"""Filter audit, lexical search and prediction by partial matching against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from eventfold.llm import filter_audit, lexical, ppm

from . import odd

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


# --- filters


def failing(data):
    texts = [d[1] or "" for d in data]
    out = []
    for d, t in zip(data, texts, strict=True):
        w = SPACE.findall(t)
        late = d[0] is not None and any(e[0] is not None and e[0] < d[0] and (e[1] or "") == t for e in data)
        out.append({x for x, bad in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), re.search("[#$%&*|]", t), late), strict=True) if bad})
    return out


def brute_audit(data, labels):
    fails = failing(data)
    good, toxic = ({x[0] for x in labels if x[0] is not None and x[i] == 1} for i in (1, 2))
    rows, shapley = {}, Counter()
    for part in {d[2] or "" for d in data}:
        own = [(d[0], f) for d, f in zip(data, fails, strict=True) if (d[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for i, x in enumerate(order):
                lost, stay = [r for r in left if x in r[1]], [r for r in left if x not in r[1]]
                rows[part, order, i + 1] = (len(stay), len(lost), sum(x in r[1] for r in own) - len(lost), sum(r[1] == {x} for r in own), sum(r[0] in good for r in lost), sum(r[0] in toxic for r in lost))
                shapley[part, x] += len(lost)
                left = stay
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


@pytest.mark.parametrize("extra", [0, 40])
def test_audit(spark, extra):
    r = random.Random(3)
    data = odd.rows(40)
    data += [(2000 + i, " ".join(r.choice(["Plan", "sea", "UP", "a|b", "x", "y%"]) for _ in range(r.choice([3, 150, 260]))), r.choice(["en", None, ""]), "s", 0, "", "", "") for i in range(extra)]
    data += [(2000 + extra + i, "one text of many", "en", "s", 0, "", "", "") for i in range(extra)]
    labels = odd.labels(spark)
    got = filter_audit.audit(odd.documents(spark, data), labels).collect()
    want = brute_audit(data, [tuple(x) for x in labels.collect()])
    assert len(got) == len(want)
    assert {(x["part"], x["filter_order"], x["step"]): (x["kept"], x["removed"], x["redundant"], x["unique_fails"], x["good_lost"], x["toxic_lost"], x["shapley"]) for x in got} == want


def test_audit_of_nothing(spark):
    assert filter_audit.audit(odd.documents(spark, []), odd.labels(spark).limit(0)).count() == 0
    lost = filter_audit.audit(odd.documents(spark), odd.labels(spark).limit(0)).selectExpr("sum(good_lost) + sum(toxic_lost)").first()[0]
    assert lost == 0


def test_zeta(spark):
    r = np.random.default_rng(1)
    counts = r.integers(0, 50, 64)
    got = spark.range(1).select(filter_audit.zeta(filter_audit.F.array(*[filter_audit.F.lit(int(x)).cast("long") for x in counts]), 6).alias("x")).first()["x"]
    assert got == [int(sum(counts[m] for m in range(64) if m & s == m)) for s in range(64)]


# --- lexical search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute_search(data, items, k=10):
    docs = [(d[0], Counter(TERM.findall(lower(d[1])))) for d in data]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in docs:
            m = 25 + 75 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in TERM.findall(lower(text)) if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, data, items, k=10):
    index = lexical.build(odd.documents(spark, data))
    got = lexical.search(index, spark.createDataFrame(items, "item_id long, text string"), k=k)
    return sorted(map(tuple, got.collect()), key=repr)


def some_items(data):
    r = random.Random(5)
    texts = [d[1] for d in data if d[1]]
    items = [(i, " ".join(r.choice(texts).split()[:12])) for i in range(25)]
    return items + [(25, None), (26, ""), (27, "!! ??"), (28, "unheardof words"), (29, "the the river RIVER"), (29, "plan"), (None, "garden paper"), (30, "Thé É 漢字"), (31, texts[0] * 30)]


@pytest.mark.parametrize("small", [False, True])
def test_search(spark, monkeypatch, small):
    if small:  # many blocks, low tiers and batches of items
        monkeypatch.setattr(lexical, "BLOCK_DOCS", 23)
        monkeypatch.setattr(lexical, "ITEMS", 9)
        monkeypatch.setattr(lexical, "FIRST", 1)
    data = odd.rows(150)
    items = some_items(data)
    assert searched(spark, data, items) == brute_search(data, items)


def test_search_ties_and_repeats(spark):
    data = [(i % 7, "same words here", "en", "s", 0, "", "", "") for i in range(40)] + [(100, "other text", "en", "s", 0, "", "", "")]
    items = [(1, "same"), (2, "other"), (3, "here words same")]
    assert searched(spark, data, items, k=12) == brute_search(data, items, 12)


def test_search_of_nothing(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, odd.rows(5), []) == []
    assert searched(spark, [(1, None, "en", "s", 0, "", "", "")], [(1, "a")]) == []


def test_residuals_bound_lower_tiers():
    texts = [f"a {'b ' * (i % 9)} c{i % 3} {'d ' * (i % 50)}".encode() for i in range(300)]
    total = sum(len(lexical.terms(t)) for t in texts)
    rows = [x for b in lexical.block_rows(7, list(range(300)), texts, 300, total) for x in b.to_pylist() if x["tier"] != lexical.HEADER]
    held = defaultdict(dict)
    for x in rows:
        held[x["term"]][x["tier"]] = (np.frombuffer(x["impacts"], "<u4"), x["residual"], x["df"], np.frombuffer(x["docs"], "<u2"))
    for term, tiers in held.items():
        assert sum(len(v[0]) for v in tiers.values()) == tiers[0][2] == len({d for v in tiers.values() for d in v[3].tolist()}) == sum(term.encode() in lexical.terms(t) for t in texts)
        for t, (impacts, residual, _, _) in tiers.items():
            below = [v[0].max() for u, v in tiers.items() if u > t]
            assert residual == max(below, default=0) and impacts.min() >= residual and list(impacts) == sorted(impacts, reverse=True)


# --- prediction by partial matching


class Trie:
    """Counts of bytes by context, and the method's recursive definition."""

    def __init__(self, lines, order):
        self.order, self.seen = order, defaultdict(Counter)
        for line in lines:
            data = b"\n" * order + line + b"\n"
            for i in range(order, len(data)):
                for j in range(order + 1):
                    self.seen[data[i - j : i]][data[i]] += 1

    def p(self, context, byte, excluded=frozenset()):
        counts = {b: n for b, n in self.seen.get(context, {}).items() if b not in excluded}
        total = sum(counts.values())
        if byte in counts:
            return (2 * counts[byte] - 1) / (2 * total)
        escape = len(counts) / (2 * total) if total else 1.0
        excluded = excluded | set(counts)
        return escape * (self.p(context[1:], byte, excluded) if context else 1 / (ppm.SYMBOLS - len(excluded)))

    def score(self, line):
        data = b"\n" * self.order + line + b"\n"
        return sum(math.log10(self.p(data[i - self.order : i], data[i])) for i in range(self.order, len(data)))


def brute_ppm(data, order):
    lines = [b" ".join((d[1] or "").encode().lower().split()) for d in data]
    teach = [d[0] is not None and zlib.crc32(str(d[0]).encode()) % 10 != 0 for d in data]
    trie = Trie([x for x, t in zip(lines, teach, strict=True) if t], order)
    counts = Counter(w for x, t in zip(lines, teach, strict=True) if t for w in [*x.split(), b"\n"])
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, line, t in zip(data, lines, teach, strict=True):
        own = [*line.split(), b"\n"]
        out.append((d[0], not t, len(own), sum(counts[w] > 0 for w in own), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), trie.score(line)))
    return sorted(out, key=repr)


def check_ppm(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=repr), want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=2e-6)


@pytest.mark.parametrize("order", [3, 5])
def test_ppm(spark, monkeypatch, order):
    monkeypatch.setattr(ppm, "BLOCK_DOCS", 17)
    monkeypatch.setattr(ppm, "SHARD_WORDS", 20)
    monkeypatch.setattr(ppm, "GROUP_CODES", 4000)
    data = [d for d in odd.rows(60) if d[1] is None or len(d[1]) < 5000] + [(5000 + i, "long tail of " + "word " * i, "en", "s", 0, "", "", "") for i in range(30)]
    got = ppm.pretrained(odd.documents(spark, data), order=order).collect()
    check_ppm(got, brute_ppm(data, order))


def test_ppm_without_training(spark):
    data = [(None, "some text", "en", "s", 0, "", "", ""), (None, None, "en", "s", 0, "", "", "")]
    got = ppm.pretrained(odd.documents(spark, data)).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) for r in got} == {(3, 0, 0, True), (1, 0, 0, True)}
    assert sorted(r["score"] for r in got) == pytest.approx(sorted([-10 * math.log10(ppm.SYMBOLS), -math.log10(ppm.SYMBOLS)]), rel=1e-6)
    assert ppm.pretrained(odd.documents(spark, [])).count() == 0


def test_codes_of_lines_are_those_of_each():
    lines = [b"", b"ab", b"", b"abc d", b"x"]
    for order in (1, 2, 5):
        assert ppm.codes(lines, order).tolist() == [c for x in lines for c in ppm.codes([x], order).tolist()]
        assert len(ppm.codes(lines, order)) == sum(len(x) + 1 for x in lines)


def test_probabilities_sum_to_one():
    line = b"the then them there the heat of the earth"
    code, n = np.unique(ppm.codes([line], 4), return_counts=True)
    found = ppm.levels(code.astype(np.int64), n, 4, 0)
    alphabet = [b for b in range(256) if b not in b"\t\v\f\r"]
    for context in (b"the ", b" the", b"zzzz", b"hthe", b"\n\n\n\n"):
        c = int.from_bytes(context, "big")
        assert sum(10 ** ppm.log10_of(found, np.array([c << 8 | b for b in alphabet]))) == pytest.approx(1)


def test_adaptive(spark):
    text = "a rose is a rose is a rose " * 20
    rows = [(1, text, "en", "s", 0, "", "", ""), (2, "", "en", "s", 0, "", "", ""), (3, None, "en", "s", 0, "", "", ""), (4, "q8#z!k2@w7", "en", "s", 0, "", "", "")]
    got = {r["doc_id"]: r for r in ppm.adaptive(odd.documents(spark, rows)).collect()}
    assert got[1]["bits"] / got[1]["n_bytes"] < 0.6 and got[4]["bits"] / got[4]["n_bytes"] > 7
    assert got[2]["bits"] == got[3]["bits"] == pytest.approx(math.log2(ppm.SYMBOLS))
    line, seen, bits = b"abcabcabd", [], 0.0
    data = b"\n" * 3 + line + b"\n"
    for i in range(3, len(data)):
        trie = Trie([], 3)
        for j in range(3, i):
            for k in range(4):
                trie.seen[data[j - k : j]][data[j]] += 1
        bits -= math.log2(trie.p(data[i - 3 : i], data[i]))
    assert ppm.adaptive_bits(line, 3) == pytest.approx(bits)


def test_odd_documents(spark):
    assert ppm.pretrained(odd.documents(spark)).count() == len(odd.rows())
