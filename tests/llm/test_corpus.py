import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventfold.llm import components, jaccard, mixing, quality, toxicity

from . import odd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- components and near copies


def test_components(spark):
    r = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 300, (180, 2))] + [(i, i + 1) for i in range(500, 560)] + [(900, 901 + i) for i in range(50)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == {x: find(x) for x in parent}


def brute_classes(data, n, top, base):
    def lower(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")

    sets = []
    for d in data:
        w = WORD.findall(lower(d[1]))
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    label = list(range(len(data)))
    changed = True
    pairs = [(i, j) for i in range(len(data)) for j in range(i) if sets[i] and sets[j] and data[i][0] is not None and data[j][0] is not None and base * len(sets[i] & sets[j]) >= top * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in pairs:
            low = min(label[i], label[j])
            if (label[i], label[j]) != (low, low):
                label[i] = label[j] = low
                changed = True
    least = defaultdict(lambda: 10**9)
    for d, x in zip(data, label, strict=True):
        if d[0] is not None:
            least[x] = min(least[x], d[0])
    return sorted((d[0] is not None, d[0] or 0, len(s), least[x] if d[0] is not None else None) for d, s, x in zip(data, sets, label, strict=True))


@pytest.mark.parametrize(("n", "top"), [(3, 90), (5, 80), (2, 50)])
def test_classes_equal_brute_force(spark, n, top):
    import random

    r = random.Random(n)
    data = odd.rows(40)
    for g in range(6):
        base = odd.words(r, r.choice([30, 60, 120])).split()
        for k in range(12):
            w = list(base)
            for _ in range(r.randint(0, 1 + len(w) // 25)):
                w[r.randrange(len(w))] = f"edit{r.randint(0, 9)}"
            data.append((2000 + 100 * g + k, " ".join(w), "en", "s", 0, "", "", ""))
    got = jaccard.classes(odd.documents(spark, data), words_each=n, top=top, base=100).collect()
    want = brute_classes(data, n, top, 100)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in got) == want
    assert jaccard.classes(odd.documents(spark, [])).count() == 0


def test_sets_whose_names_clash(spark):
    data = odd.rows(40)
    docs = odd.documents(spark, data)
    own, nodes, _, labels = jaccard._join(docs, 3, 90, 100, "doc_id", "text", False, name_bits=3)
    got = jaccard._rows(own, jaccard._ids(nodes, labels)).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in got) == brute_classes(data, 3, 90, 100)


def test_every_link_of_a_group(spark):
    import random

    r = random.Random(8)
    data = odd.rows(20)
    for g, size in enumerate((40, 12)):
        base = odd.words(r, 90).split()
        for k in range(size):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = f"edit{r.randint(0, 9)}"
            data.append((2000 + 100 * g + k, " ".join(w), "en", "s", 0, "", "", ""))
    sets = {}
    for d in data:
        w = WORD.findall((d[1] or "").lower())
        if d[0] is not None and w:
            sets.setdefault(frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) or frozenset([tuple(w)]), []).append(d[0])
    nodes = list(sets)
    pairs = [(i, j) for i in range(len(nodes)) for j in range(i) if 100 * len(nodes[i] & nodes[j]) >= 80 * len(nodes[i] | nodes[j])]
    links, rows = jaccard.joined(odd.documents(spark, data), words_each=3, top=80, base=100)
    assert len(pairs) > 200 and sorted(sorted((x["a_id"], x["b_id"])) for x in links.collect()) == sorted(sorted((min(sets[nodes[i]]), min(sets[nodes[j]]))) for i, j in pairs)
    degree, rows = Counter(k for p in pairs for k in p), rows.collect()
    assert len(rows) == len(data)
    want = sorted((k, degree[i]) for i, s in enumerate(nodes) for k in sets[s])
    assert sorted((x["doc_id"], x["n_links"]) for x in rows if x["doc_id"] is not None and x["n_shingles"]) == want
    least = Counter((x["doc_id"], x["n_shingles"], x["component_id"]) for x in rows)
    assert least == Counter(tuple(x) for x in jaccard.classes(odd.documents(spark, data), words_each=3, top=80, base=100).collect())


def test_prefixes_grow_with_cost():
    h = np.sort(np.random.default_rng(1).integers(0, 2**63, 200).astype(np.uint64) * np.uint64(2))
    rare, often = np.zeros(1 << 18, np.uint8), np.full(1 << 18, 20, np.uint8)
    a, la = jaccard.prefix(h, rare, 90, 100)
    b, lb = jaccard.prefix(h, often, 90, 100)
    assert (la, len(a)) == (1, 21) and lb == 4 and len(b) == 24


# --- mixing


def test_rounding_keeps_sums_and_means():
    r = np.random.default_rng(1)
    w = r.integers(1, 100, 500).astype(float)
    p = np.full(500, 0.37)
    took = np.zeros(500)
    for seed in range(200):
        out = mixing.pivot(p, w, r.integers(0, 2**63, 500).astype(np.uint64), seed)
        part = (out > 0) & (out < 1)
        assert part.sum() <= 1 and abs((out * w).sum() - (p * w).sum()) < 1e-6
        took += out
    assert abs(took.mean() / 200 - 0.37) < 0.02


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        more = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not more:
            return {s: 2 * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= more


def test_mix(spark):
    data = odd.rows(300)
    got = mixing.mix_table(odd.documents(spark, data)).collect()
    again = mixing.mix_table(odd.documents(spark, data).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(data)
    sizes = Counter()
    for d in data:
        sizes[d[3]] += len(WORD.findall(d[1] or ""))
    want = brute_targets(sizes)
    by_size = {v: k for k, v in sizes.items()}
    assert len(by_size) == len(sizes)
    taken = Counter()
    for r in got:
        s = by_size[r["source_size"]]
        assert math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert r["size"] == 0 and r["taken"] == 0 or r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
    largest = {s: max(len(WORD.findall(d[1] or "")) for d in data if d[3] == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    repeated = mixing.repeat(odd.documents(spark, data))
    assert repeated.columns == odd.documents(spark, []).columns
    assert repeated.count() == sum(r["taken"] // r["size"] for r in got if r["size"])
    assert mixing.mix_table(odd.documents(spark, [])).count() == 0


def test_mix_of_rows_without_ids(spark):
    r = random.Random(2)
    data = [(None if i % 3 else 7, odd.words(r, r.randint(1, 40)), "en", f"src{i % 2}", i, "x", "y", "z") for i in range(6000)]
    docs = odd.documents(spark, data)
    keys = {x["k"] for x in docs.select(mixing.row_key(docs, 7).alias("k")).collect()}
    assert len(keys) == len(set(data))  # so they spread over buckets
    got = mixing.mix_table(docs).groupBy("source_size", "target").agg({"taken": "sum"}).collect()
    assert all(abs(x["sum(taken)"] - x["target"]) <= 40 for x in got) and len(got) == 2
    twice = mixing.repeat(docs.union(docs.where("n_chars < 50")))
    again = mixing.repeat(docs.union(docs.where("n_chars < 50")).repartition(5))
    assert sorted(map(str, twice.collect())) == sorted(map(str, again.collect()))


def test_mix_of_equal_rows_and_maps(spark):
    row = (1, "one and the same text", "en", "a", 0, "x", "y", "z")
    data = [row] * 20_000 + [(i, "w " * (i % 30), "en", "b", 0, "x", "y", "z") for i in range(2, 400)]
    docs = odd.documents(spark, data)
    entries = mixing.copies(docs).where("doc_id = 1").collect()
    assert len(entries) == 1 and entries[0]["n"] == 20_000  # one entry of its bucket
    got = mixing.mix_table(docs).collect()
    assert len(got) == len(data)
    own = [r for r in got if r["doc_id"] == 1]
    assert len(own) == 20_000 and abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 5 and max(r["taken"] for r in own) <= 10
    assert mixing.repeat(docs).where("doc_id = 1").count() == sum(r["taken"] for r in own) // 5
    maps = docs.where("doc_id > 1").withColumn("m", mixing.F.expr("map('k', doc_id % 3)")).drop("doc_id").withColumn("doc_id", mixing.F.lit(5)).withColumn("text", mixing.F.lit("four words of text"))
    had, out = ({r["k"]: r["n"] for r in t.groupBy(mixing.F.expr("m['k']").alias("k")).agg(mixing.F.count("*").alias("n")).collect()} for t in (maps, mixing.repeat(maps)))
    assert set(out) == set(had) and all(had[k] <= out[k] <= 2 * had[k] for k in had)


# --- quality


def brute_model(texts):
    order = quality.ORDER
    grams = lambda t: (lambda b: [b[i : i + order] for i in range(len(b) - order + 1)])(b"\x02" * (order - 1) + t.encode() + b"\x03")
    counts = [Counter(g for t in texts for g in grams(t))]
    for _ in range(order - 1):
        counts.insert(0, Counter(g[1:] for g in counts[0]))

    def discount(c):
        n = Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        cut = lambda i: min(max(i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0.5 * i, 0.05 * i), i - 0.05)
        return lambda v: cut(min(v, 3)) if v else 0

    levels = []
    for c in counts:
        d, total, mass = discount(c), Counter(), Counter()
        for k, v in c.items():
            total[k[:-1]] += v
            mass[k[:-1]] += d(v)
        levels.append((c, d, total, mass))

    def p(gram):
        low = 1 / 256
        for i, (c, d, total, mass) in enumerate(levels):
            k = gram[len(levels) - 1 - i :]
            if total[k[:-1]]:
                v = c[k]
                low = (v - d(v)) / total[k[:-1]] + mass[k[:-1]] / total[k[:-1]] * low
        return low

    return lambda t: math.exp(-sum(math.log(p(g)) for g in grams(t)) / len(grams(t)))


def test_perplexities_equal_brute_force(spark):
    data, docs = odd.rows(), odd.documents(spark)
    trusted = {i for i in range(60) if i % 5}
    held = {r["doc_id"] for r in docs.where(quality.held_out()).select("doc_id").collect()}
    got = quality.judge(docs, odd.labels(spark)).collect()
    assert len(got) == len(data)
    models = {x: brute_model([d[1] for d in data if d[2] == x and d[0] in trusted - held]) for x in ("en", "de")}
    for d in data:
        if d[2] in models and d[1]:
            want = models[d[2]](d[1])
            assert any(r["doc_id"] == d[0] and r["perplexity"] and math.isclose(r["perplexity"], want, rel_tol=1e-6) for r in got), d[0]
    none = {r["doc_id"]: r["keep"] for r in got if r["perplexity"] is None}
    assert none[1000] is False and none[1001] is False and none[1002] is True and none[1004] is True
    assert quality.judge(odd.documents(spark, []), odd.labels(spark)).count() == 0
    assert all(r["keep"] for r in quality.judge(docs, odd.labels(spark).limit(0)).collect() if r["n_symbols"])


def test_one_odd_trusted_document_sets_no_limit(spark):
    import random
    import zlib

    r = random.Random(3)
    held = lambda i: zlib.crc32(str(i).encode()) % quality.HOLD_OUT == 0
    bars = lambda n: " | ".join(odd.words(r, n).split())
    data = [(i, odd.words(r, 80), "en", "s", 0, "", "", "") for i in range(400)]
    outlier = next(i for i in range(400) if held(i))
    data[outlier] = (outlier, "QX#ZV%%KJ&&WQ " * 30, *data[outlier][2:])
    data += [(1000 + i, bars(80), "en", "s", 0, "", "", "") for i in range(20)]
    few = [i for i in range(2000, 2100) if not held(i)][:20]  # a language of which the checksums hold out none
    data += [(i, odd.words(r, 80), "fr", "s", 0, "", "", "") for i in few] + [(3000 + i, bars(80), "fr", "s", 0, "", "", "") for i in range(5)]
    labels = spark.createDataFrame([(i, 1, 0) for i in [*range(400), *few]], odd.LABELS)
    got = {x["doc_id"]: x["keep"] for x in quality.judge(odd.documents(spark, data), labels).collect()}
    assert not any(k for i, k in got.items() if 1000 <= i < 2000 or i >= 3000)
    assert sum(got[i] for i in range(400)) >= 390 and sum(got[i] for i in few) >= 18


def test_probabilities_sum_to_one():
    r = np.random.default_rng(5)
    text = bytes(r.choice(list(b"abcd "), 3000).tolist())
    code, n = np.unique(quality.codes(text), return_counts=True)
    level, d = (code, n), {}
    for k in range(quality.ORDER, 2, -1):
        d[k] = quality.discounts(*[int((level[1] == i).sum()) for i in (1, 2, 3, 4)])
        level = quality.lower(level[0], k)
    flat = np.full(65536, 1 / 256)
    for seen in (text[100:105], b"zzzzz", b"\xff\xffab ", text[:4] + b"\x00"):
        context = np.frombuffer(seen, np.uint8).astype(np.int64)[1 - quality.ORDER :]
        wanted = sum(c << 8 * (quality.ORDER - 1 - i) for i, c in enumerate(context.tolist())) + np.arange(256)
        p = quality.probabilities((d, flat), code, n, wanted)
        assert p.min() > 0 and abs(p.sum() - 1) < 1e-12


def test_packing():
    r = np.random.default_rng(6)
    code = np.unique(r.integers(0, 1 << 8 * quality.ORDER, 5000))
    for part in (code, code[:1], code[:0]):
        assert np.array_equal(quality.unpack(quality.pack(part)), part)
    assert quality.codes("aé".encode()).tolist()[0] & 0xFFFF == 2 << 8 | ord("a")


# --- toxicity


def brute_segments(scores):
    """Recursion on the best segment of each part."""
    if not len(scores) or max(scores) <= 0:
        return []
    best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)))
    i, j = -best[2], -best[2] - best[1]
    return brute_segments(scores[:i]) + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in brute_segments(scores[j:])]


def test_segments_equal_brute_force():
    r = np.random.default_rng(1)
    for _ in range(300):
        scores = r.choice([-3.0, -2.0, -1.0, 1.0, 2.0, 4.0], r.integers(0, 14)) + r.random() * 1e-3 * r.random()
        scores = scores + r.random(len(scores)) * 1e-4
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.segments(scores)]
        assert got == [(a, b, round(s, 6)) for a, b, s in brute_segments(scores.tolist())]


def test_toxic_documents_are_found(spark):
    import random

    r = random.Random(5)
    bad = ["vileword", "nastything", "grubbish", "foulstem" + "x"]
    data, marks = [], []
    for i in range(600):
        toxic = i % 6 == 0
        w = odd.words(r, r.randint(30, 120)).split()
        for _ in range(3 * toxic):
            w.insert(r.randrange(len(w)), r.choice(bad))
        data.append((i, " ".join(w), "en", "s", 0, "", "", ""))
        marks.append((i, 1, int(toxic)))
    labels = spark.createDataFrame(marks, odd.LABELS)
    docs = odd.documents(spark, data + odd.rows(0))
    got = toxicity.verdicts(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(r["predicted"] == int(r["doc_id"] % 6 == 0) for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600)
    assert all(0 <= r["score"] <= 1 for r in got) and all(r["predicted"] == 0 for r in got if r["doc_id"] is None or r["doc_id"] >= 1000)
    kept = toxicity.reject(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id % 6 = 0 AND doc_id < 600").count() == 0
    assert toxicity.verdicts(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.verdicts(docs.limit(0), labels).count() == 0


def test_lambda_solves_its_equation():
    lam = toxicity.solve(Counter({-1.0: 900, 2.0: 30}))
    p = np.array([900, 30, 0.5]) / 930.5
    assert abs((p * np.exp(lam * np.array([-1.0, 2.0, 5.0]))).sum() - 1) < 1e-6
