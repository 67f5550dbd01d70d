import numpy as np
import pytest

from eventfold.llm import mtree, vptree


def brute(ids, a, query_every, k, score, best_first):
    out = {}
    for i in sorted({int(x) for x in ids if x % query_every == 0}):
        q = a[list(ids).index(i)]
        rows = sorted(((score(v, q) * (-1 if best_first else 1), int(j)) for j, v in zip(ids, a, strict=True) if j != i))[:k]
        out[i] = [j for _, j in rows]
    return out


def frame(spark, ids, a):
    return spark.createDataFrame([(int(i), [float(x) for x in v], "x") for i, v in zip(ids, a, strict=True)], "vec_id long, embedding array<float>, v string")


@pytest.mark.parametrize("shard_rows", [37, 8192])
def test_inner_products_are_exact(spark, shard_rows):
    r = np.random.default_rng(1)
    a = np.round(r.normal(size=(400, 8)), 2).astype(np.float32)
    a[100:160] = a[7]  # a third of them alike, so ties
    ids = np.arange(400)
    got = mtree.top_k(frame(spark, ids, a), query_every=50, shard_rows=shard_rows).orderBy("query_id", "rank").collect()
    ints = np.floor(a.astype(np.float64) * 1024)
    want = brute(ids, ints, 50, 10, lambda v, q: int(v @ q), True)
    assert {i: [r["vec_id"] for r in got if r["query_id"] == i] for i in want} == want
    assert all(r["score"] == int(ints[r["vec_id"]] @ ints[r["query_id"]]) for r in got)


def test_factor_one_is_exact_and_recall_is_high(spark):
    r = np.random.default_rng(2)
    a = (r.normal(size=(20, 16))[r.integers(0, 20, 600)] + 0.3 * r.normal(size=(600, 16))).astype(np.float32)
    ids = np.arange(600)
    want = brute(ids, a.astype(np.float64), 50, 10, lambda v, q: float(np.sqrt(((v - q) ** 2).sum())), False)
    for factor, least in ((1.0, 1.0), (vptree.FACTOR, 0.9)):
        got = vptree.nearest(frame(spark, ids, a), query_every=50, factor=factor, shard_rows=150).collect()
        hits = sum(r["vec_id"] in want[r["query_id"]] for r in got)
        assert hits >= least * 10 * len(want)
        assert all(abs(r["score"] - np.sqrt(((a[r["vec_id"]].astype(float) - a[r["query_id"]].astype(float)) ** 2).sum())) < 1e-12 for r in got)


def test_pruning_saves_distances():
    r = np.random.default_rng(3)
    a = r.normal(size=(30, 6))[r.integers(0, 30, 3000)] + 0.01 * r.normal(size=(3000, 6))
    tree = vptree.build(np.arange(3000), a)
    vptree.find(tree, 0, a[0], 10, None, 1.0)
    assert tree.computed < 1500
    tree = mtree.build(np.arange(3000), np.floor(a * 1024))
    mtree.find(tree, 0, np.floor(a[0] * 1024), 10)
    assert tree.computed < 3000


@pytest.mark.parametrize("search", [mtree.top_k, vptree.nearest])
def test_odd_vectors(spark, search):
    rows = [(0, [1.0, 2.0]), (100, None), (200, [float("nan"), 1.0]), (300, [None, 1.0]), (1, [1.0, 2.0]), (2, [0.0, 0.0]), (3, [1.0, 2.0, 3.0]), (1, [1.0, 2.0]), (None, [1.0, 1.0]), (400, [float("inf"), 0.0]), (5, [3.0, 4.0])]
    got = search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    zero = {2} if search is mtree.top_k else set()
    assert {r["query_id"] for r in got} == {0} and sorted(r["vec_id"] for r in got) == sorted({1, 5} | zero)
    assert sorted(r["rank"] for r in got) == list(range(1, len(got) + 1))
    assert search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_clustered_rows_meet_few_shards(spark):
    r = np.random.default_rng(4)
    a = (10 * r.normal(size=(12, 8))[r.integers(0, 12, 900)] + 0.1 * r.normal(size=(900, 8))).astype(np.float32)
    ids = np.arange(900)
    want = brute(ids, a.astype(np.float64), 50, 10, lambda v, q: float(np.sqrt(((v - q) ** 2).sum())), False)
    got = vptree.nearest(frame(spark, ids, a), query_every=50, factor=1.0, shard_rows=60).orderBy("query_id", "rank").collect()
    assert {i: [r["vec_id"] for r in got if r["query_id"] == i] for i in want} == want
    ints = np.floor(a.astype(np.float64) * 1024)
    want = brute(ids, ints, 50, 10, lambda v, q: int(v @ q), True)
    got = mtree.top_k(frame(spark, ids, a), query_every=50, shard_rows=60).orderBy("query_id", "rank").collect()
    assert {i: [r["vec_id"] for r in got if r["query_id"] == i] for i in want} == want


def test_a_limit_known_before_saves_distances():
    r = np.random.default_rng(5)
    a = r.normal(size=(4000, 64))
    a /= np.sqrt((a**2).sum(1))[:, None]  # no clusters: as the embeddings of the test tables
    ids = np.arange(4000)
    tree, whole = vptree.build(ids, a), vptree.build(ids, a)
    found, share = 0, 0
    for i in range(0, 4000, 100):
        exact, d = vptree.find(whole, i, a[i], 10, None, 1.0)
        some, _ = vptree.find(tree, i, a[i], 10, float(d[-1]), vptree.FACTOR)
        found += len(set(exact.tolist()) & set(some.tolist()))
    assert found >= 0.95 * 400 and tree.computed < whole.computed


def test_great_products_are_exact_or_refused(spark):
    rows = [(i, [1e5 + i, 3e4 - i]) for i in range(40)]  # products above 2**53
    got = mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), query_every=20, k=5, shard_rows=10).collect()
    ints = {i: [int(x * 1024) for x in v] for i, v in rows}
    for q in (0, 20):
        want = sorted((-sum(x * y for x, y in zip(ints[q], ints[i], strict=True)), i) for i in ints if i != q)[:5]
        assert [(-r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == want
    with pytest.raises(Exception, match="range of a long"):
        mtree.top_k(spark.createDataFrame([(0, [1e12, 1.0]), (1, [1e12, 1.0])], "vec_id long, embedding array<double>")).collect()


def test_a_vector_repeated_and_ties_at_the_last_place(spark):
    a = np.zeros((300, 4), np.float32)
    a[:, 0] = 1
    a[250:, 1] = np.repeat(np.arange(5), 10)
    ids = np.arange(300)
    data = frame(spark, ids, a)
    data = data.union(data.where("vec_id < 100")).union(data.where("vec_id = 3"))
    for search, best_first, score in ((mtree.top_k, True, lambda v, q: int(v @ q)), (vptree.nearest, False, lambda v, q: float(np.sqrt(((v - q) ** 2).sum())))):
        m = np.floor(a.astype(np.float64) * 1024) if best_first else a.astype(np.float64)
        want = brute(ids, m, 50, 10, score, best_first)
        got = search(data, query_every=50, shard_rows=40).orderBy("query_id", "rank").collect()
        if best_first or vptree.FACTOR == 1:
            assert {i: [r["vec_id"] for r in got if r["query_id"] == i] for i in want} == want
        else:
            assert sum(r["vec_id"] in want[r["query_id"]] for r in got) >= 0.9 * sum(map(len, want.values()))


def test_long_vectors(spark):
    r = np.random.default_rng(6)
    a = np.round(r.normal(size=(120, 3000)), 2).astype(np.float32)
    ids = np.arange(120)
    ints = np.floor(a.astype(np.float64) * 1024)
    want = brute(ids, ints, 40, 10, lambda v, q: int(v @ q), True)
    got = mtree.top_k(frame(spark, ids, a), query_every=40).orderBy("query_id", "rank").collect()
    assert {i: [r["vec_id"] for r in got if r["query_id"] == i] for i in want} == want
