"""The pipeline's stages on documents with planted cases, each held against a plain version of what it should do."""

import random
import zlib
from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from eventfold.llm import mixing, queries  # noqa: E402

from . import odd  # noqa: E402
from .test_corpus import WORD, brute_classes, brute_targets  # noqa: E402


def test_stages(spark, tmp_path):
    import sentencepiece

    r = random.Random(9)
    data, marks = [], []
    for i in range(240):
        w = odd.words(r, r.randint(60, 120)).split()
        toxic, junk = i % 8 == 0, i % 8 == 1
        for _ in range(4 * toxic):
            w.insert(r.randrange(len(w)), r.choice(["vileword", "nastything", "grubbish"]))
        text = " ".join(f"{x.upper()}!!" for x in w) if junk else " ".join(w)
        data.append((i, text, "en", f"src{i % 3}", len(text), "", "", ""))
        marks.append((i, int(not junk), int(toxic)))
    clean = [d for d in data if d[0] % 8 > 1]
    data += [(1000 + k, clean[k % 5][1], "en", "src0", 0, "", "", "") for k in range(20)]
    data += [(2000 + k, clean[k][1] + " more", "en", "src1", 0, "", "", "") for k in range(10)]
    odd.documents(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, odd.LABELS).write.parquet(f"{tmp_path}/labels.parquet")

    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{i}")
        assert i == 4 or docs.columns == before.columns
        seen.append([tuple(x) for x in docs.collect()])

    toxic = {d[0] for d in data if d[0] < 240 and d[0] % 8 == 0}
    left = Counter(d[0] for d in seen[0])
    assert Counter({k: n for k, n in left.items() if k not in toxic}) == Counter(d[0] for d in data if d[0] not in toxic)
    assert len(toxic & set(left)) <= 2  # of 30, with some 20 to learn from
    junk = {d[0] for d in data if d[0] < 240 and d[0] % 8 == 1}
    kept = {d[0] for d in seen[1]}
    assert not kept & junk and len({d[0] for d in seen[0]} - junk - kept) <= 3
    least = {k: c for _, k, _, c in brute_classes(seen[1], 5, 80, 100)}
    assert sorted(d[0] for d in seen[2]) == sorted(k for k, c in least.items() if k == c)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for d in seen[2]:
        n = len(WORD.findall(d[1]))
        sizes[d[3]] += n
        largest[d[3]] = max(largest[d[3]], n)
    for d in seen[3]:
        taken[d[3]] += len(WORD.findall(d[1]))
    assert all(abs(taken[s] - t) <= largest[s] for s, t in brute_targets(sizes).items())
    assert max(Counter(d[0] for d in seen[3]).values()) <= mixing.MOST
    library = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
    texts = {d[0]: d[1] for d in seen[3]}
    last = docs.collect()
    assert Counter(x["doc_id"] for x in last) == Counter(d[0] for d in seen[3])
    for x in last:
        want = library.encode(texts[x["doc_id"]])
        assert x["ids"] == want and x["parity"] and x["round_trip"] and x["ids_crc32"] == zlib.crc32(b"".join(t.to_bytes(4, "little") for t in want))


def test_odd_documents_pass_through(spark, tmp_path):
    odd.documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    odd.labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got and all(x["n_tokens"] for x in got)


def test_each_row_has_its_own_verdict(spark, tmp_path):
    r = random.Random(4)
    shout = lambda: " ".join(f"{x.upper()}!!" for x in odd.words(r, 60).split())
    data = [(i, odd.words(r, 80), "en", "src0", 0, "", "", "") for i in range(210)]
    data += [(None, odd.words(r, 80), "en", f"null{k}", 0, "", "", "") for k in range(5)]
    data += [(k, shout(), "en", "junk", 0, "", "", "") for k in (*range(200, 205), None)]
    spark.createDataFrame([(i, 1, 0) for i in range(200)], odd.LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    got = Counter(x["source"] for x in corpus_pipeline.good_quality(spark, odd.documents(spark, data), str(tmp_path)).collect())
    assert got["junk"] == 0 and sum(got[f"null{k}"] for k in range(5)) >= 4 and got["src0"] >= 190


def test_one_row_of_each_group_stays(spark):
    r = random.Random(6)
    a, b, c, e = (odd.words(r, 100) for _ in range(4))
    row = lambda i, text, source: (i, text, "en", source, 0, "", "", "")
    data = [row(5, a, "5a"), row(5, b, "5b"), row(7, a, "7"), row(8, a + " more", "8"), row(5, e, "5e"), row(None, c, "null c"), row(None, c + " more", "null c too"), row(9, b + " more", "9"), row(None, e, "null e")]
    docs = odd.documents(spark, data)
    got = [sorted(x["source"] for x in corpus_pipeline.one_of_each_group(spark, d, "").collect()) for d in (docs, docs.repartition(5, "text"))]
    assert got[0] == got[1] and len(got[0]) == 4
    assert {"5a", "5b", "5e"} < set(got[0]) and len({"null c", "null c too"} & set(got[0])) == 1


def test_no_documents(spark, tmp_path):
    odd.documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    odd.labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
