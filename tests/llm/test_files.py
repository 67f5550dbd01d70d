import base64
import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventfold.llm import queries, token_file, warc

from . import odd


def test_members_and_framing():
    parts = [warc.record("response", str(i), "http://x/", "d", b"p" * i, i, warc.base32_sha1(b"p" * i), None) for i in range(5)]
    got = list(warc.records(io.BytesIO(b"".join(parts))))
    assert [len(r["payload"]) for r in got] == [0, 1, 2, 3, 4]
    assert list(warc.records(io.BytesIO(b""))) == []
    with pytest.raises(warc.WarcError):
        list(warc.records(io.BytesIO(b"".join(parts)[:-3])))
    damaged = zlib.decompress(parts[3], 31).replace(b"ppp", b"pqp")
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    with pytest.raises(warc.WarcError):
        list(warc.records(io.BytesIO(packer.compress(damaged) + packer.flush())))


def _member(data):
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@pytest.mark.parametrize("size", [1, 7, 1 << 16])
def test_members_are_framed_whatever_the_reads(size):
    parts = [warc.record("response", str(i), "http://x/", "d", bytes([i]) * i * 1000, i * 1000, warc.base32_sha1(bytes([i]) * i * 1000), None) for i in range(4)]
    got = list(warc.framed(io.BytesIO(b"".join(parts)), size))
    assert [b.split(b"\r\n\r\n", 1)[1] for _, b in got] == [bytes([i]) * i * 1000 for i in range(4)]


def test_a_member_fills_no_more_than_it_announces():
    good = zlib.decompress(warc.record("response", "1", "http://x/", "d", b"abc", 3, warc.base32_sha1(b"abc"), None), 31)
    stream = io.BytesIO(_member(good + bytes(50 << 20)))
    member = warc.Member(stream, b"")
    head = member.until(b"\r\n\r\n", warc.HEAD_BYTES)
    block = member.take(int(head.rpartition(b"Content-Length: ")[2]))
    assert block.endswith(b"abc") and len(member.held) <= warc.HEAD_BYTES
    stream.seek(0)
    for bad in (good + bytes(50 << 20), good + b"x", good[:-2], good.replace(b"WARC/1.1", b"HTTP/1.1"), bytes(50 << 20), b"WARC/1.1\r\nContent-Length: 99999999999\r\n\r\n"):
        with pytest.raises(warc.WarcError):
            list(warc.records(io.BytesIO(_member(bad))))


def test_rows_repeated_in_all_columns_are_one_response(spark):
    data = [(1, "u", "same")] * 9000 + [(1, "t", "same"), (2, "u", "same"), (3, "u", "other"), (3, "u", "other"), (None, "u", "none"), (None, "u", "none")]
    got = warc.digest_table(spark, spark.createDataFrame(data, "page_id long, url string, html string").repartition(6)).collect()
    count = {}
    for r in got:
        key = (r["page_id"], r["record_type"], r["refers_to"])
        count[key] = count.get(key, 0) + 1
    assert count == {(1, "response", None): 1, (1, "revisit", 1): 9000, (2, "revisit", 1): 1, (3, "response", None): 1, (3, "revisit", 3): 1, (None, "response", None): 1, (None, "revisit", None): 1}


def test_archives_hold_all_pages(spark):
    data = [(1, "u", "<p>x</p>"), (2, "u", "<p>x</p>"), (3, None, None), (4, "a\r\nb", ""), (5, "u", "é" * 200_000), (None, "u", "<p>x</p>"), (7, "u", "only")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS payload")
    got = {r["page_id"]: r for r in warc.digest_table(spark, pages).collect()}
    assert len(got) == len(data)
    for page_id, _, html in data:
        b = (html or "").encode()
        assert got[page_id]["payload_bytes"] == len(b)
        assert got[page_id]["payload_digest"] == base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert {k: (r["record_type"], r["refers_to"]) for k, r in got.items() if r["record_type"] == "revisit"} == {2: ("revisit", 1), None: ("revisit", 1), 4: ("revisit", 3)}
    texts = {r["record_id"]: r["payload"] for r in warc.read(warc.write(pages)).collect()}
    assert bytes(texts["5"]).decode() == "é" * 200_000 and texts["2"] is None
    assert warc.digest_table(spark, pages.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 50), min_size=1, max_size=700), st.sampled_from([50, 90, 100]))
def test_blocks_round_trip(ids, percentile):
    ids = np.array(ids + [ids[-1]] * (-len(ids) % token_file.BLOCK), np.uint32)
    data, sizes = token_file.encode_blocks(ids, percentile)
    assert (token_file.decode_blocks(np.frombuffer(data, np.uint8), np.cumsum(sizes) - sizes) == ids).all()


def test_reader_reads_any_part(spark, tmp_path):
    ids = np.random.default_rng(1).zipf(1.3, 5000).astype(np.uint32) % 50_000
    w = token_file.Writer(f"file://{tmp_path}/x.pfor", chunk_blocks=4)
    cuts = [0, 1, 1, 130, 4000, 5000]
    for a, b in zip(cuts, cuts[1:], strict=False):
        w.add(np.array([a]), np.array([0]), np.array([b - a]), ids[a:b])
    w.close()
    r = token_file.Reader(f"file://{tmp_path}/x.pfor")
    for a, n in ((0, 1), (127, 2), (4999, 1), (100, 3000), (7, 0)):
        assert (r.ids(a, n) == ids[a : a + n]).all()
    assert [len(x) for _, _, x in r.documents(most=50)] == np.diff(cuts).tolist()


def test_token_files_equal_the_library(spark):
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    data = odd.rows()
    got = token_file.digest_table(spark, odd.documents(spark, data).repartition(5), path).collect()
    start, want = 0, []
    for key, text in sorted(((r[0], r[1] or "") for r in data), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode())):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        want.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_file.digest_table(spark, odd.documents(spark, []), path).count() == 0


def test_shuffled_tables_are_written_in_order(spark):
    """Layouts that adaptive coalescing and column pruning change between two jobs: files must hold disjoint ranges of ids."""
    path = queries.vocabulary("word_bpe_49k.json")
    docs = odd.documents(spark, [(i, f"text number {i} " + odd.words(random.Random(i), 20), "en", "s", 0, "", "", "") for i in range(1500)])
    sixteen = "spark.sql.shuffle.partitions"
    before = spark.conf.get(sixteen)
    spark.conf.set(sixteen, "16")
    try:
        want = None
        ids = docs.select("doc_id").distinct()
        for table in (docs, docs.repartition("doc_id"), docs.distinct(), docs.join(ids.hint("merge"), "doc_id"), docs.groupBy("doc_id").agg(F.max("text").alias("text"))):
            files = sorted(token_file.write(table, path).collect(), key=lambda r: r["first_id"])
            assert all(a["last_id"] < b["first_id"] for a, b in zip(files, files[1:], strict=False))
            got = sorted(map(tuple, token_file.digest_table(spark, table, path).collect()))
            want = want or got
            assert got == want and [r[0] for r in got] == list(range(1500)) and all(b[1] == a[1] + a[2] for a, b in zip(got, got[1:], strict=False))
    finally:
        spark.conf.set(sixteen, before)


def test_pages_of_equal_ids(spark):
    pages = spark.createDataFrame([(1, "u", "a"), (1, "u", "b"), (1, "u", "a"), (2, "u", "b")], "page_id long, url string, html string")
    got = sorted((r["page_id"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.digest_table(spark, pages).collect())
    assert len(got) == 4 and [r[0] for r in got] == [1, 1, 1, 2] and got[3][2:] == ("revisit", 1)


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    from eventfold.llm import words

    monkeypatch.setattr(words, "hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(2))
    text = b"one two three one four fifth two one"
    data = np.frombuffer(text, np.uint8)
    starts = np.array([i for i in range(len(text)) if text[i : i + 1] != b" " and (i == 0 or text[i - 1 : i] == b" ")])
    ends = np.array([(text + b" ").index(b" ", i) for i in starts])
    own, at = words.distinct_ranges(data, starts, ends)
    assert [own[i] for i in at] == text.split() and len(own) == 5


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"ab .,'!Éσ\n\t ", "<|endoftext|>", "'ll", "5"]), max_size=30), min_size=1, max_size=6))
def test_words_give_the_ids_of_texts(texts):
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    texts = ["".join(t) for t in texts]
    ids, counts = token_file.encode_texts([t.encode() for t in texts], token_file.word_encoder(path), 1)
    want = [e.ids + [1] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
