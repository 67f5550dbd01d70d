import random
import struct

import pytest
import sentencepiece
import tiktoken

from pyspark.sql import functions as F

from eventfold.llm import edit_counts, queries, sentencepieces, store

from . import odd


def test_parity_and_round_trip_on_texts():
    path = queries.vocabulary("piece_bpe_32k.model")
    own, library = sentencepieces.encoder(path), sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(1)
    texts = ["", " a", "a\n b\n\n  c", "<s> </s> <0x0A>", "▁x ▁", "\x00a", "x　y", "😀"] + ["".join(r.choice(" \n ab,.é漢▁") for _ in range(r.randint(0, 40))) for _ in range(500)]
    ids, flags = own.encode([t.encode() for t in texts])
    assert [x.tolist() for x in ids] == library.encode(texts)
    assert not (flags & sentencepieces.APART).any()
    assert all(bool(f & sentencepieces.ONE_WAY) == (own.whole.decode(x.tolist()) != t) for f, x, t in zip(flags, ids, texts, strict=True))
    assert [own.whole.encode(t, add_special_tokens=False).ids for t in texts] == library.encode(texts)
    assert all(own.whole.decode(x.tolist()) == t for x, t in zip(ids, texts, strict=True) if "▁" not in t)


def test_ids_are_replaced_where_the_libraries_differ():
    own = sentencepieces.Encoder(queries.vocabulary("piece_bpe_32k.model"))
    real = own.differ
    own.differ = lambda keys, got: sorted({*real(keys, got), *[i for i, k in enumerate(keys) if k == "river"]})
    ids, flags = own.encode([b"a river here", b"no such word"])
    assert flags.tolist() == [sentencepieces.APART, 0]
    assert [x.tolist() for x in ids] == own.library.encode(["a river here", "no such word"])


def field(number: int, kind: int, value: bytes | int) -> bytes:
    def varint(n: int) -> bytes:
        return bytes([n & 127 | 128]) + varint(n >> 7) if n > 127 else bytes([n])

    return varint(number << 3 | kind) + (varint(value) if kind == 0 else value if kind == 5 else varint(len(value)) + value)


def model_file(pieces: list[tuple[str, float, int]], kind: int, byte_fallback: bool, one_space: bool, charsmap: bytes = b"") -> bytes:
    out = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", x)) + field(3, 0, k)) for p, x, k in pieces)
    out += field(2, 2, field(3, 0, kind) + field(35, 0, int(byte_fallback)) + field(40, 0, 0) + field(41, 0, 1) + field(42, 0, 2))
    return out + field(3, 2, field(1, 2, b"x") + (field(2, 2, charsmap) if charsmap else b"") + field(3, 0, 1) + field(4, 0, int(one_space)) + field(5, 0, 1))


@pytest.mark.parametrize(("fallback", "one_space"), [(True, False), (False, True), (False, False)])
def test_unigram_model_files_give_the_librarys_ids(spark, tmp_path, fallback, one_space):
    r = random.Random(5)
    parts = [p for p, _, k in sentencepieces.parse(open(queries.vocabulary("piece_bpe_32k.model"), "rb").read()).pieces if k == sentencepieces.NORMAL][:4000]
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)] * fallback
    pieces += [(p, -3 - 10 * r.random(), 1) for p in parts]
    (tmp_path / "u.model").write_bytes(model_file(pieces, sentencepieces.UNIGRAM, fallback, one_space))
    path = str(tmp_path / "u.model")
    data = [d for d in odd.rows(40) if "\x00" not in (d[1] or "")] + [(5000, "two  spaces,   three ", "en", "s", 0, "", "", ""), (5001, "\n line\n\n漢字 😀", "en", "s", 0, "", "", "")]
    got = sentencepieces.encode(odd.documents(spark, data), path, keep=("doc_id", "text")).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    assert len(got) == len(data) and all(x["ids"] == library.encode(x["text"] or "") for x in got)
    plain = [x for x in got if x["text"] and x["text"].isascii()]
    assert plain and all(x["parity"] for x in plain)


def test_models_of_both_kinds_can_be_rebuilt():
    unigram = sentencepieces.Model([("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("b", -2.0, 1), ("▁ab", -1.5, 1), ("▁", -3.0, 1), ("a", -3.0, 1)], sentencepieces.UNIGRAM, False, 0, b"", True, True, True)
    t = sentencepieces.rebuild(unigram)
    assert [unigram.pieces[i][0] for i in t.encode(" ab  a b ").ids] == ["▁ab", "▁a", "▁", "b"]
    assert t.decode(t.encode("ab a b").ids) == "ab a b"


def test_encode_and_decode_tables(spark):
    path = queries.vocabulary("piece_bpe_32k.model")
    data = odd.rows()
    encoded = sentencepieces.encode(odd.documents(spark, data), path, keep=("doc_id", "score"))
    got = encoded.collect()
    assert len(got) == len(data) and all(r["parity"] for r in got)
    assert all(r["round_trip"] for r in got if r["doc_id"] != 1009)
    back = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"]) for r in sentencepieces.decode(encoded, path).collect() if r["doc_id"] != 1009)
    assert back == sorted((d[0] is not None, d[0] or 0, d[1] or "") for d in data if d[0] != 1009)
    assert sentencepieces.encode(odd.documents(spark, []), path).count() == 0


def _full(own, text):
    return len(tiktoken.Encoding("t", pat_str=edit_counts.PATTERN, mergeable_ranks=own.library._mergeable_ranks, special_tokens={}).encode_ordinary(text))


def test_counts_follow_edits():
    own = edit_counts.counter(queries.vocabulary("byte_bpe_50k.tiktoken"))
    r, letters = random.Random(3), " \n\tab'stdlve1,.é漢   "
    for k in range(400):
        text = "".join(r.choice(letters) for _ in range(r.choice([0, 1, 50, 3000]) if k % 20 == 0 else r.randint(0, 60)))
        tree = edit_counts.Tree(text, own)
        for _ in range(r.randint(1, 5)):
            start, length = r.randint(-1, len(text) + 2), r.randint(-1, r.choice([1, 4, 200]))
            new = "".join(r.choice(letters) for _ in range(r.randint(0, r.choice([0, 3, 300]))))
            tree.edit(start, length, new)
            a = min(max(start, 0), len(text))
            text = text[:a] + new + text[a + max(length, 0) :]
            assert tree.text() == text and tree.n_chars == len(text) and tree.n_tokens == _full(own, text)


def test_few_pieces_are_encoded_again():
    own = edit_counts.counter(queries.vocabulary("byte_bpe_50k.tiktoken"))
    tree = edit_counts.Tree("some words of text " * 5000, own)
    before = tree.encoded
    tree.edit(40_000, 4, "other")
    assert tree.encoded - before < 12


def test_recount_table(spark):
    path = queries.vocabulary("byte_bpe_50k.tiktoken")
    own = edit_counts.counter(path)
    data = odd.rows()
    docs = odd.documents(spark, data)
    got = edit_counts.recount(edit_counts.three_edits(docs), path).collect()
    assert sorted(r["n_before"] for r in got) == sorted(_full(own, d[1] or "") for d in data)

    def edited(text, edits):
        for e in edits:
            a = min(max(e["start"], 0), len(text))
            text = text[:a] + e["text"] + text[a + e["length"] :]
        return text

    want = sorted((r["doc_id"] or -1, _full(own, edited(r["text"] or "", r["edits"])), len(edited(r["text"] or "", r["edits"]))) for r in edit_counts.three_edits(docs).collect())
    assert sorted((r["doc_id"] or -1, r["n_after"], r["n_chars"]) for r in got) == want
    long = next(r for r in got if r["doc_id"] == 1008)
    assert long["n_pieces"] > 30_000 and long["n_encoded"] < 100
    edits = spark.createDataFrame([(1, 2, 0, 1, None), (1, 1, 0, 0, "new "), (1004, 1, 3, 900, "!"), (1000, 1, 5, 5, "text")], "doc_id long, seq int, start int, length int, text string")
    got = {r["doc_id"]: r["n_after"] for r in edit_counts.recount(edit_counts.with_edits(docs, edits), path).collect()}
    assert got[1] == _full(own, "ew " + data[1][1]) and got[1004] == _full(own, "one!") and got[1000] == _full(own, "text")
    assert edit_counts.recount(edit_counts.three_edits(odd.documents(spark, [])), path).count() == 0


def test_kept_trees_take_later_edits(spark):
    """Trees written once take two rounds of edits; what no edit touches isn't encoded again."""
    path = queries.vocabulary("byte_bpe_50k.tiktoken")
    own = edit_counts.counter(path)
    data = odd.rows(20)
    docs = odd.documents(spark, data).withColumn("edits", F.lit("a clashing name"))
    trees = store.cut(edit_counts.grown(docs, path, keep=("doc_id", "edits")), "trees")
    shape = "doc_id long, seq int, start int, length int, text string"
    first = spark.createDataFrame([(1008, 1, 50_000, 3, "new words"), (1, 1, 0, 0, "x ")], shape)
    second = spark.createDataFrame([(1008, 1, 10, 500, "")], shape)
    once = store.cut(edit_counts.apply(edit_counts.with_edits(trees, first), path), "trees")
    twice = {r["doc_id"]: r for r in edit_counts.apply(edit_counts.with_edits(once, second), path).collect() if r["doc_id"] is not None}
    text = next(d[1] for d in data if d[0] == 1008)
    text = text[:50_000] + "new words" + text[50_003:]
    text = text[:10] + text[510:]
    assert twice[1008]["text"] == text and twice[1008]["n_after"] == _full(own, text)
    assert 0 < twice[1008]["n_encoded"] < 50 and all(r["n_encoded"] == 0 for k, r in twice.items() if k != 1008)
    assert twice[1]["n_before"] == _full(own, "x " + data[1][1]) and twice[1000]["n_after"] == 0
