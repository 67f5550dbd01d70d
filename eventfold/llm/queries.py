"""The thin queries over the operators, in the columns that their contracts state, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mtree

    return mtree.top_k(_table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    return toxicity.verdicts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import vptree

    return vptree.nearest(_table(spark, sf_dir, "embeddings"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import sentencepieces

    return sentencepieces.encode(_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op7_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import edit_counts

    docs = edit_counts.three_edits(_table(spark, sf_dir, "documents"))
    return edit_counts.recount(docs, vocabulary("byte_bpe_50k.tiktoken"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import jaccard

    return jaccard.classes(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing

    return mixing.mix_table(_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc

    return warc.digest_table(spark, _table(spark, sf_dir, "pages"))


def op10_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import token_file

    return token_file.digest_table(spark, _table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import lexical

    return lexical.search(lexical.build(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


def op12_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import ppm

    return ppm.pretrained(_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import filter_audit

    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_mtree": op2_mtree,
        "op3_toxicity": op3_toxicity,
        "op8_vptree": op8_vptree,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_jaccard": op5_jaccard,
        "op6_mixing": op6_mixing,
        "op7_edit_counts": op7_edit_counts,
        "op9_warc": op9_warc,
        "op10_token_file": op10_token_file,
        "op11_lexical": op11_lexical,
        "op12_ppm": op12_ppm,
        "op13_filter_audit": op13_filter_audit,
    }


MTREE_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""

JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
f AS (SELECT doc_id, len(sh) AS n, md5(CAST(list_sort(sh) AS VARCHAR)) AS h, sh FROM s),
r AS (SELECT min(doc_id) AS rep, h, any_value(n) AS n, any_value(sh) AS sh FROM f WHERE n > 0 GROUP BY h),
x AS (SELECT rep, n, unnest(sh) AS t FROM r),
o AS (SELECT a.rep AS a, b.rep AS b, count(*) AS hits, any_value(a.n) AS na, any_value(b.n) AS nb FROM x a JOIN x b ON a.t = b.t AND a.rep < b.rep AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n) GROUP BY 1, 2),
l AS (SELECT a, b FROM o WHERE 100 * hits >= 90 * (na + nb - hits)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
c(node, seen) AS (SELECT DISTINCT a, a FROM e UNION SELECT c.node, e.b FROM c JOIN e ON c.seen = e.a),
m AS (SELECT node, min(seen) AS component FROM c GROUP BY node)
SELECT f.doc_id, CAST(f.n AS BIGINT) AS n_shingles, CASE WHEN f.n = 0 THEN f.doc_id ELSE coalesce(m.component, r.rep) END AS component_id
FROM f LEFT JOIN r ON f.h = r.h AND f.n > 0 LEFT JOIN m ON r.rep = m.node
"""

WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + CAST((CAST('0x' || substr(h, CAST(10 * (i // 8) + 1 AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31 AS BIGINT), 1)), '') AS b, min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, b AS payload_digest, CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to FROM d
"""


#: Scores of all documents that share a term with an item, and the ten best of each.
LEXICAL_SQL = r"""
WITH lower AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents WHERE text IS NOT NULL),
d AS (SELECT row_number() OVER () AS row, doc_id, ts, CAST(len(ts) AS BIGINT) AS own FROM lower WHERE len(ts) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(own) AS BIGINT) AS every FROM d),
p AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(ts) AS term FROM d) GROUP BY 1, 2),
q AS (SELECT item, term, count(*) AS repeats FROM (SELECT row_number() OVER () AS item, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark) GROUP BY 1, 2),
i AS (SELECT row_number() OVER () AS item, item_id FROM benchmark),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s WHERE term IN (SELECT term FROM q) GROUP BY 1),
x AS (SELECT item, row, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * own * docs) // every)))) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN p USING (term) JOIN d USING (row), s GROUP BY 1, 2),
r AS (SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x JOIN d USING (row) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r JOIN i USING (item) WHERE rank <= 10
"""

#: Each order's steps counted over the rows themselves, without any transform.
AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
m AS (SELECT part, (CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) THEN 4 ELSE 0 END) + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN least < doc_id THEN 16 ELSE 0 END) AS mask,
    CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) THEN 1 ELSE 0 END AS good,
    CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) THEN 1 ELSE 0 END AS toxic FROM w),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits FROM l p JOIN l q ON q.b <> p.b JOIN l r ON r.b NOT IN (p.b, q.b)
  JOIN l s ON s.b NOT IN (p.b, q.b, r.b) JOIN l t ON t.b NOT IN (p.b, q.b, r.b, s.b)),
st AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[:step - 1]), 0) AS pre FROM o, (SELECT unnest(range(1, 6)) AS step)),
g AS (SELECT part, filter_order, step, own, sum(CASE WHEN mask & (CAST(pre AS INTEGER) | own) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & CAST(pre AS INTEGER) = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS removed, sum(CASE WHEN mask & own <> 0 AND mask & CAST(pre AS INTEGER) <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN mask & CAST(pre AS INTEGER) = 0 AND mask & own <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & CAST(pre AS INTEGER) = 0 AND mask & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost FROM c, st GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM g
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_mtree": MTREE_SQL, "op5_jaccard": JACCARD_SQL, "op9_warc": WARC_SQL, "op11_lexical": LEXICAL_SQL, "op13_filter_audit": AUDIT_SQL}
