"""From raw documents to encoded training text: toxic documents out, documents of poor quality out, one of each group of near
copies, sources mixed to their weights, texts encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Near copies share
five-word shingles at a Jaccard similarity of 0.8 or more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfold.llm import jaccard, mixing, quality, sentencepieces, store, toxicity
from eventfold.llm.queries import vocabulary


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold, decided in the one pass that reads their texts. All labelled rows but those of the held-out fold teach."""
    return toxicity.reject(docs, _labels(spark, sf_dir))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's limit: each row by its own verdict, whatever its id."""
    kept = quality.judge(docs, _labels(spark, sf_dir), keyed=True).where("keep").select("row_key").distinct()
    return docs.withColumn("row_key", quality.row_key()).join(kept, "row_key", "left_semi").select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the least id, then the least key; rows without an id come last. Each row stands for itself, so unrelated
    texts of equal id both stay, and rows without an id are joined as well. Rows that are equal in all columns are one."""
    rows = docs.withColumn("row_digest", F.unhex(store.row_digest(docs))).withColumn("row_key", F.xxhash64("row_digest"))
    found = jaccard.classes(rows.select("row_key", "text"), words_each=5, top=80, base=100, id_col="row_key").select(F.col("doc_id").alias("row_key"), "component_id").distinct()
    ids = rows.select("row_key", F.col("doc_id").cast("long").alias("doc_id")).distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))["row_key"]
    kept = found.join(ids, "row_key").groupBy("component_id").agg(first.alias("row_key")).select("row_key")
    return rows.join(kept, "row_key", "left_semi").dropDuplicates(["row_digest"]).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeat(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, n_tokens, ids_crc32, parity and round_trip of each copy."""
    return sentencepieces.encode(docs, vocabulary("piece_bpe_32k.model"), keep=("doc_id", "source"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", not_toxic),
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]

#: Trained models, hashed chances and tokenizers can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = store.cut(out, f"pipeline-{i}") if i < len(STAGES) - 1 else out
    return docs
