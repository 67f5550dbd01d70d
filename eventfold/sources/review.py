"""Batches for an outside reviewer, and its verdicts by id."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

TRIES, PAUSE = 4, 20.0
ANSWER = "id string, answer string, tokens_in long, tokens_out long, error string"


def batches(df: DataFrame, key: str, size: int) -> DataFrame:
    """Numbers the rows in order of a key and cuts them into batches. Rows are numbered by range partitions with counts before them, so no task holds them all."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, key).withColumn("_p", F.spark_partition_id())
    within = dealt.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(key)) - 1)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    base = within.groupBy("_p").agg(F.count("*").alias("_n")).withColumn("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return within.join(base.select("_p", "_b"), "_p").withColumn("batch", F.floor((F.col("_i") + F.col("_b")) / size).cast("long")).drop("_p", "_i", "_b")


def keep(df: DataFrame, verdicts: DataFrame, key: str) -> DataFrame:
    """Rows with keep: false only where a verdict says so; without one a row stays."""
    return df.join(verdicts.select(key, "verdict"), key, "left").withColumn("keep", F.coalesce("verdict", F.lit(True))).drop("verdict")


def passing(e: Exception) -> bool:
    """Whether it may help to ask again: too many requests, or the other side's own fault."""
    code = getattr(e, "code", None)
    return code == 429 or (isinstance(code, int) and 500 <= code < 600)


def ask(rows: DataFrame, call: Callable[[str], dict], *, tries: int = TRIES, pause: float = PAUSE, again: Callable[[Exception], bool] = passing) -> DataFrame:
    """id, answer, tokens_in, tokens_out and error of each row (id, prompt). call gives a dict of answer, tokens_in and tokens_out; what it raises is asked again a few times
    if that may help, and becomes the row's error otherwise."""

    def one(id_: str, prompt: str) -> tuple:
        for left in reversed(range(tries)):
            try:
                got = call(prompt)
                return id_, got.get("answer"), got.get("tokens_in", 0), got.get("tokens_out", 0), None
            except Exception as e:  # the call's own failure, kept as data
                if not left or not again(e):
                    return id_, None, 0, 0, f"{type(e).__name__}: {e}"[:120]
                time.sleep(pause)
        raise ValueError("tries must be 1 or more")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([one(*r) for r in zip(part["id"], part["prompt"], strict=True)], columns=["id", "answer", "tokens_in", "tokens_out", "error"])

    return rows.select(F.col("id").cast("string").alias("id"), "prompt").mapInPandas(run, ANSWER)


def ask_within(rows: DataFrame, call: Callable[[str], dict], *, cap: float, price_in: float, price_out: float, at_once: int, **how: object) -> DataFrame:
    """ask's columns and cost of every row, asked in rounds of at_once rows in order of id until the cost of the rounds reaches the cap (so it is passed by less than a round);
    the rest has the error 'budget'. Prices are for a million tokens. Each round is written before the next begins, so nothing is paid for twice."""
    dealt = shared.once(batches(rows, "id", at_once), "asked-for")
    last, spent, done = dealt.agg(F.max("batch")).first()[0], 0.0, []
    cost = ((F.col("tokens_in") * price_in + F.col("tokens_out") * price_out) / 1e6).alias("cost")
    for i in range(-1 if last is None else last + 1):
        if spent >= cap:
            break
        done.append(shared.once(ask(dealt.where(F.col("batch") == i), call, **how).select("*", cost), "answers"))
        spent += done[-1].agg(F.sum("cost")).first()[0] or 0.0
    rest = dealt.where(F.col("batch") >= len(done)).select(F.col("id").cast("string").alias("id"), F.lit(None).cast("string").alias("answer"), *[F.lit(0).cast("long").alias(x) for x in ("tokens_in", "tokens_out")], F.lit("budget").alias("error"), F.lit(0.0).alias("cost"))
    out = rest
    for d in done:
        out = out.unionByName(d)
    return out
