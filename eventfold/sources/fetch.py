"""Pages by an injected fetcher: one request at a time for each host, many hosts at once, an error in a column instead of a failed job."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import pages, shared

RESULT = "url string, html string, status int, error string"
FINAL = (404, 410)


def many(urls: DataFrame, fetch: Callable[[str], dict], *, url_col: str = "url", pause: float = 0.3, partitions: int | None = None) -> DataFrame:
    """url, html, status, error of each distinct url. fetch gives a dict of html (or content and charset), status and error; what it raises becomes the error, and so does a page that turns robots away."""
    n = partitions or int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = urls.select(F.col(url_col).alias("url")).where(text.blank(F.col("url")) != "").dropDuplicates(["url"]).withColumn("host", text.host(F.col("url")))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for part in parts:
            out = []
            for url, host in zip(part["url"], part["host"], strict=True):
                if host == last and pause:
                    time.sleep(pause)
                last = host
                got = pages.answer(fetch, url)
                out.append((url, got["html"], got["status"], got["error"]))
            yield pd.DataFrame(out, columns=["url", "html", "status", "error"])

    return rows.repartition(n, "host").sortWithinPartitions("host", "url").mapInPandas(run, RESULT)


def two_tiers(urls: DataFrame, cheap: Callable[[str], dict], dear: Callable[[str], dict], *, dear_partitions: int = 5, pause: float = 0.3) -> DataFrame:
    """All urls by the cheap fetcher; what failed but for good, or shows nothing without scripts, by the dear one, a few at a time. Each tier's pages are written once, so no page is asked for twice."""
    first = shared.once(many(urls, cheap, pause=pause), "pages-cheap")
    again = ~F.coalesce(F.col("status").isin(*FINAL), F.lit(False)) & (F.col("error").isNotNull() | text.js_shell(F.coalesce("html", F.lit(""))))
    retry = first.where(again)
    second = shared.once(many(retry, dear, pause=pause, partitions=dear_partitions), "pages-dear")
    better = second.where("error is null")
    return first.join(better.select("url"), "url", "left_anti").unionByName(better)
