"""Web pages as a data source: spark.read.format("pages") over a list of addresses that was dealt out by site.

    deal(urls, folder)                                   # once: whole sites to a folder for each reader
    spark.dataSource.register(Pages)
    spark.read.format("pages").option("fetcher", "package.module:function").load(folder)

A reader asks for one page at a time, and all pages of a site are one reader's, so no site gets two requests at once; sites of different readers go side by side. What a page's answer lacks is mended or
said in columns: the character set, an error, a page that only says that robots aren't welcome. The fetcher is named by its module, as it runs in the workers; it takes an address and gives a dict of content (bytes)
or html (text), status, charset and error.
"""

from __future__ import annotations

import codecs
import importlib
import re
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import fixed, text

SCHEMA = "url string, site string, html string, status int, charset string, blocked boolean, error string"
_META = re.compile(rb"<meta[^>]{0,200}?charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.I)


def known(charset: str | None) -> str | None:
    try:
        return codecs.lookup(charset).name if charset else None
    except LookupError:
        return None


def decoded(content: bytes, declared: str | None) -> tuple[str, str]:
    """A page's text and its character set: what is declared, but that Latin-1 (which servers say when they say nothing) and none at all are taken for UTF-8 if that can be read, else for what the page itself
    names, else for Windows' Western set. Bytes that stay odd become U+FFFD."""
    said = known(declared)
    if said and said != "iso8859-1":
        return content.decode(said, errors="replace"), said
    try:
        return content.decode("utf-8"), "utf-8"
    except UnicodeDecodeError:
        pass
    own = _META.search(content[:4096])
    charset = known(own[1].decode()) if own else None
    charset = charset if charset and charset != "utf-8" else "cp1252"
    return content.decode(charset, errors="replace"), charset


def refused(html: str) -> bool:
    """A short page that says that it isn't for robots."""
    low = html.lower()
    return len(html) <= fixed.BLOCK_LENGTH and any(m in low for m in fixed.BLOCK_MARKERS)


def answer(fetch: Callable[[str], dict], url: str) -> dict:
    """A row of SCHEMA; what fetch raises becomes the error, and a page with an error has no html."""
    try:
        got = fetch(url)
    except Exception as e:  # the page's own failure, kept as data
        got = {"error": f"{type(e).__name__}: {e}"[:120]}
    status, error, html, charset = got.get("status"), got.get("error"), got.get("html"), None
    if html is None and got.get("content") is not None:
        html, charset = decoded(got["content"], got.get("charset"))
    if not error and status and status >= 400:
        error = f"HTTP {status}"
    blocked = not error and html is not None and refused(html)
    error = fixed.BLOCKED if blocked else error
    return {"url": url, "site": site_of(url), "html": None if error else html, "status": status, "charset": charset, "blocked": blocked, "error": error}


def site_of(url: str) -> str:
    return urlsplit(url).netloc.lower()


def site(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def deal(urls: DataFrame, folder: str, readers: int = 20, url_col: str = "url") -> None:
    """Writes the distinct addresses for so many readers, each site for one. A site with very many pages is its reader's longest; its pages can't be asked for side by side."""
    rows = urls.select(F.col(url_col).alias("url")).where(text.blank(F.col("url")) != "").distinct()
    rows = rows.withColumn("site", site(F.col("url"))).withColumn("reader", F.pmod(F.xxhash64("site"), F.lit(readers)).cast("int"))
    rows.repartition(readers, "reader").sortWithinPartitions("reader", "site", "url").write.partitionBy("reader").parquet(folder)


class Part(InputPartition):
    def __init__(self, folder: str):
        self.folder = folder


class PageReader(DataSourceReader):
    def __init__(self, folder: str, fetcher: str, pause: float):
        self.folder, self.fetcher, self.pause = folder, fetcher, pause

    def partitions(self) -> list[Part]:
        fs, path = pafs.FileSystem.from_uri(self.folder) if "://" in self.folder else (pafs.LocalFileSystem(), self.folder)
        found = fs.get_file_info(pafs.FileSelector(path))
        return [Part(f.path) for f in sorted(found, key=lambda f: f.path) if f.base_name.startswith("reader=")]

    def read(self, partition: Part) -> Iterator[tuple]:
        module, _, name = self.fetcher.partition(":")
        fetch, last = getattr(importlib.import_module(module), name), None
        fs = pafs.FileSystem.from_uri(self.folder)[0] if "://" in self.folder else pafs.LocalFileSystem()
        names = [f.path for f in fs.get_file_info(pafs.FileSelector(partition.folder)) if f.path.endswith(".parquet")]
        for file in sorted(names):
            for batch in pq.ParquetFile(fs.open_input_file(file)).iter_batches(columns=["url"]):
                for url in batch.column("url").to_pylist():
                    if site_of(url) == last and self.pause:
                        time.sleep(self.pause)
                    last = site_of(url)
                    row = answer(fetch, url)
                    yield tuple(row[c.split()[0]] for c in SCHEMA.split(", "))


class Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:  # noqa: ANN001
        for wanted in ("path", "fetcher"):
            if wanted not in self.options:
                raise ValueError(f"the option {wanted} is missing")
        return PageReader(self.options["path"], self.options["fetcher"], float(self.options.get("pause", "0.3")))
