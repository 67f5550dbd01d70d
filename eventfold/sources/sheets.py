"""Raw tables of one country: read whatever columns they have, narrowed to what may still come, and written in order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text

RAW = ("date", "status", "event_name", "organizer", "category", "format", "location", "description", "link", "source_url")
CUTOFF = dt.date(2026, 1, 1)


def tolerant(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ("ord",)) -> DataFrame:
    """The columns of keep as they are and the named ones as text without outer white space; absent ones and nulls are empty, others go."""
    there = set(df.columns)
    return df.select(*keep, *[(text.blank(F.col(f"`{c}`")) if c in there else F.lit("")).alias(c) for c in columns])


def upcoming(raw: DataFrame) -> DataFrame:
    """ord, event_name, organizer, link, source_url of the rows with a name that aren't marked as past. What a list says of date, format and place isn't taken from here."""
    rows = tolerant(raw, RAW).where((F.col("status") != "Past") & (F.col("event_name") != ""))
    return rows.select("ord", "event_name", "organizer", "link", "source_url")


def refreshed(raw: DataFrame, today: dt.date, cutoff: dt.date = CUTOFF) -> DataFrame:
    """Raw rows by day, undated ones last, with status set anew; rows dated before the cutoff go. day is the date that was read."""
    rows = tolerant(raw, RAW).withColumn("day", dates.lenient(F.col("date"), today)["start"])
    rows = rows.where(F.coalesce(F.col("day") >= F.lit(cutoff), F.lit(True)))
    return rows.withColumn("status", F.when(dates.is_past(F.col("day"), today), "Past").otherwise("Upcoming")).orderBy(F.col("day").asc_nulls_last(), "ord")


def failed(spark: SparkSession, path: str) -> DataFrame:
    """organizer, url, error of the sites that snapshots.failures wrote."""
    return spark.read.option("header", True).option("multiLine", True).schema("organizer string, url string, error string").csv(path)


def of_organisation(pages: DataFrame, keys: Sequence[str] = ("source_url",), order: str = "page") -> DataFrame:
    """Rows that the pages of one organisation list (keys, order, link, event_name, date), each link, name and date once: the one of the earliest page."""
    same = [*keys, "link", *[F.lower(text.blank(F.col(c))) for c in ("event_name", "date")]]
    return pages.groupBy(*[(F.col(k) if isinstance(k, str) else k).alias(f"_k{i}") for i, k in enumerate(same)]).agg(F.min_by(F.struct(*pages.columns), order).alias("_r")).select("_r.*")
