"""Organisations from tables with headers of any wording."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed

NEEDED = ("organizer", "url")


def mapping(headers: list[str]) -> dict[str, str]:
    """For each field the leftmost header that contains one of its aliases; a header may serve several fields."""
    out: dict[str, str] = {}
    for field, aliases in fixed.HEADER_ALIASES.items():
        for h in headers:
            if any(a in h.strip().lower() for a in aliases):
                out[field] = h
                break
    return out


def read(df: DataFrame, order: str | None = None) -> DataFrame:
    """ord, organizer, category, country, url of the rows that have a url."""
    found = mapping([c for c in df.columns if c != order])
    if missing := [f for f in NEEDED if f not in found]:
        raise ValueError(f"no column for {', '.join(missing)} among {df.columns}")
    cell = lambda f: (F.col(f"`{found[f]}`") if f in found else F.lit(None)).cast("string").alias(f)
    ord_ = F.col(f"`{order}`") if order else F.monotonically_increasing_id()
    return df.select(ord_.alias("ord"), *[cell(f) for f in fixed.HEADER_ALIASES]).where(F.coalesce(F.trim("url"), F.lit("")) != "")
