"""One row for each key, by rules that don't depend on partitions: the order is always a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fullness(columns: Sequence[str]) -> Column:
    """How many of the cells say something."""
    said = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", 1).otherwise(0) for c in columns]
    out = F.lit(0)
    for s in said:
        out = out + s
    return out


def keep_fullest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """The row with most cells filled for each key, the first of equals. max_by aggregates before it shuffles, so hot keys cost one row a task."""
    ks = [F.col(k) if isinstance(k, str) else k for k in keys]
    rank = F.struct(fullness(columns or df.columns), *[-F.col(o) for o in order])
    return df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(ks)]).agg(F.max_by(F.struct(*df.columns), rank).alias("_r")).select("_r.*")


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    ks = [F.col(k) if isinstance(k, str) else k for k in keys]
    return df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(ks)]).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*")


def suffix_ids(df: DataFrame, id_col: str, order: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """The second row of an id gets ~2 after it, the third ~3; a suffix that an id of its own has already is passed over."""
    w = Window.partitionBy(*within, id_col).orderBy(*order)
    nth = F.row_number().over(w)
    taken = df.where(F.col(id_col).rlike(r"~\d+$")).groupBy(*within, F.regexp_replace(id_col, r"~\d+$", "").alias("_base")).agg(F.collect_set(F.regexp_extract(id_col, r"~(\d+)$", 1).try_cast("int")).alias("_taken"))
    named = df.withColumn("_n", nth)
    on = [*within]
    joined = named.withColumn("_base", F.col(id_col)).join(taken, [*on, "_base"], "left")
    free = F.filter(F.sequence(F.lit(2), F.col("_n") + F.size(F.coalesce("_taken", F.array().cast("array<int>"))) + 1), lambda x: ~F.array_contains(F.coalesce("_taken", F.array().cast("array<int>")), x))
    return joined.withColumn(id_col, F.when(F.col("_n") == 1, F.col(id_col)).otherwise(F.concat(F.col(id_col), F.lit("~"), F.try_element_at(free, F.col("_n") - 1)))).select(*df.columns)


def recent(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 50) -> DataFrame:
    """The newest n rows of each key; the rank is limited before the shuffle."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")
