"""The registered queries and the SQL that says the same for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str | None], key: str) -> Column:
    """The value whose place is the key's remainder by their number."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int"))


def literal(x: object) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x).upper()
    return str(x) if isinstance(x, int | float) else "'" + str(x).replace("'", "''") + "'"


def cases_sql(table_: str, key: str, names: list[str], rows: list[tuple]) -> str:
    """Every row of a table with the expected results of the case that its key chooses."""
    values = ", ".join("(" + ", ".join([str(i), *map(literal, r)]) + ")" for i, r in enumerate(rows))
    return f"SELECT t.{key} AS id, {', '.join('c.' + n for n in names)} FROM {table_} t JOIN (VALUES {values}) c(i, {', '.join(names)}) ON t.{key} % {len(rows)} = c.i"
