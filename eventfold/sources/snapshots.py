"""Versions of a table in one folder. A version counts once Spark has marked it whole, so a reader never sees half of one; the one before stays as a backup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, path: str) -> list[int]:
    fs, p, make = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit() and fs.exists(make(f"{path}/{n}/_SUCCESS")))


def latest(spark: SparkSession, path: str) -> DataFrame | None:
    """None where nothing was ever written."""
    held = versions(spark, path)
    return spark.read.parquet(f"{path}/v={held[-1]}") if held else None


def write(df: DataFrame, path: str, version: int | None = None, keep: int = 2, partition_by: tuple[str, ...] = ()) -> int:
    spark = df.sparkSession
    held = versions(spark, path)
    number = version if version is not None else (held[-1] + 1 if held else 0)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/v={number}")
    fs, _, make = _fs(spark, path)
    for old in [v for v in held if v != number][: -(keep - 1) or None]:
        fs.delete(make(f"{path}/v={old}"), True)
    return number


def failures(df: DataFrame, path: str) -> bool:
    """Sites with an error as CSV; nothing is written if there are none."""
    bad = df.where("coalesce(error, '') <> ''").select("organizer", "url", "error")
    if bad.isEmpty():
        return False
    bad.write.mode("overwrite").option("header", True).csv(path)
    return True
