"""Tables written once below the shared folder (spark.checkpoint.dir) and read again, for what must not be computed twice. They go when the session ends."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def root(spark: SparkSession) -> str:
    """This session's own folder below the shared one; a shared one is set only where the session names none, as in tests."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            held = spark.sparkContext._jsc.sc().getCheckpointDir()
            if not held.isDefined() and not spark.sparkContext.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            base = held.get() if held.isDefined() else tempfile.mkdtemp(prefix="eventfold-")
        _ROOTS[app] = f"{base.rstrip('/')}/eventfold-tables-{app}"
        atexit.register(_remove, spark, _ROOTS[app])
    return _ROOTS[app]


def folder(spark: SparkSession, name: str) -> str:
    """A new name for a folder there."""
    return f"{root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def once(df: DataFrame, name: str) -> DataFrame:
    """df as a table on disk: every later use reads what this one run gave."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_texts(most: int = 2 << 20) -> None:
    """Pages and texts go to Python in batches of bounded bytes, so a worker holds no more of them at a time however many rows there are and however long they are. A session that names a limit of its own keeps it."""
    name, spark = "spark.sql.execution.arrow.maxBytesPerBatch", SparkSession.getActiveSession()
    if spark is not None and name not in spark.conf.getAll:
        spark.conf.set(name, str(most))


def short_methods(most: int = 8000) -> None:
    """Generated methods stay below the size that the JVM compiles at all: the many cells of a master's row make longer ones, which would be interpreted. A session that names a limit of its own keeps it."""
    name, spark = "spark.sql.codegen.hugeMethodLimit", SparkSession.getActiveSession()
    if spark is not None and name not in spark.conf.getAll:
        spark.conf.set(name, str(most))


def spread(df: DataFrame, each: int = 2000) -> DataFrame:
    """df, a scan of few and short columns, dealt evenly to tasks of some each rows. A scan makes its tasks by bytes, and a few megabytes of keys may stand for hours of work on what is made of them."""
    return df.repartition(max(-(-df.count() // each), 1))
