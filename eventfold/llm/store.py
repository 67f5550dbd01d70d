"""The folder that driver and executors share, and tables and files in it."""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOTS: dict[str, str] = {}


def _qualified(spark: SparkSession, path: str) -> str:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = str(fs.makeQualified(hadoop).toString())
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def shared_root(spark: SparkSession) -> str:
    """URI of this session's own folder below spark.checkpoint.dir; one is set only where the cluster names none."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            held = spark.sparkContext._jsc.sc().getCheckpointDir()
            if not held.isDefined() and not spark.sparkContext.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            base = held.get() if held.isDefined() else tempfile.mkdtemp(prefix="eventfold-")
            spark.sparkContext.setCheckpointDir(base)
        root = _qualified(spark, f"{base.rstrip('/')}/eventfold-{app}")
        _ROOTS[app] = root
        atexit.register(remove, spark, root)
    return _ROOTS[app]


def remove(spark: SparkSession, root: str) -> None:
    with contextlib.suppress(Exception):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Batches of whole texts are large: unless the session says otherwise, they go to Python by fewer rows, so that a worker holds less at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, str(rows))


def fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read again: lineage ends here and survives lost executors."""
    path = fresh(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that cut wrote and nothing reads any more."""
    for df in tables:
        if path := vars(df).pop("_written_at", None):
            remove(df.sparkSession, path)


def release(*tables: DataFrame) -> None:
    """discard, and lets Spark drop the shuffle files of what is out of use."""
    discard(*tables)
    gc.collect()
    if session := SparkSession.getActiveSession():
        session.sparkContext._jvm.System.gc()


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of all columns of a row, maps included: equal rows have equal digests."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class AtomicFile:
    """A file that appears under its name only when whole, so a killed or repeated task leaves no half file."""

    def __init__(self, uri: str):
        self.uri = uri
        self.fs, self.path = filesystem(uri)
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex[:8]}.part"
        self.out = self.fs.open_output_stream(self.part, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)
