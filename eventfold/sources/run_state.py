"""One run at a time: a lease in the shared folder that only one run holds, and what the run has done so far.

The lease is a file made by a create that fails where one is, so of two runs that start at once one gets it, on any file system with that guarantee. Its holder renews it as it works (beat, and a listener for
streaming queries); one that nobody renewed for STALE seconds belongs to a run that died, and may be taken over: the file is renamed away first, which works for one of several takers.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

STALE = 20.0


class RunActive(RuntimeError):
    """Another run holds the lease."""


class Files:
    """Small text files through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark.sparkContext._jvm
        self._hadoop = self._jvm.org.apache.hadoop
        self.folder = folder.rstrip("/")
        self._fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self.path(""))

    def path(self, name: str):
        return self._hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def create(self, name: str, content: str) -> bool:
        """False where the file is there already."""
        try:
            out = self._fs.create(self.path(name), False)
        except Exception:
            if self.exists(name):
                return False
            raise
        try:
            out.write(bytearray(content.encode()))
        finally:
            out.close()
        return True

    def put(self, name: str, content: str) -> None:
        """A whole new file in place of the old one: no reader sees half of it."""
        part = f".{name}.{uuid.uuid4().hex[:8]}"
        self.create(part, content)
        options = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        options[0] = getattr(self._hadoop.fs, "Options$Rename").OVERWRITE
        self._hadoop.fs.FileContext.getFileContext(self.path("").toUri()).rename(self.path(part), self.path(name), options)

    def get(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self._fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def take(self, name: str) -> bool:
        """Moves a file away; False if it is gone, as when another was quicker."""
        return bool(self.exists(name) and self._fs.rename(self.path(name), self.path(f".{name}.{uuid.uuid4().hex[:8]}.old")))

    def in_order(self, folders: list[str]) -> None:
        """Gives the files of each folder a later time than those of the one before: streams of files go by time. A store without times that can be set leaves the order open."""
        began = int(time.time() * 1000) - len(folders)
        for i, name in enumerate(folders):
            for f in self._fs.listStatus(self.path(name)):
                self._fs.setTimes(f.getPath(), began + i, -1)

    def drop(self, name: str) -> None:
        self._fs.delete(self.path(name), False)


class Run:
    """The holder of the lease. progress: what is told of the run; status: running, stopped, done or crashed."""

    def __init__(self, spark: SparkSession, folder: str, clock: Callable[[], float] = time.time):
        self.files, self.clock, self.me = Files(spark, folder), clock, uuid.uuid4().hex
        self.lock, self.open = threading.RLock(), True  # a listener renews it too
        self.progress: dict = {"status": "running", "batches": 0, "processed": 0, "events_found": 0, "failures": 0}
        while not self.files.create("lease.json", self._lease()):
            held = self._held()
            if held and self.clock() - held.get("updated_at", 0) < STALE:
                raise RunActive(f"a run that was alive {self.clock() - held['updated_at']:.0f} s ago holds {self.files.folder}")
            if not self.files.take("lease.json") and self.files.exists("lease.json"):
                raise RunActive(f"another run takes over {self.files.folder}")
        self._tell()

    def _lease(self) -> str:
        return json.dumps({"holder": self.me, "updated_at": self.clock()})

    def _held(self) -> dict | None:
        try:
            return json.loads(self.files.get("lease.json") or "null")
        except ValueError:
            return None  # a holder that died while it wrote

    def _tell(self) -> None:
        self.files.put("progress.json", json.dumps(self.progress | {"updated_at": self.clock()}))

    def beat(self, **told: object) -> None:
        """Renews the lease and tells what was done. Raises if the lease is another's by now."""
        with self.lock:
            if not self.open:
                return
            held = self._held()
            if not held or held["holder"] != self.me:
                raise RunActive("the lease was taken over")
            self.files.put("lease.json", self._lease())
            self.progress |= told
            self._tell()

    def stop_wanted(self) -> bool:
        return self.files.exists("stop")

    def close(self, status: str) -> None:
        with self.lock:
            self.open = False
            self.progress["status"] = status
            held = self._held()
            if held and held["holder"] == self.me:
                self._tell()
                self.files.drop("stop")
                self.files.drop("lease.json")


def want_stop(spark: SparkSession, folder: str) -> None:
    """Asks the run of a folder to stop after its present batch."""
    Files(spark, folder).create("stop", "")


def progress(spark: SparkSession, folder: str) -> dict | None:
    held = Files(spark, folder).get("progress.json")
    return json.loads(held) if held else None


class Heartbeat(StreamingQueryListener):
    """Renews a run's lease with each progress of a streaming query, with the counts that the query observes under the run's name."""

    def __init__(self, run: Run, query_name: str):
        self.run, self.query_name, self.seen = run, query_name, []

    def onQueryStarted(self, event) -> None:  # noqa: ANN001
        pass

    def onQueryProgress(self, event) -> None:  # noqa: ANN001
        if event.progress.name == self.query_name:
            self.seen.append({"batch": event.progress.batchId, "rows": event.progress.numInputRows})
            self.run.beat(last_batch=event.progress.batchId)

    def onQueryIdle(self, event) -> None:  # noqa: ANN001
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001
        pass
