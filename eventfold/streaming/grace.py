"""Streams of sightings: the last one of each event, and events unseen for longer than the grace period."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def unseen(sightings: DataFrame, days: int = 14, *, key: str = "event_id", time: str = "ts") -> DataFrame:
    """event_id, last_seen of events whose last sighting is more than so many days of event time behind the watermark; an event that is seen again starts anew."""
    rows = sightings.select(F.col(key).cast("string").alias("event_id"), F.col(time).cast("timestamp").alias("ts")).withWatermark("ts", "1 day")

    def step(key_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (last,) = state.get
            state.remove()
            yield pd.DataFrame({"event_id": [key_[0]], "last_seen": [pd.Timestamp(last, unit="ms", tz="UTC")]})
            return
        last = state.get[0] if state.exists else 0
        for p in parts:
            if len(p):
                last = max(last, int(p["ts"].max().timestamp() * 1000))
        state.update((last,))
        at = last + days * 86_400_000
        if at > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(at)
        else:
            state.remove()
            yield pd.DataFrame({"event_id": [key_[0]], "last_seen": [pd.Timestamp(last, unit="ms", tz="UTC")]})

    return rows.groupBy("event_id").applyInPandasWithState(step, "event_id string, last_seen timestamp", "last long", "append", GroupStateTimeout.EventTimeTimeout)


def last_seen(sightings: DataFrame, *, key: str = "event_id", time: str = "ts") -> DataFrame:
    """The last sighting of each event, for update mode."""
    return sightings.groupBy(F.col(key).alias("event_id")).agg(F.max(time).alias("last_seen"), F.count("*").alias("times"))


def changed(sightings: DataFrame, *, key: str = "event_id", fingerprint: str = "fingerprint", time: str = "ts") -> DataFrame:
    """event_id, fingerprint, ts, fate of the sightings that say something new: new for the first of an event, changed where the fingerprint isn't the one before. Of a batch's sightings
    of an event the latest counts (the greatest fingerprint of equals), and only if it is later than all before. The state is one fingerprint and time for each event, as long as the stream lives."""
    rows = sightings.select(F.col(key).cast("string").alias("event_id"), F.coalesce(F.col(fingerprint).cast("string"), F.lit("")).alias("fingerprint"), F.col(time).cast("timestamp").alias("ts")).where("ts is not null")

    def step(key_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else None  # fingerprint, microseconds
        latest = max((max(zip(p["ts"].astype("datetime64[us]").astype("int64"), p["fingerprint"], strict=True)) for p in parts if len(p)), default=None)
        if latest is None or (held is not None and latest[0] <= held[1]):
            return
        at, said = int(latest[0]), latest[1]
        state.update((said, at))
        if held is None or held[0] != said:
            yield pd.DataFrame({"event_id": [key_[0]], "fingerprint": [said], "ts": [pd.Timestamp(at, unit="us", tz="UTC")], "fate": ["new" if held is None else "changed"]})

    return rows.groupBy("event_id").applyInPandasWithState(step, "event_id string, fingerprint string, ts timestamp, fate string", "fingerprint string, at long", "append", GroupStateTimeout.NoTimeout)


def fill_into(path: str, key: str, order: str):
    """For foreachBatch: of each cell the newest that isn't blank, so a date that is announced late completes its row and a blank never takes anything away. A batch that comes twice
    gives the same version."""

    def write(batch: DataFrame, number: int) -> None:
        from ..operators import lifecycle
        from ..sources import snapshots

        before = [v for v in snapshots.versions(batch.sparkSession, path) if v < number]
        old = batch.sparkSession.read.parquet(f"{path}/v={before[-1]}") if before else batch.limit(0)
        snapshots.write(lifecycle.fill(old, batch, key, order), path, number)

    return write


def upsert_into(path: str, key: str, order: str):
    """For foreachBatch: keeps the newest row of each key as a new version below path; a batch that comes twice gives the same version."""

    def write(batch: DataFrame, number: int) -> None:
        from ..sources import snapshots

        spark = batch.sparkSession
        old = snapshots.latest(spark, path)
        rows = batch if old is None else old.unionByName(batch)
        newest = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("_r")).select("_r.*")
        snapshots.write(newest, path, number)

    return write
