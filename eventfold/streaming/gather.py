"""A run over a list of organisations in micro-batches: stopped between batches, killed and started again, it goes on where it was, and no batch that was finished is fetched anew.

The list is written once for a run, a file for each batch in its order, and read as a stream of one file a micro-batch; the stream's checkpoint says which batches are done. What a batch gives is written under its
number, pages first, so a batch that comes again after a crash reads the pages that it has and asks only for what is missing. A finished run's list and checkpoint belong to it alone: the next run gets new ones.
"""

from __future__ import annotations

import traceback
from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import fetch, run_state, snapshots

LIST = "nth long, organizer string, url string, country string, category string"
STOP = "eventfold-stop-wanted"


def counted(df: DataFrame, path: str, **counts: Column) -> dict[str, int]:
    """Writes df and gives the counts of its rows from that same pass."""
    seen = Observation()
    df.observe(seen, *[c.alias(name) for name, c in counts.items()]).write.mode("overwrite").parquet(path)
    return seen.get


def write_list(organisations: DataFrame, folder: str, batch: int) -> int:
    """The list in batches of so many, a file each, numbered in order. Gives the number of batches. organisations: ord, organizer, url, country, category."""
    cols = [c.split()[0] for c in LIST.split(", ") if not c.startswith("nth")]
    n = int(organisations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = organisations.select("ord", *cols).repartitionByRange(n, "ord").sortWithinPartitions("ord").withColumn("_part", F.spark_partition_id())
    parts.write.mode("overwrite").parquet(f"{folder}/ordered")
    held = organisations.sparkSession.read.parquet(f"{folder}/ordered")  # the numbers are those that were written
    sizes = {r["_part"]: r["n"] for r in held.groupBy("_part").agg(F.count("*").alias("n")).collect()}  # one number for each partition
    base, starts = 0, []
    for p in sorted(sizes):
        starts += [F.lit(p), F.lit(base)]
        base += sizes[p]
    if not base:
        return 0
    nth = F.create_map(*starts)[F.col("_part")] + F.row_number().over(Window.partitionBy("_part").orderBy("ord")) - 1
    rows = held.withColumn("nth", nth.cast("long")).withColumn("batch", F.floor(F.col("nth") / batch))
    rows.repartition(n, "batch").sortWithinPartitions("nth").select("batch", "nth", *cols).write.mode("overwrite").partitionBy("batch").parquet(f"{folder}/batches")
    run_state.Files(organisations.sparkSession, f"{folder}/batches").in_order([f"batch={i}" for i in range(-(-base // batch))])
    return -(-base // batch)


def run(
    spark: SparkSession,
    organisations: DataFrame,
    folder: str,
    get: Callable[[str], dict],
    extract: Callable[[DataFrame], DataFrame],
    *,
    batch: int = 5,
    pause: float = 0.3,
    keep: Sequence[str] = ("url", "organizer", "country", "category"),
    clock: Callable[[], float] | None = None,
) -> str:
    """done or stopped; what goes wrong leaves the status crashed and is raised.

    get: an address to a dict, as fetch.many takes it. extract: rows of KEEP with html, status and error to rows of events, with source_url. Events of batch i are at folder/events/batch=i, sites' results at folder/sites/batch=i;
    folder/counts has them by site, written only when the whole list was gone through.
    """
    held = run_state.Run(spark, folder, **({"clock": clock} if clock else {}))
    listener = run_state.Heartbeat(held, "gather")
    try:
        if not held.files.exists("list/whole"):
            total = write_list(organisations, f"{folder}/list", batch)
            held.files.create("list/whole", str(total))
        total = int(held.files.get("list/whole"))
        held.beat(total_batches=total)

        def step(rows: DataFrame, number: int) -> None:
            if held.stop_wanted():
                raise RuntimeError(STOP)
            number = rows.select(F.min("batch")).first()[0]  # the list's own number, whatever the stream calls it
            if number is None:
                return
            at = f"{folder}/pages/batch={number}"
            if not held.files.exists(f"pages/batch={number}/_SUCCESS"):
                fetch.many(rows, get, pause=pause).write.mode("overwrite").parquet(at)
            pages = spark.read.parquet(at)
            whole = rows.select("nth", *keep).join(pages, "url", "left")
            told = counted(extract(whole), f"{folder}/events/batch={number}", events=F.count(F.lit(1)))
            events = spark.read.parquet(f"{folder}/events/batch={number}").groupBy(F.col("source_url").alias("url")).agg(F.count("*").alias("events"))
            sites = whole.select("organizer", "url", "error").join(events, "url", "left").withColumn("events", F.coalesce("events", F.lit(0)))
            met = counted(sites, f"{folder}/sites/batch={number}", sites=F.count(F.lit(1)), failures=F.count("error"))
            done = held.progress
            held.beat(batches=done["batches"] + 1, processed=done["processed"] + met["sites"], events_found=done["events_found"] + told["events"], failures=done["failures"] + met["failures"])

        spark.streams.addListener(listener)
        if total:
            stream = spark.readStream.schema(LIST + ", batch long").option("maxFilesPerTrigger", 1).option("basePath", f"{folder}/list/batches").parquet(f"{folder}/list/batches")
            query = stream.writeStream.queryName("gather").foreachBatch(step).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
            try:
                query.awaitTermination()
            except StreamingQueryException as e:
                if STOP not in str(e):
                    raise
                held.close("stopped")
                return "stopped"
            counts = spark.read.parquet(f"{folder}/sites")
            snapshots.write(counts.select("organizer", "url", "events", "error"), f"{folder}/counts")
        for name in ("list", "checkpoint"):
            held.files.take(name)  # the next run begins at the top
        held.close("done")
        return "done"
    except Exception:
        held.progress["error"] = traceback.format_exc()[-500:]
        held.close("crashed")
        raise
    finally:
        spark.streams.removeListener(listener)
