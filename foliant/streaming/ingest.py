"""Incremental arrival of documents, as Structured Streaming over a folder of files.

Spark's file source keeps the name of each file that it has seen, and the state of each file that it finds, with the driver. Here tasks list the folder, and what has been
seen is state of the query, with the executors and in the checkpoint; the driver sees parts of listings and numbers. As with that source, empty files and names that begin with
``_`` or ``.`` are skipped; ``sources.files`` lists and reads these, so a run that must report them lists the folder once more at its end.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.batches import number_rows
from ..shared import delete, exists, kept, new_path, qualified
from ..sources.files import content_of, list_files, move_files

#: Batches into which the files that are there are divided at most. A batch has its own logs, jobs and commit, whatever it holds, so a fixed size would make them grow with the folder.
MOST_BATCHES = 20
FOUND = "path string, length long, mtime timestamp, date_folder string"
#: Names that Spark's file source skips, of files and of folders above them.
HIDDEN = r"(^|/)(\.|_[^=/]*(/|$)|[^/]*\._COPYING_(/|$))"


def _state_on_disk(spark: SparkSession) -> None:
    """States of the session's new queries are held by RocksDB, on the executors' disks; Spark's default holds them in the executors' memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def ingest_incremental(spark: SparkSession, path: str, files_per_batch: int = 1000, archive: str | None = None) -> DataFrame:
    """A stream of files (path, length, mtime, content, date_folder), each once in a checkpoint; with ``archive``, ``resume`` moves files of finished batches there.

    The date folder is the first folder below ``path``, whatever folders lie in it; empty for a file directly in ``path``. A file that is gone before its batch has null content.

    What is there now comes in parts of the listing, by path, a part a batch: ``files_per_batch`` files, and more where that would make more than ``MOST_BATCHES`` batches.
    What arrives later is found by each trigger's own listing, and is one batch. Listings hold files that the query has had before, too: its state drops them.
    """
    if files_per_batch < 1:
        raise ValueError("a batch holds at least one file")
    root = qualified(spark, path)
    if not exists(spark, root):
        raise FileNotFoundError(path)
    if archive and f"{qualified(spark, archive)}/".startswith(f"{root}/"):
        raise ValueError("files in an archive below the folder would arrive again")
    _state_on_disk(spark)

    def documents(start: DataFrame | None = None) -> DataFrame:
        rows = list_files(spark, root, start).where((F.col("length") > 0) & ~F.col("rel").rlike(HIDDEN))
        return rows.select("path", "length", "mtime", F.regexp_extract("rel", "^([^/]+)/", 1).alias("date_folder"))

    here, parts = kept(documents(), "listing"), new_path(spark, "parts")
    count = here.count()
    size = max(files_per_batch, -(-count // MOST_BATCHES))
    numbered = here if count <= size else number_rows(here, ["path"])
    for first in range(0, max(count, 1), size):  # one after the other: the source takes them by their times
        part = numbered if count <= size else numbered.where(F.col("row").between(first + 1, first + size)).drop("row")
        part.repartition(1).write.mode("append").parquet(parts)
    # a pattern, since a checkpoint has names of parts from earlier calls, which needn't be there any more
    listed = spark.readStream.schema(FOUND).option("maxFilesPerTrigger", 1).parquet(f"{parts}/*.parquet")
    looks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()  # a row in each batch
    known = spark.read.schema(FOUND).parquet(parts).select("path").hint("merge")  # a broadcast would go through the driver
    rows = listed.unionByName(documents(looks).join(known, "path", "left_anti")).dropDuplicates(["path"])
    name = F.col("path").alias("path", metadata={"archive": archive}) if archive else F.col("path")
    return rows.select(name, "length", "mtime", content_of(F.col("path")).alias("content"), "date_folder")


def resume(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop; a later call goes on after the last finished batch.

    A batch writes its own folder, by number, so one that is repeated after a failure replaces itself. Where ``stream`` is to archive its files, and still has their ``path``, files
    move once their batch is finished, in tasks, and this returns at the end; what a run that failed has left goes with the next one. A file that can't be moved stays.
    """
    archive = stream.schema["path"].metadata.get("archive") if "path" in stream.columns else None
    done = f"{checkpoint}/archive"

    def write(batch: DataFrame, batch_id: int) -> None:
        if archive:
            _move_finished(batch.sparkSession, done, archive, batch_id)
            batch.persist()  # used twice, but listed once: what moves is what was written
            batch.select("path").write.mode("overwrite").parquet(f"{done}/batch={batch_id}")
        try:
            transform(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        finally:
            batch.unpersist()

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if archive:
        query.awaitTermination()
        _move_finished(stream.sparkSession, done, archive)
    return query


def _move_finished(spark: SparkSession, done: str, archive: str, before: int | None = None) -> None:
    """Moves the files of the batches that ``done`` has, those before a number: a batch starts when all before it are finished. Below ``archive`` a file has its whole path."""
    if not exists(spark, done):
        return
    rows = spark.read.schema("path string, batch long").parquet(done)
    rows = rows if before is None else rows.where(F.col("batch") < before)
    numbers = [r["batch"] for r in rows.select("batch").distinct().collect()]
    move_files(rows.select("path", F.concat(F.lit(archive.rstrip("/")), F.regexp_replace("path", "^[A-Za-z0-9+.-]+:(//[^/]*)?(?=/)", "")).alias("final")))
    for n in numbers:
        delete(spark, f"{done}/batch={n}")


def live_progress(stream: DataFrame) -> DataFrame:
    """Documents and bytes by folder and outcome so far, for update mode; with first_start and last_end where the stream has start_utc and end_utc."""
    times = [F.min("start_utc").alias("first_start"), F.max("end_utc").alias("last_end")] if {"start_utc", "end_utc"} <= set(stream.columns) else []
    return stream.groupBy("date_folder", "outcome").agg(F.count("*").alias("documents"), F.sum("length").alias("bytes"), *times)


def publish(progress: DataFrame, out: str, checkpoint: str, totals: Callable[[], DataFrame] | None = None) -> StreamingQuery:
    """Write the rows that change in each batch of ``live_progress``, keyed by batch; ``published`` has the last of each.

    ``totals`` gives (date_folder, found), the documents found so far; it is asked at the end of each batch, so totals may grow.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if totals:
            totals().select("date_folder", F.col("found").cast("long").alias("found")).write.mode("overwrite").parquet(f"{out}-totals/batch={batch_id}")

    return progress.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def published(spark: SparkSession, out: str, batch: int | None = None) -> DataFrame:
    """The progress as of the end of a batch, the last by default."""
    rows = spark.read.parquet(out)
    rows = rows if batch is None else rows.where(F.col("batch") <= batch)
    held = [c for c in rows.columns if c not in ("date_folder", "outcome", "batch")]
    last = rows.groupBy("date_folder", "outcome").agg(F.max_by(F.struct(*held), "batch").alias("last"))
    return last.select("date_folder", "outcome", "last.*")


def published_rates(spark: SparkSession, out: str, batch: int | None = None) -> DataFrame:
    """(date_folder, found, processed, succeeded, failed, abandoned, files_per_s, remaining, eta_s) as of the end of a batch, the last by default; TOTAL is the whole run.

    Rates are of documents that succeeded or failed, from the first start to the last end. Folders of which nothing is processed have a rate of 0 and no ETA; where nothing remains, it is 0.
    """
    rows = published(spark, out, batch)
    totals = spark.read.parquet(f"{out}-totals")
    at = totals.agg(F.max("batch")).first()[0] if batch is None else batch
    ok, bad = F.when(F.col("outcome") == "Succeeded", F.col("documents")), F.when(F.startswith("outcome", F.lit("Failed")), F.col("documents"))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in (("succeeded", ok), ("failed", bad), ("all", F.col("documents")))]
    by = rows.groupBy("date_folder").agg(*sums, F.min("first_start").alias("first_start"), F.max("last_end").alias("last_end"))
    both = totals.where(F.col("batch") == at).select("date_folder", "found").join(by, "date_folder", "full").fillna(0, ["found", "succeeded", "failed", "all"])
    both = both.unionByName(both.agg(F.lit("TOTAL").alias("date_folder"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("found", "succeeded", "failed", "all")], F.min("first_start").alias("first_start"), F.max("last_end").alias("last_end")))
    done = F.col("succeeded") + F.col("failed")
    seconds = (F.unix_micros("last_end") - F.unix_micros("first_start")) / 1e6
    both = both.withColumns({"processed": done, "remaining": F.greatest(F.lit(0), F.col("found") - done), "files_per_s": F.coalesce(F.try_divide(done.cast("double"), seconds), F.lit(0.0))})
    eta = F.when(F.col("remaining") == 0, 0.0).when(F.col("files_per_s") > 0, F.col("remaining") / F.col("files_per_s"))
    return both.select("date_folder", "found", "processed", "succeeded", "failed", (F.col("all") - done).alias("abandoned"), "files_per_s", "remaining", eta.alias("eta_s"))


def late_files(stream: DataFrame, completed: DataFrame) -> DataFrame:
    """Files that arrive in folders that are marked complete; a resumed run would not read them."""
    done = completed.select(F.lower("date_folder").alias("_done")).distinct()
    return stream.withColumn("_folder", F.lower("date_folder")).join(done, F.col("_folder") == F.col("_done"), "left_semi").drop("_folder")


EVENTS = "date_folder string, event string, path string, documents long, bytes long, at_ms long"


class FolderStates(StatefulProcessor):
    """One state for each folder: what has arrived, and whether it is complete. A timer ends a folder that stays quiet."""

    def __init__(self, quiet_ms: int):
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("folder", "documents long, bytes long, due_ms long, complete boolean")

    def handleInputRows(self, key, rows, timerValues):
        documents, size, due, complete = self.state.get() or (0, 0, 0, False)
        now = timerValues.getCurrentProcessingTimeInMs()
        late = []
        for part in rows:
            documents, size = documents + len(part), size + int(part["length"].sum())
            late += [(key[0], "late", path, 1, int(n), now) for path, n in zip(part["path"], part["length"], strict=True)] if complete else []
        if not complete:
            if due:
                self.handle.deleteTimer(due)
            due = now + self.quiet_ms
            self.handle.registerTimer(due)
        self.state.update((documents, size, due, complete))
        yield pd.DataFrame(late, columns=EVENT_NAMES)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        documents, size, due, complete = self.state.get()
        done = [] if complete else [(key[0], "completed", None, documents, size, timerValues.getCurrentProcessingTimeInMs())]
        self.state.update((documents, size, due, True))
        yield pd.DataFrame(done, columns=EVENT_NAMES)

    def handleInitialState(self, key, initialState, timerValues):
        self.state.update((0, 0, 0, True))

    def close(self) -> None:
        pass


EVENT_NAMES = [c.split()[0] for c in EVENTS.split(", ")]


def folder_events(stream: DataFrame, quiet_ms: int = 60_000, completed: DataFrame | None = None) -> DataFrame:
    """A stream of (date_folder, event, path, documents, bytes, at_ms): ``completed`` once for each folder in which nothing arrives for ``quiet_ms``, with what it holds then, and ``late`` for
    each file that arrives after that.

    States are kept in the query's checkpoint, so a folder that was complete before a restart still is. ``completed`` (date_folder) are folders that are
    complete from the start. State is a row for each folder; the files of a batch, which the source bounds, are all that a task holds.
    """
    _state_on_disk(stream.sparkSession)
    rows = stream.select("date_folder", "path", "length").groupBy("date_folder")
    first = None if completed is None else completed.select("date_folder").distinct().groupBy("date_folder")
    return rows.transformWithStateInPandas(FolderStates(quiet_ms), EVENTS, "append", "processingTime", first)


def write_events(events: DataFrame, out: str, checkpoint: str, every: str = "1 second") -> StreamingQuery:
    """Write the events of each batch to its own folder, until the query is stopped."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return events.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def wait_for(spark: SparkSession, query: StreamingQuery, out: str, event: str, documents: int, seconds: float = 120.0) -> bool:
    """Waits until ``documents`` documents are in events of a kind; False where the query ends, or brings nothing new for ``seconds``. A batch that is at work may take any time."""
    since, seen = time.time(), -1
    while query.isActive:
        status = query.status  # before the events are read, so that these hold what was done by then
        ended = [p for p in getattr(query, "recentProgress", []) if p["batchId"] > seen]
        if exists(spark, out):
            rows = spark.read.schema(EVENTS).option("recursiveFileLookup", "true").parquet(out)
            if (rows.where(F.col("event") == event).agg(F.sum("documents")).first()[0] or 0) >= documents:
                return True
        seen = max([seen, *(p["batchId"] for p in ended)])
        at_work = status["isTriggerActive"] and status["isDataAvailable"] and not ended
        if any(o["numRowsUpdated"] for p in ended for o in p["stateOperators"]) or (at_work and seen < 0):
            since = time.time()
        if not at_work and time.time() > since + seconds:  # each batch lists the folder, so one that is at work need not bring anything
            return False
        time.sleep(0.5)
    return False
