"""Breakdowns of a run over its trace: folders, workers, phases, concurrency, throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OK = "Succeeded"
#: Phases of a conversion, and what each spends.
PHASES = [("read", "Disk"), ("decode", "CPU"), ("validate", "CPU"), ("import", "CPU"), ("export", "CPU"), ("write", "Disk"), ("archive", "Disk")]
#: Size of the output against the input, and of a Base64 envelope.
RTF_FACTOR, BASE64_FACTOR = 1.2, 4 / 3


def succeeded() -> Column:
    return F.count_if(F.col("outcome") == OK)


def failed() -> Column:
    """Documents that failed. A fatal error or a cancelled run leaves a document where it is: that one is abandoned, and neither failed nor processed."""
    return F.count_if(F.startswith("outcome", F.lit("Failed")))


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def scan_folders(manifest: DataFrame, folder: str = "date_folder", length: str = "length") -> DataFrame:
    return manifest.groupBy(folder).agg(F.count("*").alias("files"), F.coalesce(F.sum(length), F.lit(0)).cast("long").alias("bytes"))


def dry_run_report(manifest: DataFrame, folder: str = "date_folder", length: str = "length") -> DataFrame:
    """Files and bytes of each folder, and of all as TOTAL."""
    out = manifest.rollup(folder).agg(F.count("*").alias("files"), F.coalesce(F.sum(length), F.lit(0)).cast("long").alias("bytes"), F.grouping(folder).alias("g"))
    return out.select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col(folder)).alias(folder), "files", "bytes")


def folder_shape(manifest: DataFrame, workers: int, folder: str = "date_folder") -> DataFrame:
    """(size_class, folders): folders by powers of two of their documents, and whether those keep all workers busy."""
    n = manifest.groupBy(folder).agg(F.count("*").alias("n"))
    return n.groupBy(F.floor(F.log2("n")).cast("long").alias("size_class"), (F.col("n") >= workers).alias("fills_workers")).agg(F.count("*").alias("folders"))


def folder_breakdown(trace: DataFrame) -> DataFrame:
    ms = (F.unix_micros(F.max("end_utc")) - F.unix_micros(F.min("start_utc"))) / 1000
    return trace.groupBy("date_folder").agg(F.count("*").alias("total"), succeeded().alias("succeeded"), failed().alias("failed"), ms.alias("elapsed_ms"))


def run_totals(trace: DataFrame, found: int | Column) -> DataFrame:
    """One row: processed are those that succeeded or failed, bytes those of successes; what is neither remains."""
    n = succeeded() + failed()
    return trace.agg(
        n.alias("processed"),
        succeeded().alias("succeeded"),
        failed().alias("failed"),
        F.coalesce(F.sum(F.greatest(F.col("attempts") - 1, F.lit(0))), F.lit(0)).cast("long").alias("retries"),
        F.coalesce(F.sum(F.when(F.col("outcome") == OK, F.col("bytes_in"))), F.lit(0)).cast("long").alias("bytes_in"),
        F.greatest(F.lit(0), F.lit(found) - n).cast("long").alias("remaining"),
    )


def worker_breakdown(trace: DataFrame, run_ms: float | None = None) -> DataFrame:
    """Documents (abandoned ones too), busy time, and rates of each worker: files_per_s is of its busy time; ``run_ms`` is the length of the run, else first start to last end."""
    n = F.count("*")
    by = trace.groupBy("worker_slot").agg(
        n.alias("processed"), succeeded().alias("succeeded"), failed().alias("failed"), (n - succeeded() - failed()).alias("abandoned"), F.sum("duration_ms").alias("busy_ms")
    )
    span = trace.agg(((F.unix_micros(F.max("end_utc")) - F.unix_micros(F.min("start_utc"))) / 1000).alias("run_ms")) if run_ms is None else None
    by = by.crossJoin(F.broadcast(span)) if span is not None else by.withColumn("run_ms", F.lit(float(run_ms)))  # one row
    return by.select(
        "worker_slot", "processed", "succeeded", "failed", "abandoned", "busy_ms",
        (ratio(F.col("busy_ms"), F.col("run_ms")) * 100).alias("busy_pct"),
        ratio(F.col("busy_ms"), F.col("processed")).alias("avg_ms"),
        ratio(F.col("processed"), F.col("busy_ms") / 1000).alias("files_per_s"),
    )


def _phase_rows(trace: DataFrame) -> DataFrame:
    pairs = ", ".join(f"'{p}', '{k}', {p}_ms" for p, k in PHASES)
    return trace.where(F.col("outcome") == OK).select(F.expr(f"stack({len(PHASES)}, {pairs}) as (phase, kind, ms)"))


def phase_breakdown(trace: DataFrame) -> DataFrame:
    """(phase, kind, total_s, pct, avg_ms) over successes; pct is of all measured time."""
    by = _phase_rows(trace).groupBy("phase", "kind").agg(F.sum("ms").alias("ms"), F.count("*").alias("files"))
    whole = by.agg(F.sum("ms").alias("all_ms"))  # one row
    return by.crossJoin(F.broadcast(whole)).select(
        "phase", "kind", (F.col("ms") / 1000).alias("total_s"), (ratio(F.col("ms"), F.col("all_ms")) * 100).alias("pct"), ratio(F.col("ms"), F.col("files")).alias("avg_ms")
    )


def cpu_disk_split(trace: DataFrame, processed: int | None = None) -> DataFrame:
    """(kind, total_s, avg_ms): CPU and Disk over successes, and Overhead: busy time that no phase claims, if there is any.

    Busy time is the average service time of all documents, abandoned ones among them, times the documents processed, which are those that succeeded
    or failed; ``processed`` gives their number where the trace lacks some, as quarantined files.
    """
    by = _phase_rows(trace).groupBy("kind").agg(F.sum("ms").alias("ms"))
    run = trace.agg(
        F.count_if(F.col("outcome") == OK).alias("ok"),
        ratio(F.sum("duration_ms"), F.count("*")).alias("service"),
        F.greatest(F.lit(1), succeeded() + failed() if processed is None else F.lit(processed)).alias("n"),
    )  # one row
    measured = by.agg(F.coalesce(F.sum("ms"), F.lit(0.0)).alias("measured"))
    both = run.crossJoin(F.broadcast(measured))
    rest = both.select(F.lit("Overhead").alias("kind"), (F.col("service") * F.col("n") - F.col("measured")).alias("ms")).where("ms > 0")
    rows = by.select("kind", "ms").unionByName(rest).crossJoin(F.broadcast(run.select("ok")))
    return rows.select("kind", (F.col("ms") / 1000).alias("total_s"), ratio(F.col("ms"), F.col("ok")).alias("avg_ms"))


def average_concurrency(trace: DataFrame, configured: int) -> DataFrame:
    wall = (F.unix_micros(F.max("end_utc")) - F.unix_micros(F.min("start_utc"))) / 1000
    one = trace.agg(ratio(F.sum("duration_ms"), wall).alias("avg_workers"))
    return one.withColumn("utilisation_pct", F.least(F.lit(100.0), ratio(F.col("avg_workers"), F.lit(float(configured))) * 100))


def peak_concurrency(intervals: DataFrame, start: str = "start_us", end: str = "end_us", bucket_us: int = 60_000_000) -> DataFrame:
    """Most intervals [start, end) that overlap at a time, ends before starts at ties.

    Times are cut into buckets; each bucket sums its changes, a window over those sums (one row for each bucket with
    events) gives what is open when it begins, and the running count inside a bucket is a window over that bucket
    only.
    """
    events = intervals.select(F.explode(F.array(F.struct(F.col(start).alias("t"), F.lit(1).alias("d")), F.struct(F.col(end).alias("t"), F.lit(-1).alias("d")))).alias("e"))
    events = events.select("e.t", "e.d", F.floor(F.col("e.t") / bucket_us).alias("b")).where("t is not null")
    changes = events.groupBy("b").agg(F.sum("d").alias("net"))
    open_at = changes.withColumn("open", F.coalesce(F.sum("net").over(W.orderBy("b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("b", "open")
    inside = F.sum("d").over(W.partitionBy("b").orderBy("t", "d").rowsBetween(W.unboundedPreceding, W.currentRow))
    return events.withColumn("inside", inside).join(open_at, "b").agg(F.coalesce(F.max(F.col("open") + F.col("inside")), F.lit(0)).cast("long").alias("peak"))


def throughput(totals: DataFrame) -> DataFrame:
    """Rates of a run from one row of succeeded, processed, bytes_in, bytes_out, elapsed_s, service_ms and remaining."""
    rate = ratio(F.col("processed").cast("double"), F.col("elapsed_s"))
    mb = 1024.0 * 1024.0
    return totals.select(
        rate.alias("files_per_s"),
        (rate * 60).alias("files_per_min"),
        (rate * 3600).alias("files_per_hour"),
        ratio((F.col("bytes_in") + F.col("bytes_out")) / mb, F.col("elapsed_s")).alias("mb_per_s"),
        ratio(F.col("bytes_in") / mb, F.col("succeeded")).alias("avg_file_mb"),
        ratio(F.col("service_ms"), F.col("processed")).alias("avg_service_ms"),
        F.when(F.col("remaining") == 0, 0.0).when(rate > 0, F.col("remaining") / rate).alias("eta_s"),
    )


def capacity_estimate(scan: DataFrame, free_bytes: int, base64: bool = False) -> DataFrame:
    """Bytes the output will need, and whether the free space falls short of them."""
    need = F.coalesce(F.sum("bytes"), F.lit(0)) * (RTF_FACTOR * (BASE64_FACTOR if base64 else 1))
    return scan.agg(F.ceil(need).cast("long").alias("needed_bytes")).withColumn("short", F.col("needed_bytes") > free_bytes)
