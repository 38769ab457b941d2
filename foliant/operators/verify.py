"""Checks over the reports of runs: duplicates, ownership, reconciliation, comparison of trees and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .batches import number_rows


def failures_by_reason(failures: DataFrame) -> DataFrame:
    return failures.groupBy("reason").agg(F.count("*").alias("failures")).orderBy(F.desc("failures"), "reason")


def work_distribution(done: DataFrame) -> DataFrame:
    """(instance, folders, names): what each instance completed, its folders in one text for the report; ``folders_of_instances`` has them as rows."""
    return done.groupBy("instance").agg(F.count("*").alias("folders"), F.array_join(F.sort_array(F.collect_list("date_folder")), ", ").alias("names"))


def folders_of_instances(done: DataFrame) -> DataFrame:
    """(instance, nth, date_folder, first_taken): the folders that each instance completed, numbered in order, and whether no earlier instance had the same.

    A row for each (instance, date_folder), however often it was reported; null instances and folders go like others. Numbers are
    prefix sums, so an instance may have completed any number of folders.
    """
    rows = done.groupBy("instance", "date_folder").agg(F.lit(1).alias("_one")).drop("_one")
    numbered = number_rows(rows, ["date_folder"], within="instance", out="nth")
    owner = rows.groupBy("date_folder").agg(F.min("instance").alias("_owner"))
    both = numbered.join(owner.withColumnRenamed("date_folder", "_of"), F.col("date_folder").eqNullSafe(F.col("_of")))
    return both.select("instance", "nth", "date_folder", F.coalesce(F.col("instance") == F.col("_owner"), F.col("_owner").isNull()).alias("first_taken"))


def duplicate_documents(trace: DataFrame, most: int = 10) -> DataFrame:
    """The first documents (by key) that were traced more than once."""
    keys = ["date_folder", "sub_folder", "file_name"]
    return trace.groupBy(*keys).agg(F.count("*").alias("times")).where("times > 1").orderBy(*keys).limit(most)


def trace_coverage(trace: DataFrame, manifest: DataFrame) -> DataFrame:
    one = trace.agg(F.count("*").alias("traced")).crossJoin(manifest.agg(F.count("*").alias("found")))  # a row each
    return one.withColumn("complete", F.col("traced") == F.col("found"))


def trace_with_errors(trace: DataFrame, failures: DataFrame) -> DataFrame:
    """Trace rows beside the failure of the same document in the same batch."""
    keys = ["date_folder", "sub_folder", "file_name", "batch_id"]
    return trace.join(failures.select(*keys, "reason", "error_type"), keys, "left")


def tree_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """(rel_path, left_hash, right_hash) of files that differ or are in one tree only. Inputs: rel_path and content or sha256."""
    hashed = lambda df, name: df.select("rel_path", (F.col("sha256") if "sha256" in df.columns else F.sha2("content", 256)).alias(name))
    both = hashed(left, "left_hash").join(hashed(right, "right_hash"), "rel_path", "full_outer")
    return both.where(~F.col("left_hash").eqNullSafe(F.col("right_hash")))


def folder_ownership(folders: DataFrame, done: DataFrame, claims: DataFrame) -> DataFrame:
    """(date_folder, owner, state): completed, claimed or open. Each folder has one owner at most."""
    own = done.groupBy("date_folder").agg(F.min("instance").alias("owner"))
    held = claims.select("date_folder").distinct().withColumn("_held", F.lit(True))
    state = F.when(F.col("owner").isNotNull(), "completed").when(F.col("_held"), "claimed").otherwise("open")
    return folders.select("date_folder").distinct().join(own, "date_folder", "left").join(held, "date_folder", "left").select("date_folder", "owner", state.alias("state"))


def ownership_agreement(done: DataFrame, trace: DataFrame) -> DataFrame:
    """(date_folder, owner, instance): folders with trace rows of another instance than the owner."""
    seen = trace.select("date_folder", "instance").distinct()
    return done.select("date_folder", F.col("instance").alias("owner")).join(seen, "date_folder").where(F.col("owner") != F.col("instance"))


def archived_vs_rtf(archived: DataFrame, outputs: DataFrame) -> DataFrame:
    """(stem_path, problem): archived inputs without output, and outputs without archived input."""
    a = archived.select("stem_path").distinct().withColumn("_in", F.lit(True))
    b = outputs.select("stem_path").distinct().withColumn("_out", F.lit(True))
    both = a.join(b, "stem_path", "full_outer").where(F.col("_in").isNull() | F.col("_out").isNull())
    return both.select("stem_path", F.when(F.col("_in").isNull(), "output without input").otherwise("input without output").alias("problem"))


def manifest_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """(date_folder, scanned, processed, drift) of folders whose number of files changed."""
    count = lambda df, name: df.groupBy("date_folder").agg(F.count("*").alias(name))
    both = count(before, "scanned").join(count(after, "processed"), "date_folder", "full_outer").fillna(0, ["scanned", "processed"])
    return both.withColumn("drift", F.col("processed") - F.col("scanned")).where("drift <> 0")


#: Checks of a run; each is name, expected and actual over one row of totals.
CHECKS = [
    ("status", "'COMPLETED'", "status"),
    ("exit code", "if(failed > 0, 1, 0)", "exit_code"),
    ("files found", "corpus", "found"),
    ("found = succeeded + failed", "succeeded + failed", "found"),
    ("processed = found", "found", "processed"),
    ("rtf written", "succeeded", "rtf"),
    ("archived", "succeeded", "archived"),
    ("in error", "failed", "in_error"),
    ("left in input", "0", "remaining"),
    ("error report rows", "failed", "error_rows"),
    ("peak workers", "threads", "peak"),
]


def reconcile(totals: DataFrame) -> DataFrame:
    """(check, expected, actual, pass): the eleven equalities over a row of totals for each run."""
    rows = [F.struct(F.lit(n).alias("check"), F.expr(e).cast("string").alias("expected"), F.expr(a).cast("string").alias("actual")) for n, e, a in CHECKS]
    out = totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.withColumn("pass", F.col("expected").eqNullSafe(F.col("actual")))


def thread_sweep_matrix(report_kv: DataFrame, names: list[str]) -> DataFrame:
    """One row for each report, with a column for each of ``names``; empty where a report lacks it."""
    return report_kv.groupBy("report").pivot("name", names).agg(F.first("value")).fillna("", names)


def scaling_test(runs: DataFrame) -> DataFrame:
    """Runs by threads with service time against the first run and the run before; runs: run, threads, service_ms."""
    order = W.orderBy("threads", "run")  # one row for each run
    first = F.first("service_ms").over(order)
    return runs.select("run", "threads", "service_ms", F.try_divide("service_ms", first).alias("vs_first"), F.try_divide(F.col("service_ms"), F.lag("service_ms").over(order)).alias("vs_before"))


def scaling_verdict(runs: DataFrame, flat: float = 0.05, rising: float = 0.5, control: float = 0.15) -> DataFrame:
    """(sweep, slope, control_ratio, verdict) of each sweep of runs (sweep, run, threads, service_ms, started).

    The slope is the fitted growth of the service time for each further thread, as a share of that of the first run on the fewest threads; runs on more threads by one that
    take as much longer as the threads are more have a slope of 1. ``control_ratio`` compares the last run on the fewest threads with the first, null where there is
    only one. A sweep whose control differs by more than ``control`` is not reproducible, whatever its slope; otherwise it is flat up to ``flat``, rising from ``rising``, and unclear between. A
    sweep of one number of threads, or without times, has no slope and is unclear. A sweep is a few runs, so its window is small.
    """
    order = W.partitionBy("sweep").orderBy("threads", "started", "run")
    least = F.min("threads").over(W.partitionBy("sweep"))
    rows = runs.where("threads is not null and service_ms is not null").withColumns({"_base": F.first("service_ms").over(order), "_same": F.col("threads") == least})
    by = rows.groupBy("sweep").agg(
        F.try_divide(F.regr_slope("service_ms", F.col("threads").cast("double")), F.first("_base")).alias("slope"),
        F.when(F.count_if("_same") > 1, F.try_divide(F.max_by("service_ms", F.when(F.col("_same"), F.struct("started", "run"))), F.first("_base"))).alias("control_ratio"),
    )
    by = runs.select("sweep").distinct().join(by, "sweep", "left")
    verdict = F.when(F.abs(F.col("control_ratio") - 1) > control, "not reproducible").when(F.col("slope") <= flat, "flat").when(F.col("slope") >= rising, "rising").otherwise("unclear")
    return by.withColumn("verdict", verdict)


def folder_digests(digests: DataFrame) -> DataFrame:
    """(folder, files, digest) of each folder at any depth, from (rel_path, sha256) of the files below it; the root is the empty folder.

    A digest is the exclusive or of the digests of its files' names and contents, in four parts, with their number: it needs no order, so a folder of any size is summed up in tasks.
    """
    parts = F.split("rel_path", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    rows = digests.select(F.explode(above).alias("folder"), "rel_path", "sha256")
    mixed = F.sha2(F.concat(F.col("rel_path"), F.lit("\n"), F.coalesce("sha256", F.lit(""))).cast("binary"), 256)
    lanes = [F.bit_xor(F.conv(F.substring("mixed", 1 + 15 * k, 15), 16, 10).cast("long")).alias(f"x{k}") for k in range(4)]
    by = rows.withColumn("mixed", mixed).groupBy("folder").agg(F.count("*").alias("files"), *lanes)
    return by.select("folder", "files", F.concat_ws("-", *[F.hex(f"x{k}") for k in range(4)]).alias("digest"))


def tree_diff_folders(left: DataFrame, right: DataFrame, level: int = 1) -> DataFrame:
    """``tree_diff`` of two trees (rel_path, sha256) that opens only folders that differ: those of ``level`` parts are compared by their digests first, and the rows of equal ones go no further."""
    name = lambda df: df.withColumn("_folder", F.array_join(F.slice(F.split("rel_path", "/"), F.lit(1), F.least(F.lit(level), F.size(F.split("rel_path", "/")) - 1)), "/"))
    summed = lambda df, tag: folder_digests(df.select(F.concat_ws("/", F.md5(F.col("_folder").cast("binary")), F.replace("rel_path", F.lit("/"), F.lit("\0"))).alias("rel_path"), "sha256")).where("folder <> ''").select(F.col("folder").alias("_key"), F.struct("files", "digest").alias(tag))
    left, right = name(left), name(right)
    both = summed(left, "_l").join(summed(right, "_r"), "_key", "full_outer").where(~F.col("_l").eqNullSafe(F.col("_r"))).select("_key")
    opened = lambda df: df.withColumn("_key", F.md5(F.col("_folder").cast("binary"))).join(both, "_key", "left_semi").select("rel_path", "sha256")
    return tree_diff(opened(left), opened(right))


def manifest_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(rel_path, change, length, mtime) between two listings (rel_path, length, mtime): arrived, gone, or changed in size or time."""
    a = before.select("rel_path", F.struct("length", "mtime").alias("_a"))
    b = after.select("rel_path", F.struct("length", "mtime").alias("_b"))
    both = a.join(b, "rel_path", "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
    change = F.when(F.col("_a").isNull(), "arrived").when(F.col("_b").isNull(), "gone").otherwise("changed")
    return both.select("rel_path", change.alias("change"), "_b.length", "_b.mtime")
