"""One run from an input folder to outputs, reports and checkpoint.

Outcomes are written once, and everything that is published comes from them, in this order: outputs, moves of inputs, error report, trace, summary,
and at last the completion rows of folders and the checkpoint. A run with a fatal error, or one that is interrupted, publishes no completion, so a later
run takes its folders again; with overwriting off it finds what is there as refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import file_name_of, matches_pattern, stem_of
from ..functions.rtf import to_rtf
from ..shared import exists, kept, spread
from ..sources import files, reports
from .batches import assign_batches, number_rows
from .outcomes import error_log_text, error_row_projection, output_name_clashes, plan_disposition, quarantine_unmatched, resolve_collisions, skip_completed_folders, union_failures
from .traced import Limits, convert_traced, refuse_existing


@dataclass(frozen=True)
class RunOptions:
    """Switches of a run. ``resume`` skips folders that the checkpoint at ``checkpoint`` marks complete; ``error_logs`` bounds the logs beside failed inputs, 0 for all."""

    pattern: str = "*.xhtml"
    only: str | None = None
    batch: int = 1000
    overwrite: bool = True
    archive: bool = True
    quarantine: bool = True
    resume: bool = False
    error_logs: int = 1000
    part_rows: int = reports.PART_ROWS
    threads: int = 1
    limits: Limits = field(default_factory=Limits)


@dataclass(frozen=True)
class Run:
    """What a run found and made: ``trace`` (a row for each document that went to a worker), ``failures`` (the error report's columns), and counts."""

    run_id: str
    trace: DataFrame
    failures: DataFrame
    found: int
    succeeded: int
    failed: int
    abandoned: int

    @property
    def completed(self) -> bool:
        return self.abandoned == 0


def _failures(outcomes: DataFrame, unmatched: DataFrame, options: RunOptions) -> DataFrame:
    """Failed documents and files that fit no pattern, with where each input goes; the columns that the error report starts from."""
    failed = outcomes.where(F.startswith("outcome", F.lit("Failed"))).select(
        "batch_id", "date_folder", "folder_path", "sub_folder", "file_name", "path", "length", F.lit("Conversion").alias("source"), "category", "reason", "attempts",
        F.col("error.type").alias("error_type"), F.col("error.message").alias("error_message"), F.col("end_utc").alias("error_time_utc"), "outcome",
    )
    found = quarantine_unmatched(unmatched, options.pattern).join(unmatched.select("date_folder", "sub_folder", "file_name", "folder_path", "path"), ["date_folder", "sub_folder", "file_name"])
    message = F.concat("file_name", F.lit(f" does not match the configured search pattern {options.pattern}, so it was never a conversion candidate."))
    found = found.withColumns({"error_message": message, "error_time_utc": F.current_timestamp(), "outcome": F.lit("Failed:Permanent")})
    return union_failures(failed, found)


def _moved(rows: DataFrame, spark: SparkSession, root: str, options: RunOptions) -> DataFrame:
    """(path, final, move_error) of the inputs that leave their folder, under a free name each."""
    plan = kept(plan_disposition(rows, options.archive, options.quarantine).where("destination is not null").select("path", "destination"), "plan")
    taken = files.list_files(spark, root).select(F.col("path").alias("destination"))
    return files.move_files(resolve_collisions(plan, taken).select("path", "final"))


def run_folder(spark: SparkSession, root: str, out: str, options: RunOptions | None = None, fn: Callable[[str], str] = to_rtf) -> Run:
    """Convert the documents of the date folders below ``root``; outputs, reports and checkpoint go below ``out`` (rtf, reports/<run>, checkpoint).

    Cases: folders without documents are complete; a file that fits no pattern fails with source Discovery and batch ``scan``, if ``quarantine`` is on, and is not found
    otherwise; two documents with one output name are an error before anything is converted; no documents give reports without rows.
    """
    options, run_id = options or RunOptions(), f"run-{uuid.uuid4().hex[:12]}"
    limits = options.limits if options.limits.out else Limits(**{**options.limits.__dict__, "out": f"{out}/rtf"})
    folders = kept(files.list_date_folders(spark, root, options.only), "folders")
    manifest = files.list_documents(spark, root, options.only)
    if options.resume and exists(spark, f"{out}/checkpoint/completed_folders"):
        done = spark.read.parquet(f"{out}/checkpoint/completed_folders")
        folders, manifest = skip_completed_folders(folders, done), skip_completed_folders(manifest, done)
    manifest = kept(manifest.withColumn("matched", matches_pattern(F.col("file_name"), options.pattern)), "manifest")
    clash = output_name_clashes(manifest.where("matched")).limit(1).collect()
    if clash:
        raise ValueError(f"several documents have the output {clash[0]['output']}")
    unmatched = manifest.where("not matched") if options.quarantine else manifest.where("false")
    work = assign_batches(manifest.where("matched"), options.batch)
    if not options.overwrite:
        there = files.list_files(spark, limits.out).select(F.col("rel").alias("output"))
        work = refuse_existing(work, there)
    outcomes = convert_traced(work.drop("matched"), limits, fn)  # written: what follows all comes from these rows
    trace = outcomes.withColumn("run_id", F.lit(run_id))
    failures = kept(_failures(outcomes, unmatched, options), "failures")
    leaving = outcomes.where("outcome = 'Succeeded'").select("path", "folder_path", "sub_folder", "file_name", "outcome").unionByName(failures.select("path", "folder_path", "sub_folder", "file_name", "outcome"))
    moves = _moved(leaving, spark, root, options)

    numbered = number_rows(failures.join(moves, "path", "left"), ["error_time_utc", "path"], out="row")
    placed = F.when(F.col("move_error").isNull(), F.col("final"))
    rows = numbered.withColumns({"error_file_path": placed, "error_file_name": file_name_of(placed)})
    logged = (F.col("row") <= options.error_logs) if options.error_logs else F.lit(True)
    rows = rows.withColumn("error_log_file", F.when(logged, F.concat(stem_of(F.coalesce("error_file_name", "file_name")), F.lit(".error.log"))))
    rows = error_row_projection(rows).withColumns({"file_size_bytes": F.col("length"), "error_category": F.col("category"), "input_file_path": F.col("path"), "error_log_file": F.col("error_log_name")})
    rows = kept(rows.drop("final", "error_log_name", "reason_text"), "error-rows")
    logs = error_log_text(rows, options.error_logs).where("log_text is not null")
    folder = F.concat_ws("/", F.replace("folder_path", F.lit(root.rstrip("/") + "/"), F.lit("")), F.lit("error"), F.when(F.col("sub_folder") != "", F.col("sub_folder")), "error_log_file")
    files.write_files(spread(logs.select(folder.alias("rel"), F.encode("log_text", "UTF-8").alias("content")), "rel"), root)

    at = f"{out}/reports/{run_id}"
    reports.write_error_report(rows, f"{at}/errors", options.part_rows)
    reports.write_trace(trace, f"{at}/trace", options.part_rows)
    counts = outcomes.agg(F.count("*").alias("n"), F.count_if(F.col("outcome") == "Succeeded").alias("ok"), F.count_if(F.startswith("outcome", F.lit("Failed"))).alias("bad")).first()
    odd = failures.where("source = 'Discovery'").count()
    run = Run(run_id, trace, rows, counts["n"] + odd, counts["ok"], counts["bad"] + odd, counts["n"] - counts["ok"] - counts["bad"])
    status = "COMPLETED" if run.completed else "FAILED"
    parts = 0 if not run.failed else -(-run.failed // options.part_rows) if options.part_rows else 1
    settings = {
        "Report Generated": f"{datetime.now(UTC):%Y-%m-%dT%H:%M:%SZ}", "Stage": "1 (XHTML to RTF)", "Status": status, "Input Path": root, "Output Path": limits.out, "Threads": options.threads,
        "Batch Size": options.batch, "Error Report Parts": parts,
    }
    header = reports.summary_header(trace, settings, run.found, odd)
    text = reports.summary_text(header, reports.summary_sections(trace, failures.where("source = 'Discovery'").select("date_folder")))
    files.write_files(spark.createDataFrame([("migration_report.csv", bytearray(text.encode()))], "rel string, content binary"), at)
    if run.completed:
        done = folders.select(F.lit(run_id).alias("run_id"), "date_folder", F.lit("spark").alias("instance"))
        reports.save_checkpoint(reports.checkpoint_rows(trace), done, f"{out}/checkpoint")
    return run

