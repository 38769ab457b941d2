"""What became of each document: error classes, attempts, failures, placement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.paths import matches_pattern, output_path_of
from ..functions.times import iso_utc
from ..shared import kept
from .batches import number_rows

TRANSIENT, PERMANENT, FATAL = "Transient", "Permanent", "Fatal"
#: Which errors are of which class; all others are permanent.
FATAL_TYPES = ("UnauthorizedAccessException", "SecurityException", "DriveNotFoundException")
PERMANENT_IO = ("PathTooLongException", "DirectoryNotFoundException", "FileNotFoundException")
TRANSIENT_TYPES = ("IOException", "EndOfStreamException", "FileLoadException", "TimeoutException", "OutOfMemoryException", "OperationCanceledException", "TaskCanceledException")
IO_TYPES = ("IOException", "EndOfStreamException", "FileLoadException", "DriveNotFoundException")
CANCELLATIONS = ("OperationCanceledException", "TaskCanceledException")
DISK_FULL = (0x27, 0x70)
#: Outcomes are Succeeded, Failed:<category>, and these two, which leave a document where it is: it counts as abandoned, not as failed.
ABANDONED = ("Fatal", "Cancelled")
#: Reasons in plain words.
REASONS = {
    "NotXhtmlContentException": "The file holds no XHTML document",
    "Base64DecodingException": "The file is not a decodable Base64 envelope",
    "PathTooLongException": "Path is longer than the file system allows",
    "FileNotFoundException": "The file disappeared before it could be read",
    "DirectoryNotFoundException": "The folder disappeared before the file could be read",
    "TimeoutException": "Conversion exceeded ConversionTimeoutSeconds",
    "UnauthorizedAccessException": "Access denied to the file or the output folder",
    "OutOfMemoryException": "Not enough memory to convert the document",
    "OperationCanceledException": "Stopped while the document was being converted",
    "TaskCanceledException": "Stopped while the document was being converted",
}
FULL_REASON, LOCKED_REASON = "The output volume is full or unreachable", "The file is locked or the volume is unavailable"


def classify_error(error_type: Column, messages: Column, hresult: Column) -> Column:
    """Transient, Permanent or Fatal; the first rule that fits decides. ``messages`` is the chain of messages."""
    licence = F.coalesce(F.exists(messages, lambda m: F.contains(F.lower(m), F.lit("license"))), F.lit(False))
    full = F.coalesce(hresult.bitwiseAND(F.lit(0xFFFF)).isin(*DISK_FULL), F.lit(False))
    return (
        F.when(licence, FATAL)
        .when(error_type.isin(*FATAL_TYPES), FATAL)
        .when(error_type.isin(*IO_TYPES, *PERMANENT_IO) & full, FATAL)
        .when(error_type.isin(*PERMANENT_IO), PERMANENT)
        .when(error_type.isin(*TRANSIENT_TYPES), TRANSIENT)
        .otherwise(PERMANENT)
    )


def describe_reason(error_type: Column, category: Column) -> Column:
    known = None
    for name, reason in REASONS.items():
        known = F.when(error_type == name, reason) if known is None else known.when(error_type == name, reason)
    io = error_type.isin(*IO_TYPES)
    return known.when(io & (category == FATAL), FULL_REASON).when(io, LOCKED_REASON).otherwise(F.concat(F.lit("Conversion failed ("), error_type, F.lit(")")))


def outcome_of(category: Column) -> Column:
    """Succeeded without a category; a fatal error abandons its document."""
    return F.when(category.isNull(), "Succeeded").when(category == FATAL, "Fatal").otherwise(F.concat(F.lit("Failed:"), category))


def resolve_attempts(log: DataFrame, key: str, most: int = 3, delay_ms: int = 500) -> DataFrame:
    """(key, attempts, retries, backoff_ms, category, error_type, outcome) from an attempt log with key,
    attempt, error_type (null: success) and category.

    An attempt counts while none before it was a success, permanent or fatal, and while there are at most
    ``most`` in total. The wait before attempt k + 1 is k times the delay. Where the log has a column ``cancelled``, an attempt of a run that was
    cancelled ends as Cancelled if its error is a cancellation, and is the last; otherwise that error is transient like any other.
    """
    order = W.partitionBy(key).orderBy("attempt")
    rank = F.row_number().over(order)
    stopped = F.coalesce(F.col("cancelled"), F.lit(False)) & F.col("error_type").isin(*CANCELLATIONS) if "cancelled" in log.columns else F.lit(False)
    log = log.withColumn("_stopped", F.coalesce(stopped, F.lit(False)))
    ends = F.col("error_type").isNull() | F.col("category").isin(PERMANENT, FATAL) | F.col("_stopped")
    ended = F.coalesce(F.max(ends.cast("int")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    used = log.withColumn("_n", rank).withColumn("_over", ended).where((F.col("_over") == 0) & (F.col("_n") <= most))
    out = used.groupBy(key).agg(F.max("_n").cast("long").alias("attempts"), F.max_by(F.struct("category", "error_type", "_stopped"), "_n").alias("last"))
    kind = F.when(F.col("last.error_type").isNull(), "Succeeded").when(F.col("last._stopped"), "Cancelled").when(F.col("last.category") == FATAL, "Fatal")
    kind = kind.otherwise(F.concat(F.lit("Failed:"), "last.category"))
    retries = F.col("attempts") - 1
    return out.select(
        key,
        "attempts",
        retries.alias("retries"),
        (delay_ms * retries * (retries + 1) / 2).cast("long").alias("backoff_ms"),
        F.when(F.col("last.error_type").isNotNull(), F.col("last.category")).alias("category"),
        F.col("last.error_type").alias("error_type"),
        kind.alias("outcome"),
    )


def quarantine_unmatched(manifest: DataFrame, pattern: str) -> DataFrame:
    """A failure row for each file whose name does not fit the pattern."""
    odd = manifest.where(~matches_pattern(F.col("file_name"), pattern))
    return odd.select(
        F.lit("scan").alias("batch_id"),
        "date_folder",
        "sub_folder",
        "file_name",
        "length",
        F.lit("Discovery").alias("source"),
        F.lit(PERMANENT).alias("category"),
        F.lit(f"File name does not match {pattern}").alias("reason"),
        F.lit(0).cast("long").alias("attempts"),
        F.lit("FileSearchPatternMismatch").alias("error_type"),
    )


def union_failures(*parts: DataFrame) -> DataFrame:
    """Failures of discovery and of conversion in one table."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def error_row_projection(failures: DataFrame) -> DataFrame:
    """Adds what the report shows: reason, actual name, whether the file was moved, and name of its log."""
    default = F.format_string("%s failure (%s)", F.col("category"), F.col("error_type"))
    return failures.withColumns(
        {
            "reason_text": F.coalesce("reason", default),
            "actual_file_name": F.coalesce("error_file_name", "file_name"),
            "moved_to_error": F.when(F.col("error_file_path").isNotNull() & F.col("move_error").isNull(), "Yes").otherwise("No"),
            "error_log_name": F.coalesce("error_log_file", F.lit("(none)")),
        }
    )


def plan_disposition(outcomes: DataFrame, archive: bool = True, quarantine: bool = True) -> DataFrame:
    """Adds ``destination``, where an input goes: the archive or error folder beside it, or null where it stays."""
    beside = lambda kind: F.concat_ws("/", "folder_path", F.lit(kind), F.when(F.col("sub_folder") != "", F.col("sub_folder")), "file_name")
    moved = F.when((F.col("outcome") == "Succeeded") & F.lit(archive), beside("archive"))
    moved = moved.when(F.col("outcome").isin(*ABANDONED), None)
    return outcomes.withColumn("destination", moved.when((F.col("outcome") != "Succeeded") & F.lit(quarantine), beside("error")))


def resolve_collisions(moves: DataFrame, taken: DataFrame, destination: str = "destination", order: str = "path") -> DataFrame:
    """Adds ``final``: the destination, or the first free ``stem_k.ext``, ignoring case.

    ``taken`` has a column ``destination`` of names in use. The k-th newcomer of a name (by ``order``, which is unique) gets the k-th
    free number; free numbers are those that no taken name and no other newcomer's own name uses. The b-th number in use
    lies after (number - b) free ones, so the k-th free number is k and as many as lie after fewer than k: that is
    a place in one order of both. All numbering is by ``number_rows``, so a name of very many newcomers is on no single task.
    """
    base = lambda c: F.regexp_replace(c, "_([1-9][0-9]{0,8})(\\.[^./]*)?$", "$2")
    number = lambda c: F.regexp_extract(c, "_([1-9][0-9]{0,8})(?:\\.[^./]*)?$", 1)
    used = taken.select(F.lower("destination").alias("_name")).distinct()
    new = number_rows(moves.withColumn("_name", F.lower(destination)), [order], within="_name", out="_k")
    new = new.join(used.withColumn("_used", F.lit(1)), "_name", "left")
    # how many numbered names a newcomer of this name needs: the first may have the name itself if it is free
    new = kept(new.withColumn("_need", F.when(F.col("_used").isNull(), F.col("_k") - 1).otherwise(F.col("_k"))), "newcomers")
    names = used.unionByName(moves.select(F.lower(destination).alias("_name"))).distinct().where(number(F.col("_name")) != "")
    blocked = names.select(base(F.col("_name")).alias("_name"), number(F.col("_name")).cast("long").alias("_b")).distinct().join(new.select("_name").distinct(), "_name", "left_semi")
    blocked = number_rows(kept(blocked, "numbers"), ["_b"], within="_name", out="_rank").select("_name", (F.col("_b") - F.col("_rank")).alias("_at"), F.lit(1).alias("_kind"), F.col("_b").alias("_own"))
    wanted = new.where("_need > 0").select("_name", F.col("_need").alias("_at"), F.lit(0).alias("_kind"), F.col("_need").alias("_own"))
    placed = number_rows(kept(wanted.unionByName(blocked), "places"), ["_at", "_kind", "_own"], within="_name", out="_place").where("_kind = 0")
    # a newcomer of need k is the k-th of its name, so its place says how many numbers in use come before it
    free = placed.select("_name", F.col("_own").alias("_need"), F.col("_place").alias("_free"))
    stem_as_is = F.regexp_replace(F.col(destination), "\\.[^./]*$", "")
    ext_as_is = F.regexp_extract(F.col(destination), "(\\.[^./]*)$", 1)
    final = F.when(F.col("_need") == 0, F.col(destination)).otherwise(F.concat(stem_as_is, F.lit("_"), F.col("_free").cast("string"), ext_as_is))
    return new.join(free, ["_name", "_need"], "left").withColumn("final", final).select(*moves.columns, "final")


def output_name_clashes(manifest: DataFrame) -> DataFrame:
    """(output, inputs): outputs that more than one input maps to, since only the stem of a name is kept."""
    out = F.lower(output_path_of(F.col("date_folder"), F.col("sub_folder"), F.col("stem")))
    return manifest.groupBy(out.alias("output")).agg(F.count("*").alias("inputs")).where("inputs > 1")


def to_trace(converted: DataFrame) -> DataFrame:
    """A trace row for each document, whatever became of it; end is start plus duration."""
    end = F.timestamp_micros(F.unix_micros("start_utc") + F.round(F.col("duration_ms") * 1000).cast("long"))
    return converted.select("worker_slot", "date_folder", "batch_id", "sub_folder", "file_name", "start_utc", end.alias("end_utc"), "duration_ms", "attempts", "outcome")


def error_rates_by_batch(trace: DataFrame) -> DataFrame:
    """Documents and failures of each batch; abandoned documents are no failures."""
    return trace.groupBy("batch_id").agg(F.count("*").alias("documents"), F.count_if(F.startswith("outcome", F.lit("Failed"))).alias("errors"))


def skip_completed_folders(manifest: DataFrame, completed: DataFrame) -> DataFrame:
    """Without folders that are marked complete, ignoring case."""
    done = completed.select(F.lower("date_folder").alias("_done")).distinct()
    return manifest.join(done, F.lower(manifest["date_folder"]) == F.col("_done"), "left_anti")


def skip_already_converted(manifest: DataFrame, outputs: DataFrame, resume: bool = True, archive: bool = False) -> DataFrame:
    """On a resumed run without archiving, without documents whose output is there."""
    if not resume or archive:
        return manifest
    there = outputs.select(F.lower("output").alias("_there")).distinct()
    own = F.lower(output_path_of(manifest["date_folder"], manifest["sub_folder"], manifest["stem"]))
    return manifest.join(there, own == F.col("_there"), "left_anti")


def error_log_text(failures: DataFrame, most: int = 1000) -> DataFrame:
    """Adds ``log_text``, a block of labelled lines, to the first ``most`` failures by ``row`` (0: to all).

    A line for the place stands only where a move failed.
    """
    text = lambda c, none="": F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(none)) if c in failures.columns else F.lit(none)
    # fixed values: the labels of the log's lines
    fields = [
        ("File", F.when(text("actual_file_name") != "", text("actual_file_name")).otherwise(text("file_name"))), ("Original File", text("file_name")), ("Date Folder", text("date_folder")),
        ("Sub Folder", text("sub_folder", "(none)")), ("Batch", text("batch_id")), ("Error Time", F.coalesce(iso_utc(F.col("error_time_utc")), F.lit(""))), ("Source", text("source")),
        ("Category", text("error_category")), ("Reason", text("reason")), ("Attempts", text("attempts")), ("Last Error", F.concat(text("error_type"), F.lit(": "), text("error_message"))),
    ]
    lines = [F.concat(F.lit(f"{label}: "), value) for label, value in fields]
    moved = F.when(text("move_error") != "", F.concat(F.lit("File Location: left in the input folder - move failed: "), text("move_error")))
    block = F.concat_ws("\n", *lines, moved, F.concat(F.lit("Stack Trace: "), text("stack_trace", "(none)")))
    return failures.withColumn("log_text", block if most == 0 else F.when(F.col("row") <= most, block))
