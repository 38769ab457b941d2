"""Reports of runs: reading them, and writing documents, failures, trace, summary and completion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import ISO, hms
from ..operators.batches import deal_parts, number_rows
from ..operators.metrics import PHASES, cpu_disk_split, folder_breakdown, phase_breakdown, worker_breakdown
from ..operators.outcomes import describe_reason
from ..shared import exists, file_tasks, kept, spread

#: Column names of the reports, in their order.
ERROR_COLUMNS = (
    "Row|Error Time Utc|Batch Id|Date Folder|Sub Folder|File Name|Actual File Name|File Size Bytes|Source|Error Category|Reason|Attempts|Error Log File|Moved To Error|"
    "Error File Path|Input File Path|Error Type|Error Message|Move Error"
).split("|")
TRACE_COLUMNS = (
    "Worker Slot|Thread Id|Date Folder|Batch Id|Sub Folder|File Name|Start Utc|End Utc|Duration Ms|Attempts|Outcome|Read Ms|Decode Ms|Validate Ms|Import Ms|Export Ms|Write Ms|Archive Ms"
).split("|")
PART_ROWS = 250_000
CSV = {"header": "true", "escape": '"', "quote": '"', "emptyValue": "", "nullValue": ""}
CSV_OUT = {**CSV, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def snake(name: str) -> str:
    return name.lower().replace(" ", "_")


def rolling_csv(df: DataFrame, path: str, rows: int = PART_ROWS, number: str | None = None, order: list[str] | None = None) -> bool:
    """Write parts of exactly ``rows`` rows, the last one apart, each a file with a header in a folder of its own; nothing where there are no rows.

    Rows go by the column ``number`` (1, 2, ...), else they are numbered by ``order``. With ``rows`` 0, or neither, parts are
    as large as tasks make them: a report of any size is never put through one task.
    """
    if df.isEmpty():
        return False
    if not rows or not (number or order):
        df.write.options(**CSV_OUT).mode("append").csv(path)
        return True
    numbered = df.withColumn("_n", F.col(f"`{number}`").cast("long")) if number else number_rows(df, order, out="_n")
    part = F.format_string("%04d", F.floor((F.col("_n") - 1) / rows) + 1)
    parts = spread(numbered.withColumn("part", part), "part", least=file_tasks(df.sparkSession)).sortWithinPartitions("part", "_n").drop("_n")
    parts.write.options(**CSV_OUT).mode("append").partitionBy("part").csv(path)
    return True


def error_report(failures: DataFrame) -> DataFrame:
    """The 19 columns of the error report; ``Row`` runs over all parts, by error time."""
    rows = number_rows(failures, ["error_time_utc", "input_file_path"], out="row") if "row" not in failures.columns else failures
    text = lambda c: F.date_format(c, ISO) if c == "error_time_utc" else F.coalesce(F.col(c).cast("string"), F.lit("(none)" if c == "error_log_file" else ""))
    return rows.select(*[text(snake(c)).alias(c) for c in ERROR_COLUMNS])


def trace_report(trace: DataFrame, *more: str) -> DataFrame:
    """The 18 columns of the trace, and ``more`` of it as they are: durations with one place, phases with three."""
    def column(c: str):
        name = snake(c)
        if name not in trace.columns:
            return F.lit("").alias(c)
        if name in ("start_utc", "end_utc"):
            return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c)
        if name.endswith("_ms"):
            return F.format_string("%.1f" if name == "duration_ms" else "%.3f", F.col(name).cast("double")).alias(c)
        return F.col(name).cast("string").alias(c)

    return trace.select(*map(column, TRACE_COLUMNS), *more)


def write_error_report(failures: DataFrame, path: str, rows: int = PART_ROWS) -> bool:
    return rolling_csv(error_report(failures), path, rows, number="Row")


def write_trace(trace: DataFrame, path: str, rows: int = PART_ROWS) -> bool:
    """The trace in parts of ``rows`` rows, by start. Its values are shuffled as they are, and become text after that, where each part is written."""
    plain = trace.select(*[snake(c) for c in TRACE_COLUMNS if snake(c) in trace.columns])
    order = [F.col(c).cast("string") for c in ("worker_slot", "date_folder", "sub_folder", "file_name") if c in plain.columns]
    dealt = deal_parts(plain, F.unix_micros("start_utc"), order, rows) if rows and "start_utc" in plain.columns and not trace.isEmpty() else None
    if dealt is not None:
        parts = dealt.withColumn("part", F.format_string("%04d", "part")).sortWithinPartitions("part", "_n")
        trace_report(parts, "part").write.options(**CSV_OUT).mode("append").partitionBy("part").csv(path)
        return True
    return rolling_csv(trace_report(trace), path, rows, order=["Start Utc", "Worker Slot", "Date Folder", "Sub Folder", "File Name"])


def read_report(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All parts below ``path``, as text columns with plain names."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    df = spark.read.schema(schema).options(**CSV, multiLine="true", recursiveFileLookup="true", pathGlobFilter="*.csv").csv(path)
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(snake(c)) for c in columns])


def read_error_report(spark: SparkSession, path: str) -> DataFrame:
    return read_report(spark, path, ERROR_COLUMNS)


def read_trace(spark: SparkSession, path: str) -> DataFrame:
    return read_report(spark, path, TRACE_COLUMNS)


def report_lines(spark: SparkSession, path: str) -> DataFrame:
    """(report, pos, line) of each text report; reports are small, each is one row of the source."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("report"), "value")
    return files.select("report", F.posexplode(F.split("value", "\r\n|\n|\r")).alias("pos", "line"))


def read_summary_header(lines: DataFrame) -> DataFrame:
    """(report, name, value) of the ``Name,Value`` lines before the first blank line; a value keeps its commas."""
    blank = lines.where(F.trim("line") == "").groupBy("report").agg(F.min("pos").alias("blank"))
    head = lines.join(blank, "report", "left").where((F.col("pos") < F.coalesce("blank", F.lit(2**31 - 1))) & (F.instr("line", ",") > 1))
    first = F.min_by("value", "pos").alias("value")  # of lines that repeat a name the first counts
    return head.select("report", "pos", F.substring_index("line", ",", 1).alias("name"), F.regexp_replace("line", "^[^,]*,", "").alias("value")).groupBy("report", "name").agg(first)


def read_phase_section(lines: DataFrame, phases: list[str]) -> DataFrame:
    """(report, name, value): last field of the first line that starts with each phase."""
    rows = None
    for p in phases:
        part = lines.where(F.startswith("line", F.lit(f"{p},"))).groupBy("report").agg(F.min_by(F.element_at(F.split("line", ","), -1), "pos").alias("value"))
        part = part.select("report", F.lit(p).alias("name"), "value")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def read_claims(spark: SparkSession, path: str) -> DataFrame:
    """(date_folder, state, instance) of the ``.done`` and ``.claim`` files, which hold ``key=value`` words."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_name").alias("f"), "value")
    files = files.where(F.col("f").rlike("\\.(done|claim)$"))
    return files.select(F.regexp_replace("f", "\\.(done|claim)$", "").alias("date_folder"), F.regexp_extract("f", "([a-z]+)$", 1).alias("state"), F.regexp_extract("value", "^instance=(\\S+)", 1).alias("instance"))


def read_completed(spark: SparkSession, path: str) -> DataFrame:
    """Completed folders of a checkpoint file; none where it is missing or no checkpoint. A store that can't be reached is an error."""
    if not exists(spark, path):
        return spark.createDataFrame([], "date_folder string")
    df = spark.read.schema("CompletedFolders array<string>, _corrupt_record string").option("multiLine", "true").json(path)
    return df.select(F.explode("CompletedFolders").alias("date_folder")).where("date_folder <> ''").distinct()


def checkpoint_json(checkpoints: DataFrame, completed: DataFrame) -> DataFrame:
    """(run_id, value): the checkpoint file of each run, from rows of ``checkpoint_rows`` and (run_id, date_folder)."""
    done = completed.groupBy("run_id").agg(F.sort_array(F.collect_set("date_folder")).alias("done"))
    names = {"LastProcessedFolder": "last_folder", "LastProcessedFile": "last_file", "TotalProcessed": "total_processed", "TotalSucceeded": "total_succeeded", "TotalFailed": "total_failed"}
    fields = [*(F.col(c).alias(n) for n, c in names.items()), F.coalesce("done", F.array().cast("array<string>")).alias("CompletedFolders")]
    return checkpoints.join(done, "run_id", "left").select("run_id", F.to_json(F.struct(*fields)).alias("value"))


def checkpoint_rows(trace: DataFrame, baselines: DataFrame | None = None) -> DataFrame:
    """(run_id, last_folder, last_file, total_succeeded, total_failed, total_processed) of each run of ``trace``.

    ``baselines`` (run_id, total_succeeded, total_failed) has what a resumed run starts from. Abandoned documents count as neither.
    The last document is that of the last end, at equal ends the last by folder and name.
    """
    last = F.max(F.struct("end_utc", "date_folder", "file_name"))
    ok, bad = F.count_if(F.col("outcome") == "Succeeded"), F.count_if(F.startswith("outcome", F.lit("Failed")))
    own = trace.groupBy("run_id").agg(ok.alias("ok"), bad.alias("bad"), last.alias("last"))
    if baselines is None:
        base = own.select("run_id", F.lit(0).alias("ok0"), F.lit(0).alias("bad0"))
    else:
        base = baselines.select("run_id", F.col("total_succeeded").alias("ok0"), F.col("total_failed").alias("bad0"))
    rows = own.join(base, "run_id", "left").fillna(0, ["ok0", "bad0"])
    ok, bad = F.col("ok") + F.col("ok0"), F.col("bad") + F.col("bad0")
    return rows.select("run_id", F.col("last.date_folder").alias("last_folder"), F.col("last.file_name").alias("last_file"), ok.alias("total_succeeded"), bad.alias("total_failed"), (ok + bad).alias("total_processed"))


def save_checkpoint(checkpoints: DataFrame, completed: DataFrame, path: str) -> None:
    """Append checkpoints (``checkpoint_rows``) and completed folders (run_id, date_folder, instance); earlier rows stay, so the history is the table."""
    now = F.current_timestamp()
    checkpoints.withColumn("saved_at", now).write.mode("append").parquet(f"{path}/checkpoints")
    completed.select("run_id", "date_folder", "instance", now.alias("completed_at")).write.mode("append").parquet(f"{path}/completed_folders")


def last_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """The last checkpoint of each run: the baselines of a resumed one."""
    rows = spark.read.parquet(f"{path}/checkpoints")
    kept = [c for c in rows.columns if c != "run_id"]
    return rows.groupBy("run_id").agg(F.max_by(F.struct(*kept), F.struct("saved_at", "total_processed")).alias("last")).select("run_id", "last.*")


def write_documents(converted: DataFrame, path: str, base64: bool = False, overwrite: bool = True, attempts: int = 3) -> DataFrame:
    """Rendered documents as a table by date folder and batch (``all`` without batch_id); returns the documents that were refused.

    With ``overwrite`` the batches written replace what they held before, and all others stay; without, documents that are
    there already are refused: each is a row (date_folder, batch_id, sub_folder, file_name, outcome, attempts, error_type, reason), a transient failure
    after all attempts. The writer's commit makes a batch appear as a whole.
    """
    from ..functions.decode import base64_line

    spark = converted.sparkSession
    rtf = base64_line(F.encode("rtf", "US-ASCII")) if base64 else F.col("rtf")
    name = F.concat(F.col("stem"), F.lit(".rtf"))
    batch = F.col("batch_id") if "batch_id" in converted.columns else F.lit("all")
    rows = converted.where("rtf is not null").select("date_folder", batch.alias("batch_id"), "sub_folder", name.alias("file_name"), rtf.alias("rtf"))
    error = F.lit("IOException")
    refused = [F.lit("Failed:Transient").alias("outcome"), F.lit(attempts).cast("long").alias("attempts"), error.alias("error_type"), describe_reason(error, F.lit("Transient")).alias("reason")]
    keys = ("date_folder", "sub_folder", "file_name")
    told = lambda df: df.select("date_folder", "batch_id", "sub_folder", "file_name", *refused)
    if overwrite:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_folder", "batch_id").parquet(path)
        return told(rows.where("false"))
    odd = rows.where("false")
    if exists(spark, path):
        key = lambda c: F.lower(F.concat_ws("/", *c))
        there = kept(read_documents_table(spark, path).select(key(keys).alias("_there")).distinct(), "there")  # as it was before this write
        odd = rows.join(there, key(keys) == F.col("_there"), "left_semi")
        rows = rows.join(there, key(keys) == F.col("_there"), "left_anti")
    odd = kept(told(odd), "refused")
    rows.write.mode("append").partitionBy("date_folder", "batch_id").parquet(path)
    return odd


def read_documents_table(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_documents`` wrote."""
    return spark.read.schema("sub_folder string, file_name string, rtf string, date_folder string, batch_id string").parquet(path)


def report_kv(totals: DataFrame, report: str) -> DataFrame:
    """Rows of totals as (report, name, value); ``report`` is the column that names a row's report."""
    cells = [F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in totals.columns if c != report]
    return totals.select(F.col(report).alias("report"), F.explode(F.array(*cells)).alias("c")).select("report", "c.name", "c.value")


#: Names of the phases in the report, and the headers of its sections.
PHASE_NAMES = {
    "read": "Read input", "decode": "Decode Base64/charset", "validate": "Validate content", "import": "Import (XHTML)", "export": "Export (RTF)", "write": "Write output", "archive": "Archive input",
}
FOLDER_HEADER = "Date Folder,Total Files,Succeeded,Failed,Processing Time"
WORKER_HEADER = "Worker Slot,Files Processed,Succeeded,Failed,Abandoned,Busy Time,Busy (% of run),Avg ms/File,Files Per Second"
PHASE_HEADER = "Phase,Kind,Total Seconds,% of Measured,Avg ms/File"
#: Section and place of the first line of totals.
TOTALS = ("3", '{"o0":"a"}')


def csv_cell(c: Column) -> Column:
    """A field of a report, quoted where it holds a comma, a quote or a line end."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(c.rlike('[,"\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def _lines(df: DataFrame, section: str, title: str, header: str, order: list, *cells: Column) -> DataFrame:
    """(section, place, line) of a section of the summary; ``order`` are columns."""
    place = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"o{i}") for i, c in enumerate(order)])
    body = df.select(F.lit(1).alias("kind"), place.alias("place"), F.concat_ws(",", *[csv_cell(c) for c in cells]).alias("line"))
    spark = df.sparkSession
    head = spark.createDataFrame([(0, f"--- {title} ---\n{header}")], "kind int, line string")
    blank = F.struct(*[F.lit("").alias(f"o{i}") for i in range(len(order))])
    head = head.select("kind", blank.alias("place"), "line").join(body.limit(1).select(F.lit(1).alias("any")), F.lit(True), "left_semi")
    return head.unionByName(body).select(F.lit(section).alias("section"), "kind", F.to_json("place").alias("place"), "line")


def summary_header(trace: DataFrame, settings: dict, found: int | None = None, quarantined: int = 0) -> list[tuple[str, str]]:
    """The summary's header as (name, value): ``settings`` first, then the totals of the run; two rows of sums come to the driver. Batch Size and Error Report Parts
    among the settings stand where the report has them.

    ``found`` are the documents found, else those of the trace, and are shown as they are, though more may be processed; ``quarantined`` of them failed before they went to a worker.
    """
    from ..operators.metrics import average_concurrency, peak_concurrency, run_totals, throughput

    spans = trace.select(F.unix_micros("start_utc").alias("start_us"), F.unix_micros("end_utc").alias("end_us"))
    wall = ((F.unix_micros(F.max("end_utc")) - F.unix_micros(F.min("start_utc"))) / 1000).alias("ms")
    extra = trace.agg(wall, F.coalesce(F.sum("duration_ms"), F.lit(0.0)).alias("service_ms"), F.count("*").alias("worked"), F.coalesce(F.sum(F.when(F.col("outcome") == "Succeeded", F.col("bytes_out"))), F.lit(0)).alias("bytes_out"))
    totals = run_totals(trace, 0).drop("remaining")
    one = totals.crossJoin(extra).crossJoin(average_concurrency(trace, int(settings.get("Threads", 1)))).crossJoin(peak_concurrency(spans))  # a row each
    extra = one.first()
    found = extra["worked"] + quarantined if found is None else found
    t = {c: extra[c] for c in totals.columns} | {"failed": extra["failed"] + quarantined, "processed": extra["processed"] + quarantined}
    t["remaining"] = max(0, found - t["processed"])
    spark = trace.sparkSession
    both = spark.createDataFrame([(t["succeeded"], t["processed"], t["bytes_in"], int(extra["bytes_out"]), (extra["ms"] or 0) / 1000.0, float(extra["service_ms"]), t["remaining"])], "succeeded long, processed long, bytes_in long, bytes_out long, elapsed_s double, service_ms double, remaining long")
    rate = throughput(both).first()
    ms = int(extra["ms"] or 0)
    time = f"{ms // 3_600_000 % 24:02d}:{ms // 60_000 % 60:02d}:{ms // 1000 % 60:02d}"
    # fixed values: the names of the report's lines
    rows = [
        ("Peak Concurrent Workers", extra["peak"]), ("Average Concurrent Workers", f"{extra['avg_workers']:.2f}"), ("Worker Utilisation (%)", f"{extra['utilisation_pct']:.1f}"),
        ("Average Worker Service Time (ms)", f"{extra['service_ms'] / max(1, extra['worked']):.1f}"), ("Total Files Found", found), ("Total Files Processed", t["processed"]),
        ("Total Files Succeeded", t["succeeded"]), ("Total Files Failed", t["failed"]), ("Total Retries", t["retries"]), ("Error Report Rows", t["failed"]), ("Total Processing Time", time),
        ("Average Files Per Second", f"{rate['files_per_s']:.2f}"), ("Average Files Per Minute", f"{rate['files_per_min']:.0f}"), ("Average Files Per Hour", f"{rate['files_per_hour']:.0f}"),
        ("Average File Size (MB)", f"{rate['avg_file_mb']:.2f}"), ("Total XHTML Read (GB)", f"{t['bytes_in'] / 1024**3:.2f}"), ("Total RTF Written (GB)", f"{extra['bytes_out'] / 1024**3:.2f}"),
    ]
    placed = {"Batch Size": "Average Worker Service Time (ms)", "Error Report Parts": "Error Report Rows"}
    out = [(k, v) for k, v in settings.items() if k not in placed]
    for k, v in rows:
        out += [(k, v), *((name, settings[name]) for name, after in placed.items() if after == k and name in settings)]
    return [(k, str(v)) for k, v in out]


def summary_sections(trace: DataFrame, quarantined: DataFrame | None = None) -> DataFrame:
    """(section, kind, place, line) of the breakdowns by folder, worker and phase, and the totals of CPU and disk; sorted by these, they are the report's body.

    ``quarantined`` (date_folder) has a row for each document that failed before it went to a worker: these count for their folder, and as processed.
    """
    number = lambda c, places: F.format_string(f"%.{places}f", F.col(c))
    folders, processed = folder_breakdown(trace), None
    if quarantined is not None:
        odd = quarantined.groupBy("date_folder").agg(F.count("*").alias("odd"))
        number_of = lambda c: F.coalesce(F.col(c), F.lit(0))
        both = folders.join(odd, "date_folder", "full")
        folders = both.select("date_folder", (number_of("total") + number_of("odd")).alias("total"), number_of("succeeded").alias("succeeded"), (number_of("failed") + number_of("odd")).alias("failed"), number_of("elapsed_ms").alias("elapsed_ms"))
        processed = folders.agg(F.coalesce(F.sum(F.col("succeeded") + F.col("failed")), F.lit(0))).first()[0]
    out = _lines(folders, "1", "Per-Folder Breakdown", FOLDER_HEADER, ["date_folder"], F.col("date_folder"), F.col("total"), F.col("succeeded"), F.col("failed"), hms(F.col("elapsed_ms")))
    workers = worker_breakdown(trace).withColumn("slot", F.lpad(F.col("worker_slot").cast("string"), 12, "0"))
    cells = [F.col("worker_slot"), F.col("processed"), F.col("succeeded"), F.col("failed"), F.col("abandoned"), hms(F.col("busy_ms")), number("busy_pct", 1), number("avg_ms", 1), number("files_per_s", 2)]
    out = out.unionByName(_lines(workers, "2", "Per-Worker Breakdown", WORKER_HEADER, ["slot"], *cells))
    names, place = F.col("phase"), F.lit("9")
    for i, (p, _) in enumerate(PHASES):
        names, place = F.when(F.col("phase") == p, PHASE_NAMES[p]).otherwise(names), F.when(F.col("phase") == p, str(i)).otherwise(place)
    phases = phase_breakdown(trace).select(names.alias("name"), "kind", "total_s", "pct", "avg_ms", place.alias("place"))
    split = cpu_disk_split(trace, processed)
    measured = split.where("kind <> 'Overhead'").agg(F.sum("total_s").alias("all_s"))  # one row
    kinds = split.crossJoin(F.broadcast(measured)).withColumn("pct", F.coalesce(F.try_divide("total_s", "all_s"), F.lit(0.0)) * 100)
    name = F.when(F.col("kind") == "Overhead", "Unattributed").otherwise(F.concat("kind", F.lit(" total")))
    kinds = kinds.select(name.alias("name"), "kind", "total_s", "pct", "avg_ms", F.when(F.col("kind") == "CPU", "a").when(F.col("kind") == "Disk", "b").otherwise("c").alias("place"))
    rows = phases.unionByName(kinds)
    return out.unionByName(_lines(rows, "3", "Phase Breakdown (successful conversions)", PHASE_HEADER, ["place"], F.col("name"), F.col("kind"), number("total_s", 1), number("pct", 1), number("avg_ms", 3)))


def summary_text(header: list[tuple[str, str]], sections: DataFrame | None = None) -> str:
    """The summary report. Its sections have a row for each folder, worker and phase, and are read part by part."""
    cell = lambda v: f'"{v.replace(chr(34), chr(34) * 2)}"' if any(x in v for x in ',"\r\n') else v
    lines = [f"{k},{cell(str(v))}" for k, v in header]
    for r in sections.orderBy("section", "kind", "place").toLocalIterator() if sections is not None else ():
        apart = r["kind"] == 0 or (r["section"], r["place"]) == TOTALS  # the phases' totals stand apart
        lines += [*([""] if apart else []), *(r["line"].split("\n") if r["kind"] == 0 else [r["line"]])]
    return "\n".join(lines) + "\n"


def newest_reports(runs: DataFrame, written: DataFrame) -> DataFrame:
    """(run, report): the newest report written at or after each run's start, so that no earlier file is taken for it.

    ``runs``: run, started_at; ``written``: run, report, written_at. Runs without such a report are left out; ties go to the last name.
    """
    since = runs.join(written, "run").where(F.col("written_at") >= F.col("started_at"))
    return since.groupBy("run").agg(F.max_by("report", F.struct("written_at", "report")).alias("report"))


def append_matrix(matrix: DataFrame, path: str) -> None:
    matrix.write.options(**CSV).mode("append").csv(path)
