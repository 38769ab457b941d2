"""Registered queries that write to the shared folder and read back: file trees, reports, checkpoints, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import decode, markup, markup_tree, times
from ..functions.paths import exclude_reserved, split_path
from ..functions.rtf import HEAD
from ..operators import batches, convert, outcomes, verify
from ..shared import kept, new_path
from ..sources import files, reports
from ..streaming import ingest
from .catalog import EVENT_ERROR_SQL, PHASES_SQL, REASON_SQL, TRACE_SQL, _shaped, document_files, event_errors, line_trace
from .registry import query, table

# --- pages as a tree of files ----------------------------------------------------------------------------------------

TREE_SQL = """WITH t AS (SELECT page_id, CASE WHEN page_id % 13 = 0 THEN 'Archive' ELSE 'd' || page_id % 5 END AS date_folder, CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'p1' WHEN 2 THEN 'archive' ELSE 'p2/archive' END AS sub_folder,
  CASE page_id % 3 WHEN 0 THEN '_' WHEN 1 THEN '.' ELSE '' END || 'n' || page_id || CASE WHEN page_id % 10 = 7 THEN '.pdf' ELSE '.xhtml' END AS file_name, CASE WHEN page_id % 11 = 0 THEN '' ELSE coalesce(html, '') END AS body FROM pages WHERE page_id % 17 <> 0),
  docs AS (SELECT * FROM t WHERE date_folder <> 'Archive' AND sub_folder <> 'archive')"""


def page_tree(s, d) -> str:
    """Writes pages as files and returns the root: hidden names, empty files, reserved folders at both levels, files in the root, empty folders."""
    i, n = F.col("page_id"), F.col("page_id").cast("string")
    folder = F.when(i % 13 == 0, "Archive").otherwise(F.concat(F.lit("d"), (i % 5).cast("string")))
    sub = F.when(i % 4 == 1, "p1").when(i % 4 == 2, "archive").when(i % 4 == 3, "p2/archive")
    name = F.concat(F.when(i % 3 == 0, "_").when(i % 3 == 1, ".").otherwise(""), F.lit("n"), n, F.when(i % 10 == 7, ".pdf").otherwise(".xhtml"))
    rel = F.when(i % 17 == 0, F.concat(F.lit("t"), n, F.when(i % 2 == 0, ".XHTML").otherwise(".txt"))).otherwise(F.concat_ws("/", folder, sub, name))
    body = F.when(i % 11 == 0, F.lit(b"")).otherwise(F.encode(F.coalesce("html", F.lit("")), "UTF-8"))
    pages = table(s, d, "pages")
    rows = pages.select(rel.alias("rel"), body.alias("content"))
    empty = pages.where(i % 29 == 0).select(F.concat(F.lit("empty"), n).alias("rel"), F.lit(None).cast("binary").alias("content"))
    root = new_path(s, "tree")
    files.write_files(rows.unionByName(empty), root)
    return root


@query(TREE_SQL + " SELECT DISTINCT date_folder FROM t WHERE date_folder <> 'Archive' UNION SELECT 'empty' || page_id FROM pages WHERE page_id % 29 = 0")
def list_date_folders(s, d):
    return files.list_date_folders(s, page_tree(s, d)).select("date_folder")


@query(TREE_SQL + ", f AS (SELECT DISTINCT date_folder FROM t WHERE date_folder <> 'Archive' UNION SELECT 'empty' || page_id FROM pages WHERE page_id % 29 = 0) SELECT row_number() OVER (ORDER BY date_folder) AS row, date_folder FROM f")
def ordinal_folders(s, d):
    """Folders in ordinal order (I7), as their numbers show."""
    return batches.number_rows(files.list_date_folders(s, page_tree(s, d)).select("date_folder"), ["date_folder"])


@query(TREE_SQL + " SELECT date_folder, sub_folder, file_name, strlen(body)::BIGINT AS length FROM docs")
def list_documents(s, d):
    return files.list_documents(s, page_tree(s, d)).select("date_folder", "sub_folder", "file_name", "length")


@query(TREE_SQL + " SELECT date_folder, sub_folder, file_name FROM docs WHERE date_folder = 'd3'")
def only_date_folder(s, d):
    return files.list_documents(s, page_tree(s, d), only="D3").select("date_folder", "sub_folder", "file_name")


@query("SELECT 't' || page_id || '.XHTML' AS rel FROM pages WHERE page_id % 17 = 0 AND page_id % 2 = 0")
def stranded_files(s, d):
    return files.stranded_files(s, page_tree(s, d)).select("rel")


@query(TREE_SQL + " SELECT date_folder, file_name, sha256(body) AS content_sha256 FROM docs")
def read_envelopes(s, d):
    """Content of all files, of hidden names and empty ones too."""
    return files.read_envelopes(files.list_documents(s, page_tree(s, d))).select("date_folder", "file_name", F.sha2("content", 256).alias("content_sha256"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 3 THEN 'a' ELSE 'archived' END AS date_folder FROM documents WHERE doc_id % 5 IN (3, 4)")
def exclude_reserved_folders(s, d):
    k = F.col("doc_id") % 5
    name = F.when(k == 0, "archive").when(k == 1, "ERROR").when(k == 2, ".Claims").when(k == 3, "a").otherwise("archived")
    return exclude_reserved(table(s, d, "documents").select("doc_id", name.alias("date_folder")), claim_folder=".claims")


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS date_folder, CASE WHEN month(min(o_orderdate)) % 3 = 0 THEN 'claim' ELSE 'done' END AS state, 'inst' || min(o_custkey % 3) AS instance FROM orders GROUP BY 1""")
def read_claims(s, d):
    """Months of orders as claims of instances: every third month is still claimed."""
    by = table(s, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("m")).agg(F.min(F.col("o_custkey") % 3).alias("i"))
    state = F.when(F.substring("m", 6, 2).cast("int") % 3 == 0, ".claim").otherwise(".done")
    root = new_path(s, "claims")
    files.write_files(by.select(F.concat("m", state).alias("rel"), F.encode(F.concat(F.lit("instance=inst"), F.col("i").cast("string"), F.lit(" machine=m pid=1\n")), "UTF-8").alias("content")), root)
    return reports.read_claims(s, root)


# --- documents: output, failures, text -------------------------------------------------------------------------------


@query("""SELECT lang AS date_folder, 'b' || doc_id % 3 AS batch_id, 'n' || doc_id || '.rtf' AS file_name, CASE WHEN doc_id % 3 = 0 THEN 'second' WHEN doc_id % 3 = 2 AND doc_id % 2 = 1 THEN 'late' ELSE 'first' END AS rtf FROM documents""")
def write_documents(s, d):
    """Three writes: two batches and a half, one batch again, and all without overwriting, which adds what is missing."""
    k = F.col("doc_id") % 3
    rows = table(s, d, "documents").select("doc_id", F.col("lang").alias("date_folder"), F.lit("").alias("sub_folder"), F.concat(F.lit("n"), F.col("doc_id").cast("string")).alias("stem"), F.concat(F.lit("b"), k.cast("string")).alias("batch_id"))
    path = new_path(s, "output")
    first = rows.withColumn("rtf", F.lit("first"))
    reports.write_documents(first.where(k < 2), path)
    reports.write_documents(first.where((k == 2) & (F.col("doc_id") % 2 == 0)), path)
    reports.write_documents(rows.where(k == 0).withColumn("rtf", F.lit("second")), path)
    reports.write_documents(rows.withColumn("rtf", F.lit("late")), path, overwrite=False)
    return reports.read_documents_table(s, path).drop("sub_folder")


@query("""WITH f AS (SELECT doc_id, lang, source, row_number() OVER (ORDER BY doc_id) AS n FROM documents)
  SELECT doc_id, CASE WHEN n <= 100 THEN sha256('File: e' || doc_id || chr(10) || 'Original File: f' || doc_id || chr(10) || 'Date Folder: ' || lang || chr(10) || 'Sub Folder: ' || CASE WHEN doc_id % 2 = 0 THEN '(none)' ELSE source END || chr(10) ||
  'Batch: ' || lang || '#0001' || chr(10) || 'Error Time: 2026-08-01T12:00:00Z' || chr(10) || 'Source: Conversion' || chr(10) || 'Category: Permanent' || chr(10) || 'Reason: why' || chr(10) || 'Attempts: 1' || chr(10) || 'Last Error: XmlException: at ' || doc_id || chr(10) ||
  CASE WHEN doc_id % 3 = 0 THEN 'File Location: left in the input folder - move failed: locked' || chr(10) ELSE '' END || 'Stack Trace: (none)') END AS log_sha256 FROM f""")
def error_log_text(s, d):
    """The first hundred failures get a log; that bound is the operator's."""
    i = F.col("doc_id").cast("string")
    rows = table(s, d, "documents").select(
        "doc_id", F.concat(F.lit("e"), i).alias("actual_file_name"), F.concat(F.lit("f"), i).alias("file_name"), F.col("lang").alias("date_folder"), F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("source")).alias("sub_folder"),
        F.concat("lang", F.lit("#0001")).alias("batch_id"), F.lit("2026-08-01 12:00:00").cast("timestamp").alias("error_time_utc"), F.lit("Conversion").alias("source"), F.lit("Permanent").alias("error_category"), F.lit("why").alias("reason"),
        F.lit(1).alias("attempts"), F.lit("XmlException").alias("error_type"), F.concat(F.lit("at "), i).alias("error_message"), F.when(F.col("doc_id") % 3 == 0, "locked").alias("move_error"),
    )
    return outcomes.error_log_text(batches.number_rows(rows, ["doc_id"]), 100).select("doc_id", F.sha2("log_text", 256).alias("log_sha256"))


@query("SELECT doc_id, NULL::VARCHAR AS neither, CASE WHEN doc_id % 3 = 1 THEN '/in/' || lang || '/error/n' END AS only_error, CASE WHEN doc_id % 3 = 0 THEN '/in/' || lang || '/archive/n' END AS only_archive FROM documents")
def quarantine_switch(s, d):
    """Where inputs go with archive and quarantine off, or one of them on."""
    k = F.col("doc_id") % 3
    rows = table(s, d, "documents").select("doc_id", F.concat(F.lit("/in/"), "lang").alias("folder_path"), F.lit("").alias("sub_folder"), F.lit("n").alias("file_name"), F.when(k == 0, "Succeeded").when(k == 1, "Failed:Permanent").otherwise("Cancelled").alias("outcome"))
    for name, archive, quarantine in (("neither", False, False), ("only_error", False, True), ("only_archive", True, False)):
        rows = outcomes.plan_disposition(rows, archive, quarantine).withColumnRenamed("destination", name)
    return rows.select("doc_id", "neither", "only_error", "only_archive")


@query("""SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN sha256(CASE doc_id % 3 WHEN 1 THEN '' ELSE '<meta charset="utf-8">' END || coalesce(text, '') || CASE WHEN doc_id % 3 = 1 THEN chr(65533) ELSE '' END) END AS text_sha256, doc_id % 3 = 0 AS failed FROM documents""")
def strict_utf8(s, d):
    """Declared UTF-8 with a wrong byte fails; after a mark the byte is replaced; declared and right is read."""
    k, t = F.col("doc_id") % 3, F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    said = F.lit(b'<meta charset="utf-8">')
    data = F.when(k == 0, F.concat(said, t, F.lit(b"\xff"))).when(k == 1, F.concat(F.lit(b"\xef\xbb\xbf"), t, F.lit(b"\xff"))).otherwise(F.concat(said, t))
    rows = table(s, d, "documents").select("doc_id", decode.base64_line(data).cast("binary").alias("content"))
    return decode.read_documents(rows).select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.col("error").isNotNull().alias("failed"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'color:' || lang WHEN 1 THEN source || ';x' WHEN 2 THEN lang END AS style FROM documents")
def style_values(s, d):
    """Values in double quotes, in single ones and bare, and attributes without a style."""
    k = F.col("doc_id") % 4
    attrs = F.when(k == 0, F.concat(F.lit(' class="a" STYLE = "color:'), "lang", F.lit('"'))).when(k == 1, F.concat(F.lit(" style='"), "source", F.lit(";x'"))).when(k == 2, F.concat(F.lit(" style="), "lang", F.lit(" id=b"))).otherwise(' class="style"')
    return table(s, d, "documents").select("doc_id", markup.style_value(attrs).alias("style"))


@query("""SELECT doc_id, sha256('x ' || chr(8226) || chr(183) || chr(160) || chr(8226) || chr(9642) || ' &lt;' || replace(coalesce(text, ''), '&', '+')) AS text_sha256 FROM documents""")
def marker_entities(s, d):
    """Named and numeric references of markers; others stay."""
    text = F.concat(F.lit("x &bull;&middot;&nbsp;&#8226;&#x25AA; &lt;"), F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("+")))
    rows = table(s, d, "documents").select("doc_id", text.alias("t"))
    return rows.select("doc_id", markup_tree.apply_pass(F.col("t"), "decode_markers").alias("t")).select("doc_id", F.sha2("t", 256).alias("text_sha256"))


RTF_SQL = r"""WITH t AS (SELECT doc_id, ltrim(regexp_replace(coalesce(text, ''), '[ \t\r\n\f]+', ' ', 'g'), ' ') AS t FROM documents), e AS (SELECT doc_id, t, array_to_string(list_transform(regexp_extract_all(t, '(?s).'), lambda c: CASE
  WHEN c IN ('\', '{', '}') THEN '\' || c WHEN unicode(c) < 32 THEN ' ' WHEN unicode(c) < 128 THEN c WHEN unicode(c) < 32768 THEN '\u' || unicode(c) || '?' WHEN unicode(c) < 65536 THEN '\u' || (unicode(c) - 65536) || '?'
  ELSE '\u' || (55296 + ((unicode(c) - 65536) >> 10) - 65536) || '?\u' || (56320 + ((unicode(c) - 65536) & 1023) - 65536) || '?' END), '') AS r FROM t)
  SELECT doc_id, sha256('HEAD' || chr(10) || CASE WHEN t = '' THEN '' ELSE r || '\par' || chr(10) END || '{\b No} ' || doc_id || '{\i\strike  \u176?C}\par' || chr(10) || '\u8226?\~item\par' || chr(10) || '}') AS rtf_sha256 FROM e"""


@query(RTF_SQL.replace("HEAD", HEAD))
def render_documents(s, d):
    """Texts as RTF, byte for byte: a paragraph of the text, one with styles, and an item."""
    rows = _shaped(s, d, "<div>", "{}", "</div>")
    more = F.concat("text", F.lit("<p><b>No</b> "), F.col("doc_id").cast("string"), F.lit('<i style="text-decoration: line-through"> &#176;C</i></p><ul><li>item</li></ul>'))
    return convert.convert(rows.select("doc_id", more.alias("text"))).select("doc_id", F.sha2("rtf", 256).alias("rtf_sha256"))


TABLE_SQL = RTF_SQL[: RTF_SQL.rindex("SELECT doc_id, sha256")] + r"""SELECT doc_id, sha256('HEAD' || chr(10) || 'A\par' || chr(10) || '\trowd\trgaph108\cellx2250\cellx9000' || chr(10) || '\intbl {\b No}\cell' || chr(10) || '\intbl {\b Text}\cell' || chr(10) || '\row' || chr(10)
  || '\trowd\trgaph108\cellx2250\cellx9000' || chr(10) || '\intbl ' || doc_id || '\cell' || chr(10) || '\intbl ' || r || '\cell' || chr(10) || '\row' || chr(10) || '\trowd\trgaph108\cellx9000' || chr(10) || '\intbl {\i a}\par' || chr(10) || 'b\cell' || chr(10) || '\row' || chr(10)
  || '\pard' || chr(10) || 'B\par' || chr(10) || '}') AS rtf_sha256 FROM e"""


@query(TABLE_SQL.replace("HEAD", HEAD))
def render_tables(s, d):
    """Tables with widths, a head and a span, byte for byte."""
    n = F.col("doc_id").cast("string")
    head = F.lit("<p>A</p><table><thead><tr><th width='25%'>No</th><th width='75%'>Text</th></tr></thead><tr><td>")
    text = F.concat(head, n, F.lit("</td><td>"), "text", F.lit('</td></tr><tr><td colspan="2"><p><i>a</i></p><p>b</p></td></tr></table><p>B</p>'))
    return convert.convert(_shaped(s, d, "{}").select("doc_id", text.alias("text"))).select("doc_id", F.sha2("rtf", 256).alias("rtf_sha256"))


# --- reports of runs -------------------------------------------------------------------------------------------------


def event_failures(s, d) -> DataFrame:
    """Failed events as rows of the error report; messages hold quotes, commas and line ends."""
    e = event_errors(s, d).where("error_type is not null")
    i = F.col("event_id").cast("string")
    values = {
        "error_time_utc": F.col("ts").cast("timestamp"), "batch_id": F.lit("b#0001"), "date_folder": F.date_format("ts", "yyyy-MM-dd"), "sub_folder": F.lit(""), "file_name": F.concat(F.lit("e"), i, F.lit(".xhtml")), "actual_file_name": F.lit("a"),
        "file_size_bytes": F.col("event_id") * 3, "source": F.lit("Conversion"), "error_category": F.col("category"), "reason": outcomes.describe_reason(F.col("error_type"), F.col("category")), "attempts": F.lit(1),
        "error_log_file": F.when(F.col("event_id") % 2 == 0, "x.error.log"), "moved_to_error": F.lit("Yes"), "error_file_path": F.lit("/e"), "input_file_path": F.concat(F.lit("/in/"), F.lpad(i, 12, "0")),
        "error_message": F.concat(F.lit('Odd "name",\r\nrow '), i), "move_error": F.lit(None).cast("string"),
    }
    return e.select(*[v.alias(k) for k, v in values.items()], "error_type")


FAILURES_SQL = EVENT_ERROR_SQL + f""", f AS (SELECT row_number() OVER (ORDER BY ts, lpad(event_id::VARCHAR, 12, '0')) AS n, *, {REASON_SQL} AS reason FROM c WHERE error_type IS NOT NULL)"""


@query(FAILURES_SQL + """ SELECT n::VARCHAR AS row, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS error_time_utc, 'e' || event_id || '.xhtml' AS file_name, (event_id * 3)::VARCHAR AS file_size_bytes, category AS error_category, reason,
  CASE WHEN event_id % 2 = 0 THEN 'x.error.log' ELSE '(none)' END AS error_log_file, 'Odd "name",' || chr(13) || chr(10) || 'row ' || event_id AS error_message, '' AS move_error FROM f""")
def error_report(s, d):
    """The error report, written in parts and read back."""
    path = new_path(s, "errors")
    reports.write_error_report(event_failures(s, d), path, 500)
    return reports.read_error_report(s, path).select("row", "error_time_utc", "file_name", "file_size_bytes", "error_category", "reason", "error_log_file", "error_message", "move_error")


@query(FAILURES_SQL + " SELECT (n - 1) // 500 + 1 AS part, count(*) AS rows, min(n) AS first_row, max(n) AS last_row FROM f GROUP BY 1")
def rolling_csv(s, d):
    """Parts of the error report: exactly 500 rows each but the last, numbered on."""
    path = new_path(s, "errors")
    reports.write_error_report(event_failures(s, d), path, 500)
    rows = s.read.options(**reports.CSV, multiLine="true").csv(path).select(F.col("part").cast("long").alias("part"), F.col("Row").cast("long").alias("row"))
    return rows.groupBy("part").agg(F.count("*").alias("rows"), F.min("row").alias("first_row"), F.max("row").alias("last_row"))


@query(TRACE_SQL + """SELECT worker_slot::VARCHAR AS worker_slot, date_folder, batch_id, sub_folder, file_name, strftime(make_timestamp(s), '%Y-%m-%dT%H:%M:%S.%fZ') AS start_utc, strftime(make_timestamp(e), '%Y-%m-%dT%H:%M:%S.%fZ') AS end_utc, printf('%.1f', duration_ms) AS duration_ms,
  attempts::VARCHAR AS attempts, outcome, printf('%.3f', read_ms) AS read_ms, printf('%.3f', decode_ms) AS decode_ms FROM trace""")
def trace_report(s, d):
    """The trace, written in parts and read back."""
    path = new_path(s, "trace")
    reports.write_trace(line_trace(s, d), path, 10_000)
    return reports.read_trace(s, path).select("worker_slot", "date_folder", "batch_id", "sub_folder", "file_name", "start_utc", "end_utc", "duration_ms", "attempts", "outcome", "read_ms", "decode_ms")


def run_report(s, d) -> DataFrame:
    """(report, pos, line) of the summary of the line items' run."""
    trace = line_trace(s, d).withColumn("bytes_out", F.col("bytes_in") * 2)
    text = reports.summary_text(reports.summary_header(trace, {"Stage": "1 (XHTML to RTF)", "Status": "COMPLETED, all", "Threads": 8}, found=2_000_000), reports.summary_sections(trace))
    root = new_path(s, "reports")
    files.write_files(s.createDataFrame([("migration_report.csv", bytearray(text.encode()))], "rel string, content binary"), root)  # a row for each folder, worker and phase
    return reports.report_lines(s, root)


TOTALS_SQL = TRACE_SQL + """, n AS (SELECT count(*) FILTER (outcome = 'Succeeded') AS ok, count(*) FILTER (outcome LIKE 'Failed%') AS bad, sum(attempts - 1)::BIGINT AS retries, sum(bytes_in) FILTER (outcome = 'Succeeded') AS b, (max(e) - min(s)) / 1e6::DOUBLE AS sec FROM trace)"""


@query(TOTALS_SQL + """ SELECT 'migration_report.csv' AS report, unnest(['Stage', 'Status', 'Threads', 'Total Files Found', 'Total Files Processed', 'Total Files Succeeded', 'Total Files Failed', 'Total Retries', 'Error Report Rows', 'Average Files Per Second', 'Average Files Per Hour', 'Total RTF Written (GB)', 'Total Processing Time']) AS name,
  unnest(['1 (XHTML to RTF)', '"COMPLETED, all"', '8', '2000000', (ok + bad)::VARCHAR, ok::VARCHAR, bad::VARCHAR, retries::VARCHAR, bad::VARCHAR, printf('%.2f', (ok + bad) / sec), printf('%.0f', (ok + bad) / sec * 3600), printf('%.2f', 2 * b / 1073741824.0),
  printf('%02d:%02d:%02d', floor(sec / 3600)::BIGINT % 24, floor(sec / 60)::BIGINT % 60, floor(sec)::BIGINT % 60)]) AS value FROM n""")
def summary_header(s, d):
    """Header of the summary report, written and read back."""
    names = ["Stage", "Status", "Threads", "Total Files Found", "Total Files Processed", "Total Files Succeeded", "Total Files Failed", "Total Retries", "Error Report Rows", "Average Files Per Second", "Average Files Per Hour"]
    return reports.read_summary_header(run_report(s, d)).where(F.col("name").isin(*names, "Total RTF Written (GB)", "Total Processing Time"))


@query(PHASES_SQL + """ SELECT 'migration_report.csv' AS report, CASE phase WHEN 'read' THEN 'Read input' WHEN 'import' THEN 'Import (XHTML)' ELSE 'Write output' END AS name, printf('%.3f', sum(ms) / count(*)) AS value FROM p WHERE phase IN ('read', 'import', 'write') GROUP BY phase""")
def phase_section(s, d):
    """Last fields of rows of the summary's section of phases."""
    return reports.read_phase_section(run_report(s, d), ["Read input", "Import (XHTML)", "Write output"])


@query(TRACE_SQL + """, f AS (SELECT date_folder, count(*) AS n, count(*) FILTER (outcome = 'Succeeded') AS ok, count(*) FILTER (outcome LIKE 'Failed%') AS bad, (max(e) - min(s)) // 1000000 AS sec FROM trace GROUP BY 1)
  SELECT date_folder || ',' || n || ',' || ok || ',' || bad || ',' || printf('%02d:%02d:%02d', sec // 3600 % 24, sec // 60 % 60, sec % 60) AS line FROM f UNION ALL SELECT unnest(['--- Per-Folder Breakdown ---', 'Date Folder,Total Files,Succeeded,Failed,Processing Time'])""")
def write_summary(s, d):
    """The summary's section of folders as it stands in the file."""
    lines = run_report(s, d)
    at = lines.where("line like '--- Per-%'").groupBy("report").agg(F.min("pos").alias("a"), F.max("pos").alias("b"))
    return lines.join(at, "report").where("pos >= a and pos < b - 1").select("line")


@query(TRACE_SQL + """SELECT run_id, arg_max(date_folder, (e, date_folder, file_name)) AS last_folder, arg_max(file_name, (e, date_folder, file_name)) AS last_file, 2 * count(*) FILTER (outcome = 'Succeeded') AS total_succeeded,
  2 * count(*) FILTER (outcome LIKE 'Failed%') AS total_failed, 2 * count(*) FILTER (outcome = 'Succeeded' OR outcome LIKE 'Failed%') AS total_processed FROM trace GROUP BY 1""")
def save_checkpoint(s, d):
    """Checkpoints of two runs, then of the same runs resumed: totals go on from the last ones."""
    trace, path = line_trace(s, d), new_path(s, "checkpoint")
    done = trace.select("run_id", "date_folder", F.lit("i1").alias("instance")).distinct()
    reports.save_checkpoint(reports.checkpoint_rows(trace), done, path)
    reports.save_checkpoint(reports.checkpoint_rows(trace, reports.last_checkpoints(s, path)), done, path)
    return reports.last_checkpoints(s, path).drop("saved_at")


@query(TRACE_SQL + "SELECT DISTINCT date_folder FROM trace WHERE run_id = 'F'")
def read_completed(s, d):
    """Completed folders of one run's checkpoint file (A9, json)."""
    trace, root = line_trace(s, d), new_path(s, "checkpoint")
    texts = reports.checkpoint_json(reports.checkpoint_rows(trace), trace.select("run_id", "date_folder").distinct())
    files.write_files(texts.select(F.concat("run_id", F.lit(".json")).alias("rel"), F.encode("value", "UTF-8").alias("content")), root)
    return reports.read_completed(s, f"{root}/F.json")


@query("""SELECT o_orderpriority AS run, o_orderstatus AS status, 2 AS times, count(*)::VARCHAR AS n FROM orders GROUP BY 1, 2""")
def append_matrix(s, d):
    """Rows of a matrix, appended twice."""
    path = new_path(s, "matrix")
    rows = table(s, d, "orders").groupBy(F.col("o_orderpriority").alias("run"), F.col("o_orderstatus").alias("status")).agg(F.count("*").cast("string").alias("n"))
    for _ in range(2):
        reports.append_matrix(rows, path)
    return s.read.option("header", "true").csv(path).groupBy("run", "status", "n").agg(F.count("*").cast("int").alias("times"))


@query("""WITH r AS (SELECT o_orderpriority AS run, min(o_orderdate) + INTERVAL 300 DAY AS t FROM orders GROUP BY 1) SELECT run, arg_max(o_orderkey::VARCHAR, (o_orderdate, o_orderkey::VARCHAR)) AS report FROM orders JOIN r ON run = o_orderpriority WHERE o_orderdate >= t AND o_orderkey % 5 <> 0 GROUP BY 1""")
def newest_reports(s, d):
    """Newest order of each priority since a date: the newest report since each run's start (I8)."""
    o = table(s, d, "orders").select(F.col("o_orderpriority").alias("run"), F.col("o_orderkey").cast("string").alias("report"), F.col("o_orderdate").alias("written_at"), "o_orderkey")
    runs = o.groupBy("run").agg((F.min("written_at") + F.expr("INTERVAL 300 DAY")).alias("started_at"))
    return reports.newest_reports(runs, o.where("o_orderkey % 5 <> 0").drop("o_orderkey"))


@query("""SELECT o_orderkey, printf('%02d:%02d:%02d', o_orderkey * 7 // 3600 % 24, o_orderkey * 7 // 60 % 60, o_orderkey * 7 % 60) AS elapsed, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS stamp, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS utc FROM orders""")
def report_times(s, d):
    """Durations that drop whole days, stamps of runs, and times of reports (section 2.10)."""
    at = F.col("o_orderdate").cast("timestamp")
    return table(s, d, "orders").select("o_orderkey", times.hms(F.col("o_orderkey") * 7000 + 999).alias("elapsed"), times.run_stamp(at).alias("stamp"), times.iso_utc(at).alias("utc"))


# --- streams ---------------------------------------------------------------------------------------------------------


def arriving(s, d, root: str, part: int) -> None:
    """Writes half of the documents as files of folders; empty texts hold a line end, since a stream's source skips empty files."""
    rows = document_files(s, d).where(F.col("doc_id") % 2 == part)
    text = F.concat(F.coalesce("text", F.lit("")), F.lit("\n"))
    files.write_files(rows.select(F.concat_ws("/", "date_folder", "sub_folder", F.concat(F.lit("n"), F.col("doc_id").cast("string"))).alias("rel"), F.encode(text, "UTF-8").alias("content")), root)


ARRIVED_SQL = "SELECT lang AS date_folder, count(*) AS documents, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS bytes FROM documents"


@query(ARRIVED_SQL + " GROUP BY 1")
def ingest_and_resume(s, d):
    """Files arrive in two halves; the second run reads only what the first did not."""
    root, out = new_path(s, "arrivals"), new_path(s, "ingested")
    for part in (0, 1):
        arriving(s, d, root, part)
        stream = ingest.ingest_incremental(s, root, 200)
        ingest.resume(stream, lambda b: b.select("date_folder", "path", "length"), out, f"{out}-state").awaitTermination()
    return s.read.parquet(out).groupBy("date_folder").agg(F.count("*").alias("documents"), F.sum("length").alias("bytes"))


@query(ARRIVED_SQL + " WHERE lang IN ('fr', 'de') GROUP BY 1")
def late_files(s, d):
    """Files that arrive in folders marked complete, found on the stream."""
    root, out = new_path(s, "arrivals"), new_path(s, "late")
    done = s.createDataFrame([("FR",), ("De",)], "date_folder string")
    for part in (0, 1):
        arriving(s, d, root, part)
        stream = ingest.late_files(ingest.ingest_incremental(s, root, 200), done)
        ingest.resume(stream, lambda b: b.select("date_folder", "path", "length"), out, f"{out}-state").awaitTermination()
    return s.read.parquet(out).groupBy("date_folder").agg(F.count("*").alias("documents"), F.sum("length").alias("bytes"))


@query("SELECT lang AS date_folder, CASE WHEN doc_id % 5 = 0 THEN 'Failed:Permanent' ELSE 'Succeeded' END AS outcome, count(*) AS documents, sum(n_chars)::BIGINT AS bytes FROM documents GROUP BY 1, 2")
def live_progress(s, d):
    """Documents and bytes so far, by a stream over outcomes, as they stand at its end."""
    path = new_path(s, "outcomes")
    outcome = F.when(F.col("doc_id") % 5 == 0, "Failed:Permanent").otherwise("Succeeded")
    rows = table(s, d, "documents").select(F.col("lang").alias("date_folder"), outcome.alias("outcome"), F.col("n_chars").alias("length"))
    rows.repartition(4).write.parquet(f"{path}/in")
    stream = s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    ingest.publish(ingest.live_progress(stream), f"{path}/out", f"{path}/state").awaitTermination()
    return ingest.published(s, f"{path}/out")


@query(ARRIVED_SQL.replace("SELECT lang", "SELECT CASE WHEN doc_id % 2 = 0 THEN 'completed' ELSE 'late' END AS event, lang") + " GROUP BY 1, 2")
def folder_completion(s, d):
    """Folders that stay quiet become complete while the stream runs; what arrives later is late, in the same run and after a restart."""
    root, out = new_path(s, "arrivals"), new_path(s, "events")
    halves = {r["k"]: r["n"] for r in table(s, d, "documents").groupBy((F.col("doc_id") % 4).alias("k")).agg(F.count("*").alias("n")).collect()}
    parts = table(s, d, "documents").withColumn("k", F.col("doc_id") % 4)

    def arrive(*k):
        rows = parts.where(F.col("k").isin(*k))
        text = F.concat(F.coalesce("text", F.lit("")), F.lit("\n"))
        files.write_files(rows.select(F.concat_ws("/", "lang", F.concat(F.lit("n"), F.col("doc_id").cast("string"))).alias("rel"), F.encode(text, "UTF-8").alias("content")), root)

    start = lambda: ingest.write_events(ingest.folder_events(ingest.ingest_incremental(s, root, 1_000_000), 4_000), out, f"{out}-state")
    arrive(0, 2)
    run = start()
    ingest.wait_for(s, run, out, "completed", halves.get(0, 0) + halves.get(2, 0))
    arrive(1)
    ingest.wait_for(s, run, out, "late", halves.get(1, 0))
    run.stop()
    run = start()
    arrive(3)
    ingest.wait_for(s, run, out, "late", halves.get(1, 0) + halves.get(3, 0))
    run.stop()
    return s.read.parquet(out).groupBy("event", "date_folder").agg(F.sum("documents").alias("documents"), F.sum("bytes").alias("bytes"))


@query("""WITH r AS (SELECT lang AS date_folder, doc_id % 5 AS k, epoch_us(TIMESTAMP '2026-08-01') + doc_id * 1000000 AS a FROM documents), g AS (SELECT CASE WHEN grouping(date_folder) = 1 THEN 'TOTAL' ELSE date_folder END AS date_folder, count(*) + 100 * count(DISTINCT date_folder) AS found,
  count(*) FILTER (k > 1) AS ok, count(*) FILTER (k = 0) AS bad, count(*) FILTER (k = 1) AS gone, (max(a) + 2000000 - min(a)) / 1000000.0::DOUBLE AS sec FROM r GROUP BY ROLLUP (date_folder))
  SELECT date_folder, found, ok + bad AS processed, ok AS succeeded, bad AS failed, gone AS abandoned, round((ok + bad) / sec, 9) AS files_per_s, found - ok - bad AS remaining, round((found - ok - bad) / ((ok + bad) / sec), 6) AS eta_s FROM g""")
def live_rates(s, d):
    """Rate, remaining documents and ETA of folders and of the run, as they stand at the end of a stream over outcomes whose totals grow."""
    path = new_path(s, "outcomes")
    k, start = F.col("doc_id") % 5, F.timestamp_micros(F.unix_micros(F.lit("2026-08-01 00:00:00").cast("timestamp")) + F.col("doc_id") * 1_000_000)
    outcome = F.when(k == 0, "Failed:Permanent").when(k == 1, "Fatal").otherwise("Succeeded")
    rows = table(s, d, "documents").select(F.col("lang").alias("date_folder"), outcome.alias("outcome"), F.col("n_chars").alias("length"), start.alias("start_utc"))
    rows = rows.withColumn("end_utc", F.timestamp_micros(F.unix_micros("start_utc") + 2_000_000))
    rows.repartition(3).write.parquet(f"{path}/in")
    stream = s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    found = iter((10, 50, *[100] * 1000))  # documents that are found beyond those that are converted, at the end of each batch

    def totals():
        more = next(found)
        return rows.groupBy("date_folder").agg((F.count("*") + more).alias("found"))

    ingest.publish(ingest.live_progress(stream), f"{path}/out", f"{path}/state", totals).awaitTermination()
    got = ingest.published_rates(s, f"{path}/out")
    return got.withColumns({"files_per_s": F.round("files_per_s", 9), "eta_s": F.round("eta_s", 6)})


@query("SELECT lang AS date_folder, count(*) AS documents FROM documents GROUP BY 1")
def archive_source(s, d):
    """Files of finished batches move to an archive; with what is left in the folder they are all (S3)."""
    root, out, moved = new_path(s, "arrivals"), new_path(s, "ingested"), new_path(s, "archived")
    for part in (0, 1):
        arriving(s, d, root, part)
        ingest.resume(ingest.ingest_incremental(s, root, 200, archive=moved), lambda b: b.select("path"), out, f"{out}-state").awaitTermination()
    # what is left is listed first and held
    files.list_files(s, root).select("rel").write.parquet(f"{out}-left")
    left = s.read.parquet(f"{out}-left")
    gone = files.list_files(s, moved).select(F.regexp_extract("rel", "(arrivals-[^/]*)/(.*)$", 2).alias("rel"))
    both = split_path(left.unionByName(gone).distinct().withColumnRenamed("rel", "rel_path"))
    return both.groupBy(F.substring_index("sub_folder", "/", 1).alias("date_folder")).agg(F.count("*").alias("documents"))


# --- whole runs ------------------------------------------------------------------------------------------------------

RUN_SQL = """WITH t AS (SELECT page_id, 'd' || page_id % 4 AS date_folder, CASE WHEN page_id % 3 = 0 THEN 'p' || page_id % 5 ELSE '' END AS sub_folder, 'n' || page_id || CASE WHEN page_id % 10 = 7 THEN '.pdf' ELSE '.xhtml' END AS file_name,
  CASE WHEN page_id % 10 = 7 THEN 'odd' WHEN page_id % 11 = 4 THEN 'empty' WHEN page_id % 7 = 3 THEN 'raw' WHEN page_id % 13 = 6 THEN 'plain' ELSE 'ok' END AS kind FROM pages)"""
RUN_REASON_SQL = "CASE kind WHEN 'odd' THEN 'File name does not match *.xhtml' WHEN 'plain' THEN 'The file holds no XHTML document' ELSE 'The file is not a decodable Base64 envelope' END"


def envelope_tree(s, d) -> str:
    """Pages as enveloped files with planted faults: names that fit no pattern, empty files, raw markup, texts without markup."""
    i = F.col("page_id")
    n = i.cast("string")
    line = lambda c: decode.base64_line(F.encode(c, "UTF-8")).cast("binary")
    content = F.when(i % 11 == 4, F.lit(b"")).when(i % 7 == 3, F.encode(F.concat(F.lit("<"), F.coalesce("html", F.lit(""))), "UTF-8")).when(i % 13 == 6, line(F.concat(F.lit("no markup "), n)))
    content = content.otherwise(line(F.concat(F.lit("<p>"), n, F.lit("</p>"), F.coalesce("html", F.lit("")))))
    folder, sub = F.concat(F.lit("d"), (i % 4).cast("string")), F.when(i % 3 == 0, F.concat(F.lit("p"), (i % 5).cast("string")))
    name = F.concat(F.lit("n"), n, F.when(i % 10 == 7, ".pdf").otherwise(".xhtml"))
    root = new_path(s, "envelopes")
    files.write_files(table(s, d, "pages").select(F.concat_ws("/", folder, sub, name).alias("rel"), content.alias("content")), root)
    return root


@query(RUN_SQL + """, c AS (SELECT count(*) AS n, count(*) FILTER (kind = 'ok') AS ok, count(*) FILTER (kind <> 'odd') AS worked FROM t)
  SELECT unnest(['found', 'succeeded', 'failed', 'abandoned', 'outputs', 'archived', 'in error', 'logs', 'left', 'error report', 'trace', 'completed folders', 'reported found', 'reported failed', 'first rows']) AS name,
  unnest([n, ok, n - ok, 0, ok, ok, n - ok, n - ok, 0, n - ok, worked, (SELECT count(DISTINCT date_folder) FROM t), n, n - ok, n - ok]) AS n FROM c""")
def run_folder(s, d):
    """One run from an input folder to outputs, moves, reports and checkpoint; each report against the others."""
    from ..operators.run import RunOptions
    from ..operators.run import run_folder as run_all

    root, out = envelope_tree(s, d), new_path(s, "run")
    run = run_all(s, root, out, RunOptions(batch=25, error_logs=0, part_rows=20))
    at = f"{out}/reports/{run.run_id}"
    there = kept(files.list_files(s, root).select("rel"), "there")
    in_error = there.where("rel like '%/error/%'")
    errors = reports.read_error_report(s, f"{at}/errors").select(F.col("row").cast("long").alias("row"))
    lines = reports.read_summary_header(reports.report_lines(s, f"{at}/migration_report.csv")).where("name in ('Total Files Found', 'Total Files Failed')")
    counts = {
        "outputs": files.list_files(s, f"{out}/rtf"), "archived": there.where("rel like '%/archive/%'"), "in error": in_error.where("rel not like '%.log'"), "logs": in_error.where("rel like '%.log'"),
        "left": there.where("rel not like '%/archive/%' and rel not like '%/error/%'"), "error report": errors, "trace": reports.read_trace(s, f"{at}/trace"), "completed folders": s.read.parquet(f"{out}/checkpoint/completed_folders"),
    }
    rows = s.createDataFrame([(k, getattr(run, k)) for k in ("found", "succeeded", "failed", "abandoned")], "name string, n long")
    for name, df in counts.items():
        rows = rows.unionByName(df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n"))
    said = lines.select(F.when(F.col("name") == "Total Files Found", "reported found").otherwise("reported failed").alias("name"), F.col("value").cast("long").alias("n"))
    last = errors.agg(F.coalesce(F.max("row"), F.lit(0)).alias("n")).select(F.lit("first rows").alias("name"), "n")  # rows are numbered through all parts
    return rows.unionByName(said).unionByName(last)


@query(RUN_SQL + f""", b AS (SELECT *, (row_number() OVER (PARTITION BY date_folder ORDER BY CASE WHEN sub_folder = '' THEN file_name ELSE sub_folder || '/' || file_name END) - 1) // 25 + 1 AS b FROM t WHERE kind <> 'odd')
  SELECT date_folder, sub_folder, file_name, date_folder || '#' || printf('%04d', b) AS batch_id, CASE kind WHEN 'ok' THEN 'Succeeded' ELSE 'Failed:Permanent' END AS outcome, CASE WHEN kind <> 'ok' THEN {RUN_REASON_SQL} END AS reason, 1::BIGINT AS attempts,
  true AS known, true AS in_order, true AS phases_fit, kind = 'ok' AS measured, true AS columns FROM b""")
def traced_conversion(s, d):
    """A measured trace of a real conversion: each document with its worker, times and phases, whose sum is within its duration (F9, B4, convert)."""
    from ..operators.traced import PHASE_NAMES, Limits, convert_traced

    docs = files.list_documents(s, envelope_tree(s, d)).where("file_name not like '%.pdf'")
    trace = convert_traced(batches.assign_batches(docs, 25), Limits())
    spent = sum((F.col(f"{p}_ms") for p in PHASE_NAMES), F.lit(0.0))
    row = reports.trace_report(trace)
    whole = F.lit(row.columns == reports.TRACE_COLUMNS)
    return trace.select(
        "date_folder", "sub_folder", "file_name", "batch_id", "outcome", "reason", "attempts", ((F.col("worker_slot") > 0) & (F.col("thread_id") > 0)).alias("known"), (F.col("end_utc") >= F.col("start_utc")).alias("in_order"),
        (spent <= F.col("duration_ms") + 1e-6).alias("phases_fit"), (F.least(*[F.col(f"{p}_ms") for p in ("read", "decode", "validate", "import", "export", "write")]) > 0).alias("measured"), whole.alias("columns"),
    )


@query("""SELECT page_id, page_id % 3 = 0 AS was_there, CASE WHEN page_id % 3 = 0 THEN 'Failed:Transient' ELSE 'Succeeded' END AS outcome, CASE WHEN page_id % 3 = 0 THEN 4 ELSE 1 END::BIGINT AS attempts,
  CASE WHEN page_id % 3 = 0 THEN 'The file is locked or the volume is unavailable' END AS reason, CASE WHEN page_id % 3 = 0 THEN 'old' ELSE 'new' END AS holds FROM pages""")
def refused_outputs(s, d):
    """With overwriting off, outputs that are there are refused: transient failures after all attempts, and the files stay as they were (B1)."""
    from ..operators.traced import Limits, convert_traced, refuse_existing
    from ..sources.corpus import documents_table

    out = new_path(s, "refused")
    n = F.col("page_id").cast("string")
    docs = documents_table(table(s, d, "pages"), F.concat(F.lit("<p>"), n, F.lit("</p>")), F.lit("d"), F.lit(""), F.concat(F.lit("N"), n, F.lit(".xhtml")))
    old = table(s, d, "pages").where("page_id % 3 = 0").select(F.concat(F.lit("d/N"), n, F.lit(".rtf")).alias("rel"), F.lit(b"old").alias("content"))
    files.write_files(old, out)
    there = files.list_files(s, out).select(F.col("rel").alias("output"))
    done = convert_traced(refuse_existing(docs, there), Limits(attempts=4, out=out))
    held = files.read_envelopes(files.list_files(s, out)).select(F.regexp_extract("rel", "N([0-9]+)", 1).cast("long").alias("page_id"), F.when(F.col("content") == F.lit(b"old"), "old").otherwise("new").alias("holds"))
    rows = done.select(F.regexp_extract("file_name", "N([0-9]+)", 1).cast("long").alias("page_id"), F.col("refused").alias("was_there"), "outcome", "attempts", "reason")
    return rows.join(held, "page_id")


# --- trees of files compared, and listings over time -----------------------------------------------------------------


def text_tree(s, d, name: str, rows: DataFrame) -> str:
    """A tree of files from (rel, text); a null text is no file."""
    root = new_path(s, name)
    files.write_files(rows.where("text is not null").select("rel", F.encode("text", "UTF-8").alias("content")), root, fresh=True)
    return root


@query("""SELECT 'd' || doc_id % 8 || '/s/n' || doc_id AS rel_path, CASE WHEN doc_id % 8 <> 2 OR doc_id % 16 <> 10 THEN sha256('<' || coalesce(text, '')) END AS left_hash,
  CASE WHEN doc_id % 8 = 5 AND doc_id % 3 = 0 THEN sha256('<' || coalesce(text, '') || '!') WHEN doc_id % 8 = 7 AND doc_id % 5 = 0 THEN NULL ELSE sha256('<' || coalesce(text, '')) END AS right_hash
  FROM documents WHERE (doc_id % 8 = 2 AND doc_id % 16 = 10) OR (doc_id % 8 = 5 AND doc_id % 3 = 0) OR (doc_id % 8 = 7 AND doc_id % 5 = 0)""")
def tree_file_diff(s, d):
    """Two written trees: files that lack on either side or differ; equal folders are not opened (H2)."""
    i = F.col("doc_id")
    rows = table(s, d, "documents").select("doc_id", F.concat(F.lit("d"), (i % 8).cast("string"), F.lit("/s/n"), i.cast("string")).alias("rel"), F.concat(F.lit("<"), F.coalesce("text", F.lit(""))).alias("text"))
    left = text_tree(s, d, "left", rows.withColumn("text", F.when((i % 8 == 2) & (i % 16 == 10), None).otherwise(F.col("text"))))
    other = F.when((i % 8 == 5) & (i % 3 == 0), F.concat("text", F.lit("!"))).when((i % 8 == 7) & (i % 5 == 0), None).otherwise(F.col("text"))
    right = text_tree(s, d, "right", rows.withColumn("text", other))
    return verify.tree_diff_folders(files.tree_digests(s, left), files.tree_digests(s, right))


@query("""WITH l AS (SELECT doc_id, lang, 2 AS n FROM documents), a AS (SELECT 1 AS run, lang AS date_folder, count(*) FILTER (doc_id % 3 <> 0) AS files, count(*) FILTER (doc_id % 3 <> 0) AS arrived, 0 AS gone, 0 AS changed FROM l GROUP BY ALL
  UNION ALL SELECT 2, lang, count(*) FILTER (doc_id % 4 <> 1), count(*) FILTER (doc_id % 3 = 0 AND doc_id % 4 <> 1), count(*) FILTER (doc_id % 3 <> 0 AND doc_id % 4 = 1), 0 FROM l GROUP BY ALL
  UNION ALL SELECT 3, lang, count(*) FILTER (doc_id % 4 <> 1), 0, 0, count(*) FILTER (doc_id % 4 = 2) FROM l GROUP BY ALL) SELECT run, date_folder, files, arrived, gone, changed FROM a""")
def manifest_snapshots(s, d):
    """Three scans of a changing tree: each run's listing, read from the log, and what arrived, went and changed (H7, A5)."""
    i = F.col("doc_id")
    rows = table(s, d, "documents").select("doc_id", F.concat_ws("/", "lang", i.cast("string")).alias("rel"), F.lit("x").alias("text"))
    log = new_path(s, "manifests")
    states = {1: F.when(i % 3 != 0, "x"), 2: F.when(i % 4 != 1, "x"), 3: F.when(i % 4 == 2, "xyz").when(i % 4 != 1, "x")}
    for run, text in states.items():
        listing = files.list_files(s, text_tree(s, d, f"scan{run}", rows.withColumn("text", text)))
        files.save_manifest(listing.select(F.col("rel").alias("rel_path"), "length", F.lit("2026-08-01").cast("timestamp").alias("mtime")), log, run)
    folder = F.substring_index("rel_path", "/", 1).alias("date_folder")
    held = None
    for run in states:
        part = files.manifest_at(s, log, run).groupBy(folder).agg(F.count("*").alias("files")).withColumn("run", F.lit(run))
        held = part if held is None else held.unionByName(part)
    kinds = [F.count_if(F.col("change") == c).alias(c) for c in ("arrived", "gone", "changed")]
    changes = files.manifest_changes_of(s, log).groupBy("run", folder).agg(*kinds)
    return held.join(changes, ["run", "date_folder"], "left").fillna(0, ["arrived", "gone", "changed"]).select("run", "date_folder", "files", "arrived", "gone", "changed")


@query("""WITH r AS (SELECT c_nationkey % 4 AS sweep, o_custkey % 7 AS k, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL), u AS (SELECT sweep, k AS run, CASE WHEN k = 6 THEN 1 ELSE k + 1 END AS threads, k AS started,
  10 + CASE sweep WHEN 0 THEN 0 WHEN 1 THEN 10 * CASE WHEN k = 6 THEN 0 ELSE k END WHEN 2 THEN 2 * CASE WHEN k = 6 THEN 0 ELSE k END ELSE CASE WHEN k = 6 THEN 5 ELSE 0 END END + n * 0.0 AS service_ms FROM r),
  b AS (SELECT sweep, max(service_ms) FILTER (run = 0) AS base, regr_slope(service_ms, threads) AS s, max(service_ms) FILTER (run = 6) AS c FROM u GROUP BY 1)
  SELECT sweep, round(s / base, 9) AS slope, round(c / base, 9) AS control_ratio, CASE WHEN abs(c / base - 1) > 0.15 THEN 'not reproducible' WHEN s / base <= 0.05 THEN 'flat' WHEN s / base >= 0.5 THEN 'rising' ELSE 'unclear' END AS verdict FROM b""")
def scaling_verdict(s, d):
    """Sweeps of threads that are flat, rising, unclear, and not reproducible."""
    both = table(s, d, "orders").join(table(s, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    rows = both.groupBy((F.col("c_nationkey") % 4).alias("sweep"), (F.col("o_custkey") % 7).alias("run")).agg(F.count("*").alias("n"))
    k = F.col("run")
    step = F.when(k == 6, 0).otherwise(k)
    ms = F.when(F.col("sweep") == 0, 0).when(F.col("sweep") == 1, 10 * step).when(F.col("sweep") == 2, 2 * step).otherwise(F.when(k == 6, 5).otherwise(0))
    rows = rows.select("sweep", "run", F.when(k == 6, 1).otherwise(k + 1).alias("threads"), k.alias("started"), (10 + ms + F.col("n") * 0.0).alias("service_ms"))
    return verify.scaling_verdict(rows).withColumns({"slope": F.round("slope", 9), "control_ratio": F.round("control_ratio", 9)})
