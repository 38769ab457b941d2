import csv
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from foliant.functions import decode
from foliant.functions.paths import glob_regex, split_path
from foliant.operators import batches, convert, metrics, outcomes, verify
from foliant.shared import own_dir
from foliant.sources import corpus, files, reports
from foliant.streaming import ingest


def test_decode_envelopes(spark):
    import base64

    enc = lambda b: base64.b64encode(b)
    cases = [
        (b"", None, decode.EMPTY_FILE),
        (b"  ", None, decode.EMPTY_PAYLOAD),
        (b"<html>", None, decode.NOT_BASE64),
        (enc(b"<p>abc")[:-1], None, decode.NOT_BASE64),
        (b"\xe9" + enc(b"<p>"), None, decode.NOT_BASE64),
        (b"\xef\xbb\xbf" + enc(b"<p>x"), "<p>x", None),
        (enc(b"<p>a") + b"\r\n", "<p>a", None),
        (enc(b"\xef\xbb\xbf<p>b"), "<p>b", None),
        (enc("﻿<p>é".encode("utf-16-le")), "<p>é", None),
        (enc("﻿<p>é".encode("utf-32-be")), "<p>é", None),
        (enc('<?xml version="1.0" encoding="windows-1252"?>Café €'.encode("cp1252")), '<?xml version="1.0" encoding="windows-1252"?>Café €', None),
        (enc('<meta charset="iso-8859-1">Café'.encode("latin-1")), '<meta charset="iso-8859-1">Café', None),
        (enc("Café".encode("cp1252")), "Café", None),
        (enc(b"\x81<p>\xe9"), "\x81<p>é", None),
        (enc('<?xml encoding="no-such"?><meta charset="latin1">é'.encode()), '<?xml encoding="no-such"?><meta charset="latin1">é', None),
        (enc(b'<meta charset="utf-8">\xff'), None, decode.NOT_UTF8),
        (enc(b"\xef\xbb\xbf<p>\xff"), "<p>�", None),
    ]
    df = spark.createDataFrame([(i, bytearray(c[0])) for i, c in enumerate(cases)], "i int, content binary")
    for r in decode.read_documents(df).collect():
        _, text, message = cases[r.i]
        assert r.text == text, r.i
        assert (r.error and r.error.message) == message, r.i
        assert r.input_bytes == len(cases[r.i][0])


def test_paths(spark):
    import re

    assert re.match(glob_regex("*.xhtml"), "a.xhtml") and not re.match(glob_regex("*.xhtml"), "a.xhtml.bak")
    df = split_path(spark.createDataFrame([("a/b/c.d.e",), ("x",), (".h",)], "rel_path string"))
    got = {r.rel_path: (r.sub_folder, r.file_name, r.stem, r.ext) for r in df.collect()}
    assert got == {"a/b/c.d.e": ("a/b", "c.d.e", "c.d", ".e"), "x": ("", "x", "x", ""), ".h": ("", ".h", "", ".h")}


def test_collisions_never_repeat_a_name(spark):
    moves = spark.createDataFrame([("/a/doc_1.xhtml", f"p{i}") for i in range(5)] + [("/a/DOC_1_2.xhtml", "q"), ("/a/new.txt", "r")], "destination string, path string")
    taken = spark.createDataFrame([("/a/DOC_1.XHTML",), ("/a/doc_1_1.xhtml",)], "destination string")
    names = [r.final for r in outcomes.resolve_collisions(moves, taken).collect()]
    low = [n.lower() for n in names]
    assert len(set(low)) == 7 and not {"/a/doc_1.xhtml", "/a/doc_1_1.xhtml"} & set(low)
    assert "/a/new.txt" in names and "/a/DOC_1_2.xhtml" in names and "/a/doc_1_3.xhtml" in names


def test_numbering_is_dense_and_the_same_at_any_partitioning(spark):
    rows = [(f"f{i % 3}", f"r{i:05d}") for i in range(3000)]
    want = None
    for n in (1, 3, 8):
        df = spark.createDataFrame(rows, "date_folder string, rel_path string").repartition(n)
        got = sorted((r.rel_path, r.batch_id) for r in batches.assign_batches(df, 100).collect())
        want = want or got
        assert got == want
    assert len({b for _, b in want}) == 30
    numbers = sorted(r.row for r in batches.number_rows(df, ["rel_path"]).collect())
    assert numbers == list(range(1, 3001))


def test_numbering_of_hot_groups_and_nulls(spark):
    rows = [("big" if i % 3 else None if i % 2 else f"s{i}", i % 7, i) for i in range(4000)]
    got = batches.number_rows(spark.createDataFrame(rows, "g string, a int, b int").repartition(7), ["a", "b"], within="g").collect()
    want = {}
    for g, a, b in sorted(rows, key=lambda r: r[1:]):
        want[b] = want.get(("n", g), 0) + 1
        want["n", g] = want[b]
    assert {r.b: r.row for r in got} == {k: v for k, v in want.items() if not isinstance(k, tuple)}
    assert batches.number_rows(spark.createDataFrame([], "g string, a int"), ["a"], within="g").count() == 0


def test_numbering_costs_no_more_at_more_partitions(spark):
    import time

    df = spark.range(100_000).select(F.concat(F.lit("r"), F.xxhash64("id").cast("string")).alias("k"))

    def seconds(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        began = time.time()
        assert batches.number_rows(df, ["k"]).agg(F.max("row")).first()[0] == 100_000
        return time.time() - began

    try:
        seconds(4)
        few, many = seconds(4), seconds(1000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert many < 2 * few + 10  # the range shuffle itself opens 1000 partitions


def test_workers_and_overhead_with_abandoned_documents(spark):
    """A worker's rate is of its busy time; documents that were abandoned have a service time, but aren't processed."""
    when = dt.datetime(2026, 8, 1)
    names = ("read", "decode", "validate", "import", "export", "write", "archive")
    rows = [(1, o, when, when + dt.timedelta(seconds=10), 1000.0, *[200.0] * 7) for o in ("Succeeded", "Succeeded", "Fatal", "Cancelled")]
    trace = spark.createDataFrame(rows, "worker_slot int, outcome string, start_utc timestamp, end_utc timestamp, duration_ms double, " + ", ".join(f"{n}_ms double" for n in names))
    assert metrics.worker_breakdown(trace).first().files_per_s == 1.0
    assert "Overhead" not in {r.kind for r in metrics.cpu_disk_split(trace).collect()}  # 2 x 1000 ms of 2 x 1400 measured
    split = metrics.cpu_disk_split(trace.withColumn("duration_ms", F.lit(1700.0)))
    assert {r.kind: round(r.total_s, 6) for r in split.collect()} == {"CPU": 1.6, "Disk": 1.2, "Overhead": 0.6}


def test_barrier_goes_by_number(spark):
    at = lambda x: dt.datetime(2026, 8, 1) + dt.timedelta(seconds=x)
    trace = spark.createDataFrame([("f", f"f#{n:04d}", at(i), at(i + 1)) for i, n in enumerate(range(9995, 10005))], "date_folder string, batch_id string, start_utc timestamp, end_utc timestamp")
    assert batches.batch_barrier_check(trace).where("not holds").count() == 0


def test_attempts(spark):
    log = [("a", 1, "IOException", "Transient"), ("a", 2, "IOException", "Transient"), ("a", 3, None, None), ("b", 1, "IOException", "Transient"), ("b", 2, "IOException", "Transient")]
    log += [("b", 3, "IOException", "Transient"), ("b", 4, None, None), ("c", 1, "XmlException", "Permanent"), ("c", 2, None, None), ("d", 1, "SecurityException", "Fatal")]
    got = {r.k: (r.attempts, r.retries, r.backoff_ms, r.outcome) for r in outcomes.resolve_attempts(spark.createDataFrame(log, "k string, attempt int, error_type string, category string"), "k").collect()}
    assert got == {"a": (3, 2, 1500, "Succeeded"), "b": (3, 2, 1500, "Failed:Transient"), "c": (1, 0, 0, "Failed:Permanent"), "d": (1, 0, 0, "Fatal")}


def test_cancelled_attempts(spark):
    """A cancellation is Cancelled only where the run was cancelled; else it is transient. Neither Fatal nor Cancelled is failed."""
    log = [("a", 1, "TaskCanceledException", "Transient", True), ("a", 2, None, None, False), ("b", 1, "OperationCanceledException", "Transient", False), ("b", 2, "OperationCanceledException", "Transient", None), ("c", 1, "IOException", "Transient", True), ("c", 2, None, None, False)]
    got = {r.k: (r.attempts, r.outcome) for r in outcomes.resolve_attempts(spark.createDataFrame(log, "k string, attempt int, error_type string, category string, cancelled boolean"), "k", most=2).collect()}
    assert got == {"a": (1, "Cancelled"), "b": (2, "Failed:Transient"), "c": (2, "Succeeded")}
    when = dt.datetime(2026, 8, 1)
    rows = [("w", "f", "b", o, when, when + dt.timedelta(seconds=1), 1, 10, 1000.0) for o in ("Succeeded", "Failed:Permanent", "Failed:Transient", "Fatal", "Cancelled", "Cancelled")]
    trace = spark.createDataFrame(rows, "worker_slot string, date_folder string, batch_id string, outcome string, start_utc timestamp, end_utc timestamp, attempts int, bytes_in long, duration_ms double")
    folder, worker, totals = metrics.folder_breakdown(trace).first(), metrics.worker_breakdown(trace).first(), metrics.run_totals(trace, 6).first()
    assert (folder.total, folder.succeeded, folder.failed) == (6, 1, 2) and (worker.processed, worker.succeeded, worker.failed, worker.abandoned) == (6, 1, 2, 3)
    assert (totals.processed, totals.failed, totals.remaining, totals.bytes_in) == (3, 2, 3, 10)
    assert outcomes.error_rates_by_batch(trace).first().errors == 2
    moved = outcomes.plan_disposition(trace.select("outcome", F.lit("/in").alias("folder_path"), F.lit("").alias("sub_folder"), F.lit("n").alias("file_name")))
    assert moved.where("outcome in ('Fatal', 'Cancelled') and destination is not null").count() == 0


def test_progress_of_runs_apart(spark):
    at = lambda x: dt.datetime(2026, 8, 1) + dt.timedelta(seconds=x)
    rows = [("r1", "b1", "Succeeded", at(0), at(2)), ("r1", "b2", "Failed:Permanent", at(2), at(4)), ("r2", "b1", "Fatal", at(1), at(3)), ("r2", "b2", "Succeeded", at(3), at(6))]
    trace = spark.createDataFrame(rows, "run_id string, batch_id string, outcome string, start_utc timestamp, end_utc timestamp")
    got = {(r.run_id, r.batch_id): (r.done, r.succeeded, r.failed, r.files_per_s) for r in batches.batch_progress(trace, "run_id").collect()}
    assert got == {("r1", "b1"): (1, 1, 0, 0.5), ("r1", "b2"): (2, 1, 1, 0.5), ("r2", "b1"): (0, 0, 0, 0.0), ("r2", "b2"): (1, 1, 0, 0.2)}
    assert batches.batch_progress(trace.where("run_id = 'r1'")).count() == 2


def test_collisions_against_a_walk(spark):
    """Names given one after the other, as many as collide, against the joins."""
    import random

    rnd = random.Random(6)
    for _ in range(3):
        taken = {rnd.choice(["/a/d.x", "/a/D_1.x", "/a/d_3.x", "/a/d_4.x", "/a/e_2.x", "/a/e.x"]).lower() for _ in range(4)}
        new = [(rnd.choice(["/a/d.x", "/a/D.X", "/a/e.x", "/a/d_3.x", "/a/f"]), f"p{i:02d}") for i in range(20)]
        own = {n.lower() for n, _ in new}
        want, used = [], set(taken)
        for n, _ in sorted(new, key=lambda r: r[1]):
            stem, ext = (n.rsplit(".", 1)[0], "." + n.rsplit(".", 1)[1]) if "." in n else (n, "")
            k, out = 0, n
            while out.lower() in used or k and out.lower() in own:
                k += 1
                out = f"{stem}_{k}{ext}"
            used.add(out.lower())
            want.append(out)
        got = outcomes.resolve_collisions(spark.createDataFrame(new, "destination string, path string"), spark.createDataFrame([(t,) for t in taken], "destination string"))
        assert [r.final for r in got.orderBy("path").collect()] == want


def test_times(spark):
    from foliant.functions import times

    df = spark.createDataFrame([(90_061_999,), (0,), (None,)], "ms long")
    assert [r[0] for r in df.select(times.hms(F.col("ms"))).collect()] == ["01:01:01", "00:00:00", None]
    r = spark.sql("select timestamp'2026-08-01 02:03:04' t").select(times.run_stamp(F.col("t")).alias("a"), times.iso_utc(F.col("t")).alias("b")).first()
    assert (r.a, r.b) == ("20260801_020304", "2026-08-01T02:03:04Z")


def test_peak_concurrency_matches_a_sweep(spark):
    import random

    random.seed(3)
    spans = [(s := random.randint(0, 10_000), s + random.randint(1, 2000)) for _ in range(300)]
    events = sorted((t, d) for a, b in spans for t, d in ((a, 1), (b, -1)))
    now = best = 0
    for _, d in events:
        now += d
        best = max(best, now)
    df = spark.createDataFrame(spans, "start_us long, end_us long")
    for bucket in (7, 1000, 10**9):
        assert metrics.peak_concurrency(df, bucket_us=bucket).first().peak == best
    assert metrics.peak_concurrency(df.where("false")).first().peak == 0


def test_throughput_without_time_or_files(spark):
    df = spark.createDataFrame([(0, 0, 0, 0, 0.0, 0.0, 0), (0, 0, 0, 0, 1.0, 0.0, 5)], "processed long, succeeded long, bytes_in long, bytes_out long, elapsed_s double, service_ms double, remaining long")
    a, b = metrics.throughput(df).collect()
    assert a.eta_s == 0 and a.files_per_s == 0 and b.eta_s is None


def _failures(spark, n):
    when = dt.datetime(2026, 8, 1, 12)
    rows = [
        (when + dt.timedelta(seconds=i), "f#0001", "f", "", f"d{i}.xhtml", f"d{i}.xhtml", 10, "Conversion", "Permanent", "why", 1, None, "Yes", "/e", f"/in/{i:03d}", "XmlException", 'A "b", c\r\nd', None)
        for i in range(n)
    ]
    names = [reports.snake(c) for c in reports.ERROR_COLUMNS[1:]]
    types = dict(error_time_utc="timestamp", file_size_bytes="long", attempts="int")
    return spark.createDataFrame(rows, ", ".join(f"{n} {types.get(n, 'string')}" for n in names))


def test_error_report_round_trip(spark, tmp_path):
    path = str(tmp_path / "errors")
    assert reports.write_error_report(_failures(spark, 5).coalesce(1), path, rows=2)
    parts = sorted((tmp_path / "errors").glob("part=*/*.csv"))
    assert [p.parent.name for p in parts] == ["part=0001", "part=0002", "part=0003"] and all(p.read_text().startswith("Row,Error Time Utc,Batch Id") for p in parts)
    back = sorted(reports.read_error_report(spark, path).collect(), key=lambda r: int(r.row))
    assert [r.row for r in back] == list("12345")
    assert back[0].error_message == 'A "b", c\r\nd' and back[0].error_log_file == "(none)" and back[0].error_time_utc == "2026-08-01T12:00:00Z"
    assert not reports.write_error_report(_failures(spark, 1).where("false"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_error_log_text_has_a_bound(spark):
    f = reports.number_rows(_failures(spark, 4), ["input_file_path"])
    f = f.withColumnRenamed("error_category", "error_category")
    assert outcomes.error_log_text(f, 2).where("log_text is not null").count() == 2
    assert outcomes.error_log_text(f, 0).where("log_text is not null").count() == 4


def test_summary_is_read_back(spark, tmp_path):
    when = dt.datetime(2026, 8, 1)
    rows = [(i % 2 + 1, "d,1" if i < 3 else "d2", "b", f"n{i}", "Succeeded" if i else "Failed:Permanent", when, when + dt.timedelta(seconds=2), 2000.0, 1, 1024, 2048, *[100.0] * 7) for i in range(6)]
    phases = [f"{p}_ms" for p, _ in metrics.PHASES]
    trace = spark.createDataFrame(rows, "worker_slot int, date_folder string, batch_id string, file_name string, outcome string, start_utc timestamp, end_utc timestamp, duration_ms double, attempts int, bytes_in long, bytes_out long, " + ", ".join(f"{p} double" for p in phases))
    text = reports.summary_text(reports.summary_header(trace, {"Status": "DONE, all", "Threads": 6}), reports.summary_sections(trace))
    (tmp_path / "run_1.csv").write_text(text)
    assert '"d,1",3,2,1,00:00:02' in text and "1,3,2,1,0,00:00:06,300.0,2000.0,0.50" in text and "CPU total,CPU,2.0,57.1,400.000" in text and "Unattributed,Overhead,8.5," in text
    assert text.index("Per-Folder") < text.index("Per-Worker") < text.index("Phase Breakdown") < text.index("Read input") < text.index("Archive input") < text.index("Disk total")
    (tmp_path / "run_2.csv").write_text("Status,a,b\r\n\r\nStatus,no\r\n")
    lines = reports.report_lines(spark, str(tmp_path))
    head = {(r.report, r.name): r.value for r in reports.read_summary_header(lines).collect()}
    assert head[("run_1.csv", "Status")] == '"DONE, all"' and head[("run_1.csv", "Total Files Failed")] == "1" and head[("run_1.csv", "Peak Concurrent Workers")] == "6"
    assert head[("run_2.csv", "Status")] == "a,b" and ("run_1.csv", "Read input") not in head
    assert [(r.report, r.value) for r in reports.read_phase_section(lines, ["Read input"]).collect()] == [("run_1.csv", "100.000")]
    m = verify.thread_sweep_matrix(reports.read_summary_header(lines), ["Threads", "Status"])
    assert {r.report: r.Threads for r in m.collect()} == {"run_1.csv": "6", "run_2.csv": ""}
    assert reports.summary_sections(trace.where("false")).where("section <> '3'").count() == 0
    few = dict(reports.summary_header(trace, {"Threads": 6}, found=4))  # fewer than are processed
    assert (few["Total Files Found"], few["Total Files Processed"]) == ("4", "6")


def test_claims_and_checkpoint(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c/2026-01-01.done").write_text("instance=A machine=m\n")
    (tmp_path / "c/2026-01-02.claim").write_text("instance=B machine=m\n")
    got = sorted((r.date_folder, r.state, r.instance) for r in reports.read_claims(spark, str(tmp_path / "c")).collect())
    assert got == [("2026-01-01", "done", "A"), ("2026-01-02", "claim", "B")]
    (tmp_path / "k.json").write_text('{"LastFile": "x",\n "CompletedFolders": ["a", "b"]}')
    assert sorted(r.date_folder for r in reports.read_completed(spark, str(tmp_path / "k.json")).collect()) == ["a", "b"]
    (tmp_path / "bad.json").write_text("{nope")
    assert reports.read_completed(spark, str(tmp_path / "bad.json")).count() == 0
    assert reports.read_completed(spark, str(tmp_path / "missing.json")).count() == 0
    when = dt.datetime(2026, 8, 1)
    rows = [("r1", "d1", "a", "Succeeded", when), ("r1", "d1", "b", "Failed:Permanent", when), ("r1", "d2", "c", "Fatal", when)]
    trace = spark.createDataFrame(rows, "run_id string, date_folder string, file_name string, outcome string, end_utc timestamp")
    done = spark.createDataFrame([("r1", "d1", "i")], "run_id string, date_folder string, instance string")
    for _ in range(2):
        before = reports.last_checkpoints(spark, str(tmp_path / "t")) if (tmp_path / "t").exists() else None
        reports.save_checkpoint(reports.checkpoint_rows(trace, before), done, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t/checkpoints")).count() == 2 and spark.read.parquet(str(tmp_path / "t/completed_folders")).count() == 2
    last = reports.last_checkpoints(spark, str(tmp_path / "t")).first()
    assert (last.last_folder, last.last_file, last.total_succeeded, last.total_failed, last.total_processed) == ("d2", "c", 2, 2, 4)


def test_listing(spark, tmp_path):
    import base64

    for rel, data in {"d1/a.XHTML": b"x", "d1/p/archive/b.xhtml": b"y", "d1/archive/c.xhtml": b"z", "d1/_u.xhtml": b"", "d1/_v.xhtml": b"v", "d1/.h.xhtml": b"h", "ARCHIVE/q.xhtml": b"q", ".claims/x.done": b"c", "top.xhtml": b"t", "d2/n.pdf": b"p"}.items():
        p = tmp_path / "in" / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(base64.b64encode(data))
    (tmp_path / "in/d3").mkdir()
    root = str(tmp_path / "in")
    docs = files.list_documents(spark, root)
    got = sorted((r.date_folder, r.sub_folder, r.file_name) for r in docs.collect())
    assert got == [("d1", "", ".h.xhtml"), ("d1", "", "_u.xhtml"), ("d1", "", "_v.xhtml"), ("d1", "", "a.XHTML"), ("d1", "p/archive", "b.xhtml"), ("d2", "", "n.pdf")]
    assert [r.date_folder for r in files.list_date_folders(spark, root).collect()] == ["d1", "d2", "d3"]
    assert [r.date_folder for r in files.list_date_folders(spark, root, only="D2").collect()] == ["d2"]
    assert [(r.date_folder, r.rel_path) for r in files.list_documents(spark, f"file://{root}/d2").collect()] == [("d2", "n.pdf")]
    assert [r.rel for r in files.stranded_files(spark, root).collect()] == ["top.xhtml"]
    assert files.list_documents(spark, root, only="D2").count() == 1
    content = {r.file_name: bytes(r.content or b"") for r in files.read_envelopes(docs).collect()}
    assert base64.b64decode(content["_v.xhtml"]) == b"v" and base64.b64decode(content[".h.xhtml"]) == b"h"
    assert content["_u.xhtml"] == b"" and base64.b64decode(content["b.xhtml"]) == b"y"


def test_documents_of_two_writes_stay(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = lambda *own: spark.createDataFrame(list(own), "date_folder string, sub_folder string, stem string, rtf string, batch_id string")
    reports.write_documents(rows(("d1", "", "a", "1", "d1#0001")), path)
    reports.write_documents(rows(("d2", "p", "b", "1", "d2#0001"), ("d1", "", "c", "1", "d1#0002")), path)
    reports.write_documents(rows(("d1", "", "a", "2", "d1#0001")), path)
    refused = reports.write_documents(rows(("d1", "", "A", "3", "d1#0001"), ("d1", "", "e", "3", "d1#0001"), ("d3", "", "f", None, "d3#0001")), path, overwrite=False)
    assert [(r.file_name, r.outcome, r.attempts, r.reason) for r in refused.collect()] == [("A.rtf", "Failed:Transient", 3, "The file is locked or the volume is unavailable")]
    got = sorted((r.date_folder, r.sub_folder, r.file_name, r.rtf) for r in reports.read_documents_table(spark, path).collect())
    assert got == [("d1", "", "a.rtf", "2"), ("d1", "", "c.rtf", "1"), ("d1", "", "e.rtf", "3"), ("d2", "p", "b.rtf", "1")]


def test_whole_conversion_and_manifest(spark):
    good = "<p>Progress <b>note</b></p>"
    rows = spark.createDataFrame([(i, good if i else "no markup", f"d{i % 2}") for i in range(5)], "i int, t string, f string")
    docs = corpus.documents_table(rows, F.col("t"), F.col("f"), F.lit(""), F.format_string("n%d.xhtml", "i"))
    out = convert.convert_files(docs)
    assert out.where("outcome = 'Succeeded'").count() == 4
    bad = out.where("error is not null").first()
    assert bad.reason == "The file holds no XHTML document" and bad.rtf is None and "no markup" not in bad.error.message
    m = corpus.manifest_of(docs, batch=2)
    assert {r.batch_id for r in m.collect()} == {"d0#0001", "d0#0002", "d1#0001"}


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    src = tmp_path / "in/f1"
    src.mkdir(parents=True)
    for i in range(5):
        (src / f"a{i}").write_text("x")
    run = lambda: ingest.resume(ingest.ingest_incremental(spark, str(tmp_path / "in"), 2), lambda b: b.select("path", "date_folder"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    (src / "late").write_text("y")
    run()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 6 and got.select("batch").distinct().count() == 4
    done = spark.createDataFrame([("F1",)], "date_folder string")
    assert ingest.late_files(got.drop("batch"), done).count() == 6


def test_stream_progress(spark, tmp_path):
    spark.range(10).selectExpr("'f' as date_folder", "if(id < 7, 'Succeeded', 'Fatal') as outcome", "id as length").write.parquet(str(tmp_path / "t"))
    stream = spark.readStream.schema("date_folder string, outcome string, length long").parquet(str(tmp_path / "t"))
    q = ingest.live_progress(stream).writeStream.outputMode("update").format("memory").queryName("progress").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.outcome: r.documents for r in spark.table("progress").collect()} == {"Succeeded": 7, "Fatal": 3}


@pytest.mark.parametrize("free", [0, 10**12])
def test_capacity(spark, free):
    one = metrics.capacity_estimate(spark.createDataFrame([("a", 1, 1000)], "date_folder string, files long, bytes long"), free).first()
    assert one.needed_bytes == 1200 and one.short == (free == 0)


def test_kept_tables_go_at_the_end(spark):
    from foliant import shared

    path = shared.new_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert shared.exists(spark, path)
    shared.clear(spark)
    assert not shared.exists(spark, path)


def test_folders_of_instances(spark):
    rows = [("a", "f2"), ("a", "f1"), ("a", "f1"), ("b", "f1"), (None, "f3"), ("b", None), ("a", "f10")]
    got = {(r.instance, r.date_folder): (r.nth, r.first_taken) for r in verify.folders_of_instances(spark.createDataFrame([(*r, 1) for r in rows], "instance string, date_folder string, nth int")).collect()}
    assert got == {("a", "f1"): (1, True), ("a", "f10"): (2, True), ("a", "f2"): (3, True), ("b", None): (1, True), ("b", "f1"): (2, False), (None, "f3"): (1, True)}
    assert verify.folders_of_instances(spark.createDataFrame([], "instance string, date_folder string")).count() == 0


@pytest.mark.parametrize("distinct", [1000, 90, 1])
def test_trace_parts_take_one_shuffle(spark, tmp_path, distinct):
    """Parts are full and in order, whatever starts tie; nothing is written on the way unless most of them do."""
    rows = spark.range(1000).select(F.timestamp_micros(F.col("id") * 7919 % 1000 % distinct).alias("start_utc"), (F.col("id") % 3).alias("worker_slot"), F.lit("f").alias("date_folder"), F.lit("").alias("sub_folder"), F.format_string("n%04d", "id").alias("file_name"))
    rows = rows.withColumn("start_utc", F.when(F.col("file_name") != "n0500", F.col("start_utc")))
    before = set(glob.glob(f"{own_dir(spark)}/runs-*"))
    assert reports.write_trace(rows.repartition(5), str(tmp_path / "t"), 60)
    assert (set(glob.glob(f"{own_dir(spark)}/runs-*")) == before) == (distinct > 1)
    got = [[r for r in csv.reader(open(f))][1:] for p in sorted(os.listdir(tmp_path / "t")) if p.startswith("part=") for f in glob.glob(f"{tmp_path}/t/{p}/*.csv")]
    assert [len(p) for p in got] == [60] * 16 + [40]
    key = [(r[6], r[0], r[5]) for p in got for r in p]
    assert key == sorted(key) and len({k[2] for k in key}) == 1000 and key[0][2] == "n0500"
    assert not reports.write_trace(rows.where("false"), str(tmp_path / "none"), 60)
