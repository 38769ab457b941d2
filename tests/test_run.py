"""Documents one at a time against the column expressions, limits and retries, and whole runs from folder to reports."""

import base64
import time

import pytest
from pyspark.sql import functions as F

from foliant.functions import decode, document, gate, markup_tree
from foliant.operators import run, traced
from foliant.shared import exists
from foliant.sources import files, reports

PAYLOADS = [
    b"<p>plain</p>", b"\xef\xbb\xbf<p>mark</p>\xff", "<p>Grüße</p>".encode("utf-16"), "<p>ü</p>".encode("utf-32"), b"\xfe\xff" + "<p>é</p>".encode("utf-16-be"),
    b'<?xml version="1.0" encoding="windows-1252"?><p>caf\xe9 \x80\x81</p>', b'<meta charset="iso-8859-1"><p>caf\xe9</p>', b"<p>caf\xe9 \x80\x9d</p>", b'<?xml encoding="no-such"?><meta charset="latin1"><p>\xc3\xa9</p>',
    b'<meta charset="utf-8"><p>\xff</p>', b'<meta charset="koi8-r"><p>\xd0\xd2</p>', b"", b" \t\n", "　 ".encode(), b"no markup, 2 < 3", b"<p>" + b"\x01" * 9 + b"x" * 200, b"\x00\x01" * 300 + b"<p>", b"< a >", b"<\x1c>",
]
ENVELOPES = [None, b"", b"PGE", b"PGE=", b"PGE+\n", b"\xef\xbb\xbfPHA+", "PHA+".encode("utf-16"), b"<html>", b"PH\xe9+", b"====", b"PA==PA==", b" \r\n", b"PHA-"] + [base64.b64encode(p) for p in PAYLOADS]


def test_steps_on_values_equal_the_expressions(spark):
    df = spark.createDataFrame([(i, None if c is None else bytearray(c)) for i, c in enumerate(ENVELOPES)], "i int, content binary")
    rows = decode.read_documents(df)
    rows = decode.staged(rows, error=F.coalesce("error", F.when(F.col("text").isNotNull(), gate.content_error(F.col("text")))))
    want = {r.i: (r.error and (r.error.type, r.error.message), r.text if not r.error else None) for r in rows.collect()}
    for i, c in enumerate(ENVELOPES):
        try:
            text, error = document.text_of(document.payload_of(c)), None
            document.validate(text)
        except document.DocumentError as e:
            text, error = None, (e.kind, e.message)
        assert (error, text) == want[i], ENVELOPES[i]


@pytest.mark.parametrize("options", [markup_tree.CleanUp(), markup_tree.CleanUp(styled="display:none"), markup_tree.CleanUp().only(anchors=True)])
def test_clean_up_on_values_equals_the_expressions(spark, options):
    texts = [
        '<html xmlns="x" lang="en"><script>a<b</script><p><a name="q"> </a>t</p></html>', '<html xmlns:o="y"><div style="display: NONE"><a id="r"></a>gone</div><ul><li>x</li></ul></html>', "<p><a name='s'/>u</p><ul><li>i</li></ul>",
        '<table><tr><td>&bull;</td><td></td><td>item</td></tr></table><html xmlns="z">', '<p style="text-decoration: line-through"><span style="text-decoration: underline">s</span></p>', "no markup",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in df.select("i", markup_tree.normalize(F.col("t"), options).alias("n")).collect():
        assert r.n.error is None and r.n.text == document.clean(texts[r.i], options)


def corpus(spark, n, folder="d"):
    rows = [(folder, "", f"n{i}", i, bytearray(base64.b64encode(f"<p>document {i}</p>".encode()))) for i in range(n)]
    return spark.createDataFrame(rows, "date_folder string, sub_folder string, stem string, i int, content binary")


def hangs_on_three():
    """A converter; made inside of a function, so that workers needn't import this file."""

    def convert(text):
        if "document 3<" in text:
            time.sleep(60)
        if "document 4<" in text:
            while True:  # a loop in Python, which no sleep interrupts
                pass
        return "{\\rtf1 ok}"

    return convert


def test_one_document_that_hangs_fails_alone(spark):
    began = time.time()
    got = {r.i: r for r in traced.convert_traced(corpus(spark, 12).repartition(3), traced.Limits(attempts=2, timeout_s=0.5), hangs_on_three()).collect()}
    assert time.time() - began < 50
    for i in (3, 4):
        r = got[i]
        assert (r.outcome, r.error.type, r.reason, r.attempts) == ("Failed:Transient", "TimeoutException", "Conversion exceeded ConversionTimeoutSeconds", 2)
        assert r.duration_ms >= 1000 and r.rtf is None and r.export_ms == 0
    assert all(got[i].outcome == "Succeeded" and got[i].rtf == "{\\rtf1 ok}" and got[i].attempts == 1 for i in got if i not in (3, 4))


def odd_errors():
    """A converter; made inside of a function, so that workers needn't import this file."""

    def convert(text):
        n = int(text.split("document ")[1].split("<")[0])
        if n == 1:
            raise ValueError(f"quotes {text}")
        if n == 2:
            raise OSError(28, "no space")
        if n == 3:
            raise PermissionError("no")
        if n == 4:
            raise MemoryError
        if n == 5:
            raise document.DocumentError("IOException", "the license is over")
        if n == 6:
            return "é"
        return "{\\rtf1 ok}"

    return convert


def test_errors_of_a_converter_are_classified_and_quote_nothing(spark):
    got = {r.i: r for r in traced.convert_traced(corpus(spark, 8), traced.Limits(attempts=3), odd_errors()).collect()}
    want = {0: ("Succeeded", None, 1), 1: ("Failed:Permanent", "ValueError", 1), 2: ("Fatal", "IOException", 1), 3: ("Fatal", "UnauthorizedAccessException", 1), 4: ("Failed:Transient", "OutOfMemoryException", 3), 5: ("Fatal", "IOException", 1), 6: ("Failed:Permanent", "UnicodeEncodeError", 1), 7: ("Succeeded", None, 1)}
    assert {i: (r.outcome, r.error and r.error.type, r.attempts) for i, r in got.items()} == want
    assert all("document" not in r.error.message or r.error.message == document.FAILED for r in got.values() if r.error)
    assert traced.convert_traced(corpus(spark, 3).where("false")).count() == 0


def test_workers_hold_one_document_at_a_time(spark):
    rows = traced.convert_traced(corpus(spark, 400).repartition(8))
    last: dict = {}
    for r in rows.orderBy("start_utc").collect():
        assert r.start_utc >= last.get(r.worker_slot, r.start_utc)
        last[r.worker_slot] = r.end_utc.replace(microsecond=max(0, r.end_utc.microsecond - 1000))  # two clocks: a start is of the wall, a duration isn't
    assert 1 <= len(last) <= 8 and sorted(last) == list(range(1, len(last) + 1))


def tree(spark, tmp_path, names):
    root = str(tmp_path / "in")
    good = base64.b64encode(b"<p>text</p>")
    files.write_files(spark.createDataFrame([(n, bytearray(good if c is None else c)) for n, c in names.items()], "rel string, content binary"), root)
    return root


def test_a_run_and_its_resumption(spark, tmp_path):
    root = tree(spark, tmp_path, {"a/x.xhtml": None, "a/p/y.xhtml": None, "a/z.pdf": b"1", "b/bad.xhtml": b"<", "b/error/bad.xhtml": b"taken"})
    out = str(tmp_path / "out")
    one = run.run_folder(spark, root, out)
    assert (one.found, one.succeeded, one.failed, one.abandoned) == (4, 2, 2, 0) and one.completed
    rows = {r.file_name: r for r in one.failures.collect()}
    assert (rows["z.pdf"].source, rows["z.pdf"].batch_id, rows["z.pdf"].attempts) == ("Discovery", "scan", 0)
    # a name that is taken isn't overwritten
    assert (rows["bad.xhtml"].actual_file_name, rows["bad.xhtml"].moved_to_error, rows["bad.xhtml"].error_log_file) == ("bad_1.xhtml", "Yes", "bad_1.error.log")
    held = {r.rel for r in files.list_files(spark, root).collect()}
    assert held == {"a/archive/x.xhtml", "a/archive/p/y.xhtml", "a/error/z.pdf", "a/error/z.error.log", "b/error/bad.xhtml", "b/error/bad_1.xhtml", "b/error/bad_1.error.log"}
    text = (tmp_path / "out" / "reports" / one.run_id / "migration_report.csv").read_text()
    assert "Total Files Found,4\n" in text and "Batch Size,1000\nTotal Files Found" in text and "Error Report Rows,2\nError Report Parts,1\n" in text and "\n\nCPU total" in text
    assert "a,3,2,1," in text and "b,1,0,1," in text
    files.write_files(spark.createDataFrame([("a/late.xhtml", bytearray(base64.b64encode(b"<p>l</p>"))), ("c/new.xhtml", bytearray(base64.b64encode(b"<p>n</p>")))], "rel string, content binary"), root)
    two = run.run_folder(spark, root, out, run.RunOptions(resume=True))
    assert (two.found, two.succeeded) == (1, 1) and {r.output for r in two.trace.collect()} == {"c/new.rtf"}
    # without archiving and overwriting, what is there is refused
    three = run.run_folder(spark, root, out, run.RunOptions(overwrite=False, archive=False, quarantine=False, limits=traced.Limits(attempts=2)))
    assert {(r.file_name, r.outcome, r.attempts) for r in three.trace.collect()} == {("late.xhtml", "Succeeded", 1)}
    four = run.run_folder(spark, root, out, run.RunOptions(overwrite=False, archive=False, quarantine=False, limits=traced.Limits(attempts=2)))
    assert {(r.file_name, r.outcome, r.attempts) for r in four.trace.collect()} == {("late.xhtml", "Failed:Transient", 2)}
    assert "a/late.xhtml" in {r.rel for r in files.list_files(spark, root).collect()}


def full_disk():
    """A converter; made inside of a function, so that workers needn't import this file."""

    def convert(text):
        raise OSError(28, "no space")

    return convert


def test_a_fatal_error_publishes_no_completion(spark, tmp_path):
    root = tree(spark, tmp_path, {"a/x.xhtml": None, "a/y.xhtml": b"<"})
    one = run.run_folder(spark, root, str(tmp_path / "out"), fn=full_disk())
    assert (one.found, one.succeeded, one.failed, one.abandoned) == (2, 0, 1, 1) and not one.completed
    assert not exists(spark, str(tmp_path / "out" / "checkpoint"))
    assert "a/x.xhtml" in {r.rel for r in files.list_files(spark, root).collect()}
    assert reports.read_trace(spark, f"{tmp_path}/out/reports/{one.run_id}/trace").where("outcome = 'Fatal'").count() == 1


def test_no_documents_and_clashing_outputs(spark, tmp_path):
    root = tree(spark, tmp_path, {"a/n.txt": b"1"})
    one = run.run_folder(spark, root, str(tmp_path / "out"), run.RunOptions(quarantine=False))
    assert (one.found, one.failed) == (0, 0) and one.completed
    root = tree(spark, tmp_path / "two", {"a/n.xhtml": None, "a/N.XHTML": None})
    with pytest.raises(ValueError, match="several documents"):
        run.run_folder(spark, root, str(tmp_path / "out"))


def test_work_on_files_is_dealt_over_tasks(spark, tmp_path):
    root = tree(spark, tmp_path, {f"a/n{i}.xhtml": None for i in range(60)})
    rows = traced.convert_traced(files.list_documents(spark, root).coalesce(1), traced.Limits(out=str(tmp_path / "out")))
    assert rows.where("outcome = 'Succeeded'").count() == 60 and rows.select("task").distinct().count() > 4
    moves = spark.createDataFrame([(f"{tmp_path}/none{i}", None) for i in range(60)], "path string, final string").coalesce(1)
    assert files.move_files(moves).select("_metadata.file_path").distinct().count() > 4


def test_moves_that_fail_are_told(spark, tmp_path):
    (tmp_path / "a").write_text("x")
    moves = spark.createDataFrame([(f"{tmp_path}/a", f"{tmp_path}/to/a"), (f"{tmp_path}/none", f"{tmp_path}/to/none"), (f"{tmp_path}/stays", None)], "path string, final string")
    got = {r.path.rsplit("/", 1)[1]: r.move_error for r in files.move_files(moves).collect()}
    assert got["a"] is None and got["stays"] is None and got["none"] and (tmp_path / "to" / "a").read_text() == "x"
    # repeated after a lost task: what has moved counts as moved
    assert files.move_files(moves.where("path like '%/a'")).first().move_error is None
