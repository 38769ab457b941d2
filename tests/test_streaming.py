"""Streams: rates at each batch's end against a batch recomputation, folders that complete, and trees and listings over time."""

import datetime as dt
import os
import random
import time

import pytest
from pyarrow import fs as files_at
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from foliant import shared
from foliant.operators import verify
from foliant.sources import files
from foliant.streaming import ingest

AT = dt.datetime(2026, 8, 1)


def test_rates_at_each_batch_end(spark, tmp_path):
    rnd = random.Random(5)
    parts = [[(rnd.choice("abc"), rnd.choice(["Succeeded", "Failed:Permanent", "Fatal"]), 3, AT + dt.timedelta(seconds=10 * k + i), AT + dt.timedelta(seconds=10 * k + i + 2)) for i in range(9)] for k in range(3)]
    schema = "date_folder string, outcome string, length long, start_utc timestamp, end_utc timestamp"
    found = iter(({"a": 9, "d": 1}, {"a": 12, "b": 30, "d": 2}, {"a": 12, "b": 30, "c": 1, "d": 3}))
    seen = []

    def totals():
        seen.append(next(found))
        return spark.createDataFrame(list(seen[-1].items()), "date_folder string, found int")

    out, source = str(tmp_path / "out"), str(tmp_path / "in")
    for k, rows in enumerate(parts):  # a later run goes on with the totals so far
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        ingest.publish(ingest.live_progress(stream), out, str(tmp_path / "state"), totals).awaitTermination()
    for k in range(3):
        rows = [r for part in parts[: k + 1] for r in part]
        got = {r.date_folder: r for r in ingest.published_rates(spark, out, k).collect()}
        for folder in {r[0] for r in rows} | set(seen[k]) | {"TOTAL"}:
            own = [r for r in rows if folder in (r[0], "TOTAL")]
            done = sum(r[1] != "Fatal" for r in own)
            seconds = (max(r[4] for r in own) - min(r[3] for r in own)).total_seconds() if own else 0
            total = sum(seen[k].values()) if folder == "TOTAL" else seen[k].get(folder, 0)
            rate, left = (done / seconds if seconds else 0.0), max(0, total - done)
            want = (total, done, len(own) - done, rate, left, 0.0 if not left else left / rate if rate else None)
            r = got[folder]
            assert (r.found, r.processed, r.abandoned, r.files_per_s, r.remaining, r.eta_s) == want
        assert set(got) == {r[0] for r in rows} | set(seen[k]) | {"TOTAL"}
    assert {r.date_folder: r.found for r in ingest.published_rates(spark, out).collect()} == {r.date_folder: r.found for r in ingest.published_rates(spark, out, 2).collect()}


def test_files_of_folders_that_are_complete_from_the_start(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    (root / "old").mkdir(parents=True)
    (root / "old" / "f1").write_text("xx")
    done = spark.createDataFrame([("old",), ("old",)], "date_folder string")
    events = ingest.folder_events(ingest.ingest_incremental(spark, str(root), 10), 600_000, done)
    run = ingest.write_events(events, out, str(tmp_path / "state"))
    try:
        assert ingest.wait_for(spark, run, out, "late", 1)
    finally:
        run.stop()
    got = spark.read.parquet(out).collect()
    assert [(r.date_folder, r.event, r.documents, r.bytes) for r in got] == [("old", "late", 1, 2)] and got[0].path.endswith("/old/f1")
    assert not ingest.wait_for(spark, run, out, "completed", 1)  # it has ended


def test_batches_stay_few_however_many_files_wait(spark, tmp_path):
    root, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    (root / "d").mkdir(parents=True)
    for i in range(90):
        (root / "d" / f"n{i}").write_text("x")
    stream = ingest.ingest_incremental(spark, str(root), 1)
    ingest.resume(stream, lambda b: b.select("date_folder", "path", "length"), out, state).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.select("path").distinct().count() == rows.count() == 90
    assert 1 < rows.select("batch").distinct().count() <= ingest.MOST_BATCHES


def test_waiting_outlasts_a_long_batch(spark, tmp_path):
    out, began = str(tmp_path / "out"), time.time()

    class Query:
        """A query whose one batch takes three seconds and writes its event at the end."""

        isActive = True

        @property
        def status(self):
            busy = time.time() < began + 3
            if not busy and not (tmp_path / "out").exists():
                spark.createDataFrame([("d", "late", "p", 2, 3, 0)], ingest.EVENTS).write.parquet(f"{out}/batch=0")
            return {"isTriggerActive": busy, "isDataAvailable": busy}

    assert ingest.wait_for(spark, Query(), out, "late", 2, seconds=1)
    assert not ingest.wait_for(spark, Query(), out, "late", 3, seconds=1)  # nothing more comes


def test_files_that_are_being_written_are_hidden(tmp_path, monkeypatch):
    seen = []

    class Store(files_at.LocalFileSystem):
        def open_output_stream(self, path):
            seen.append(path.rsplit("/", 1)[1])
            return super().open_output_stream(path)

    monkeypatch.setattr(files, "_opened", lambda root: (Store(), root))
    files.put_file(str(tmp_path), "d/n1", b"x")
    assert seen[0].startswith(".") and [p.name for p in (tmp_path / "d").iterdir()] == ["n1"]


def test_new_trees_change_a_folder_once_a_file(tmp_path, monkeypatch):
    seen = []

    class Store(files_at.LocalFileSystem):
        def open_output_stream(self, path):
            seen.append(("open", path.rsplit("/", 1)[1]))
            return super().open_output_stream(path)

        def create_dir(self, path, recursive=True):
            seen.append(("folder", path.rsplit("/", 1)[1]))
            super().create_dir(path, recursive=recursive)

        def move(self, src, dest):
            seen.append(("move", dest))
            super().move(src, dest)

    monkeypatch.setattr(files, "_opened", lambda root: (Store(), root))
    write = files.FileWriter(str(tmp_path / "tree"), fresh=True)
    for rel in ("d/s/n1", "d/s/n2", "n3", "d/s/n1"):
        write(rel, rel.encode())
    assert seen == [("open", "n1"), ("folder", "s"), ("open", "n1"), ("open", "n2"), ("open", "n3"), ("open", "n1")]
    assert {str(p.relative_to(tmp_path / "tree")): p.read_text() for p in (tmp_path / "tree").rglob("*") if p.is_file()} == {r: r for r in ("d/s/n1", "d/s/n2", "n3")}


def test_listing_opens_each_folder_once(spark, tmp_path):
    for rel in ("top", "a/x", "a/b/y", "a/b/c/d/z", "e/.h"):
        (tmp_path / rel).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / rel).write_text(rel)
    (tmp_path / "e/none").mkdir()
    found = files.list_entries(spark, str(tmp_path))
    assert sorted((r.rel, r.is_folder, r.length) for r in found.collect()) == sorted([(r, True, 0) for r in ("a", "a/b", "a/b/c", "a/b/c/d", "e", "e/none")] + [(r, False, len(r)) for r in ("top", "a/x", "a/b/y", "a/b/c/d/z", "e/.h")])
    assert all(r.mtime for r in found.collect()) and files.list_entries(spark, str(tmp_path / "missing")).count() == 0
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 3  # a level each


def test_equal_folders_are_not_compared_further(spark, tmp_path):
    rnd = random.Random(7)
    left = {f"d{i % 6}/{'s/' if i % 4 else ''}n{i}": f"h{i}" for i in range(60)} | {"top": "t"}
    right = dict(left) | {"d1/s/n1": "other", "d9/new": "x"}
    del right["d3/s/n3"]
    frame = lambda d: spark.createDataFrame(rnd.sample(list(d.items()), len(d)), "rel_path string, sha256 string")
    got = {(r.rel_path, r.left_hash, r.right_hash) for r in verify.tree_diff_folders(frame(left), frame(right)).collect()}
    assert got == {("d1/s/n1", "h1", "other"), ("d9/new", None, "x"), ("d3/s/n3", "h3", None)}
    opened = []
    diff = verify.tree_diff
    try:
        verify.tree_diff = lambda a, b: opened.extend((a, b)) or diff(a, b)
        verify.tree_diff_folders(frame(left), frame(right)).count()
    finally:
        verify.tree_diff = diff
    assert {r.rel_path.split("/")[0] for df in opened for r in df.collect()} == {"d1", "d3", "d9"}
    same = verify.folder_digests(frame(left)).exceptAll(verify.folder_digests(frame(left)))
    assert same.count() == 0 and verify.tree_diff_folders(frame(left), frame(left)).count() == 0
    digests = {r.folder: r for r in verify.folder_digests(frame(left)).collect()}
    assert digests[""].files == 61 and digests["d1/s"].files == sum(k.startswith("d1/s/") for k in left) and len({r.digest for r in digests.values()}) > 6


def test_digests_in_pieces_and_listings_that_go_on(spark, tmp_path):
    import hashlib

    root = str(tmp_path / "tree")
    files.write_files(spark.createDataFrame([("a/big", bytearray(b"x" * 5000)), ("a/empty", bytearray())], "rel string, content binary"), root)
    got = {r.rel_path: r.sha256 for r in files.tree_digests(spark, root, piece=7).collect()}
    assert got == {"a/big": hashlib.sha256(b"x" * 5000).hexdigest(), "a/empty": hashlib.sha256(b"").hexdigest()}
    log = str(tmp_path / "log")
    listing = lambda *rows: spark.createDataFrame([(p, n, AT) for p, n in rows], "rel_path string, length long, mtime timestamp")
    files.save_manifest(listing(("a", 1), ("b", 2)), log, 1)
    files.save_manifest(listing(("b", 3)), log, 2)
    files.save_manifest(listing(("b", 3)), log, 2)  # repeated
    files.save_manifest(listing(("a", 9), ("b", 3)), log, 3)
    held = lambda run: {(r.rel_path, r.length) for r in files.manifest_at(spark, log, run).collect()}
    assert [held(k) for k in (1, 2, 3)] == [{("a", 1), ("b", 2)}, {("b", 3)}, {("a", 9), ("b", 3)}]
    changes = {(r.run, r.rel_path, r.change) for r in files.manifest_changes_of(spark, log).collect()}
    assert changes == {(1, "a", "arrived"), (1, "b", "arrived"), (2, "a", "gone"), (2, "b", "changed"), (3, "a", "arrived")}


def test_verdicts_of_odd_sweeps(spark):
    rows = [("one", 1, 1, 10.0, 1), ("none", 1, 1, None, 1), ("zero", 1, 1, 0.0, 1), ("zero", 2, 2, 5.0, 2), ("same", 1, 2, 10.0, 1), ("same", 2, 2, 30.0, 2), ("down", 1, 1, 10.0, 1), ("down", 2, 3, 6.0, 2)]
    got = {r.sweep: (r.slope and round(r.slope, 6), r.control_ratio, r.verdict) for r in verify.scaling_verdict(spark.createDataFrame(rows, "sweep string, run int, threads int, service_ms double, started int")).collect()}
    assert got == {"one": (None, None, "unclear"), "none": (None, None, "unclear"), "zero": (None, None, "unclear"), "same": (None, 3.0, "not reproducible"), "down": (-0.2, None, "flat")}
    assert verify.scaling_verdict(spark.createDataFrame(rows, "sweep string, run int, threads int, service_ms double, started int").where(F.lit(False))).count() == 0


def known_to_the_driver(state, *names):
    """Which names are in what the source and the engine log of a checkpoint."""
    texts = [p.read_text() for part in ("sources", "offsets", "commits") for p in (state / part).rglob("*") if p.is_file() and not p.name.endswith(".crc")]
    assert texts
    return [n for n in names if any(n in t for t in texts)]


def test_folders_complete_once_over_several_batches_without_names_at_the_driver(spark, tmp_path):
    root, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    for i in range(12):  # times go to and fro between the folders; the batches must not, or a folder that is quiet for one would be complete too soon
        file = root / ("a" if i // 2 % 2 else "b") / f"name{i:02}"
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("xx")
        os.utime(file, (1_785_000_000 + i, 1_785_000_000 + i))
    run = ingest.write_events(ingest.folder_events(ingest.ingest_incremental(spark, str(root), 2), 1), out, str(state))
    try:
        assert ingest.wait_for(spark, run, out, "completed", 12)
        (root / "b/name99").write_text("yyy")  # found by the running query
        assert ingest.wait_for(spark, run, out, "late", 1)
    finally:
        run.stop()
    got = sorted((r.date_folder, r.event, r.documents, r.bytes) for r in spark.read.parquet(out).collect())
    assert got == [("a", "completed", 6, 12), ("b", "completed", 6, 12), ("b", "late", 1, 3)]
    assert not known_to_the_driver(state, "name")


def test_waiting_ends_while_looks_bring_nothing(spark, tmp_path):
    (tmp_path / "in/d").mkdir(parents=True)
    (tmp_path / "in/d/n").write_text("x")
    out = str(tmp_path / "out")
    run = ingest.write_events(ingest.folder_events(ingest.ingest_incremental(spark, str(tmp_path / "in"), 10), 600_000), out, str(tmp_path / "state"))
    try:
        assert not ingest.wait_for(spark, run, out, "late", 1, seconds=3) and run.isActive
    finally:
        run.stop()


def test_resume_after_a_failure_without_names_at_the_driver(spark, tmp_path, monkeypatch):
    root, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    for rel in ("d 1/name%20a", "d 1/s/name b", "d 1/x=_name", "e/_k=v/namec", "named", "e/namee", "e/.name", "e/_name", "_e/name", "e/s/.s/name", "e/name._COPYING_", "e/nameempty"):
        (root / rel).parent.mkdir(parents=True, exist_ok=True)
        (root / rel).write_text("" if "empty" in rel else f"<{rel}>")
    parts, new_path = [], ingest.new_path
    monkeypatch.setattr(ingest, "new_path", lambda s, name: parts.append(new_path(s, name)) or parts[-1])
    calls = []

    def transform(batch):
        calls.append(batch)
        if len(calls) == 2:
            raise ValueError("the second batch fails")
        return batch.selectExpr("date_folder", "path", "length", "string(content) as text")

    run = lambda: ingest.resume(ingest.ingest_incremental(spark, str(root), 2), transform, out, str(state)).awaitTermination()
    with pytest.raises(StreamingQueryException):
        run()
    shared.delete(spark, parts[0])  # another application's, which has cleared its tables
    run()
    (root / "e/nameempty").write_text("now")
    (root / "e/namee").write_text("another text")
    run()
    rows = [(r.date_folder, r.path, r.length, r.text) for r in spark.read.parquet(out).collect()]
    kept = {"d 1/name%20a": "d 1", "d 1/s/name b": "d 1", "d 1/x=_name": "d 1", "e/_k=v/namec": "e", "named": "", "e/namee": "e"}
    want = [(folder, f"file:{root}/{rel}", len(rel) + 2, f"<{rel}>") for rel, folder in kept.items()] + [("e", f"file:{root}/e/nameempty", 3, "now")]
    assert sorted(rows) == sorted(want)
    assert not known_to_the_driver(state, "name")
    with pytest.raises(FileNotFoundError):
        ingest.ingest_incremental(spark, str(tmp_path / "missing"))


def test_archive_takes_files_of_finished_batches_only(spark, tmp_path):
    root, out, state, archive = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state", tmp_path / "old"
    (root / "d/s").mkdir(parents=True)
    names = [f"{'s/' if i % 2 else ''}name{i}" for i in range(6)]
    for name in names:
        (root / "d" / name).write_text(name)
    moved = lambda: {str(p.relative_to(f"{archive}{root}/d")) for p in archive.rglob("*") if p.is_file()}
    left = lambda: {str(p.relative_to(root / "d")) for p in root.rglob("*") if p.is_file()}
    seen = []

    def transform(batch):
        seen.append(left())
        if len(seen) == 3:
            raise ValueError("the third batch fails")
        if len(seen) == 1:
            (root / "d/name8").write_text("name8")  # after the batch's paths are on record, so it belongs to a later run
        return batch.selectExpr("string(content) as text")

    run = lambda: ingest.resume(ingest.ingest_incremental(spark, str(root), 2, str(archive)), transform, out, str(state)).awaitTermination()
    with pytest.raises(StreamingQueryException):
        run()
    assert seen[0] == set(names) and [len(s) for s in seen] == [6, 5, 3]  # each batch begins when the one before it is finished and has moved
    assert len(moved()) == 4 and len(left()) == 3
    run()
    assert moved() == {*names, "name8"} and not left()
    (root / "d/name9").write_text("name9")
    run()
    assert moved() == {*names, "name8", "name9"} and not left()
    assert sorted(r.text for r in spark.read.parquet(out).collect()) == sorted([*names, "name8", "name9"])
    assert not known_to_the_driver(state, "name")
    with pytest.raises(ValueError):
        ingest.ingest_incremental(spark, str(root), archive=str(root / "d/old"))


def test_late_files_without_names_at_the_driver(spark, tmp_path):
    root, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    done = spark.createDataFrame([("OLD",)], "date_folder string")
    for k in range(2):
        for folder in ("old", "new"):
            (root / folder).mkdir(parents=True, exist_ok=True)
            for i in range(2):
                (root / folder / f"name{k}{i}").write_text("x" * (k + 1))
        stream = ingest.late_files(ingest.ingest_incremental(spark, str(root), 3), done)
        ingest.resume(stream, lambda b: b.select("date_folder", "path", "length"), out, str(state)).awaitTermination()
    got = sorted((r.date_folder, r.path.rsplit("/", 1)[1], r.length) for r in spark.read.parquet(out).collect())
    assert got == [("old", "name00", 1), ("old", "name01", 1), ("old", "name10", 2), ("old", "name11", 2)]
    assert not known_to_the_driver(state, "name")
