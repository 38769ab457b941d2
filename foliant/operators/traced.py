"""The conversion with a trace: each document timed phase by phase, limited and retried, in one stage.

``convert.convert_files`` is the way to convert columns; here each document is a unit of its own, as reports want it: its worker, start,
duration, attempts, and what each phase took. The result is not the same when it is computed again, so ``convert_traced`` writes
it once, and all reports are made of what is written.
"""

from __future__ import annotations

import os
import socket
import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import document
from ..functions.markup_tree import CleanUp
from ..functions.paths import output_path_of
from ..functions.rtf import to_rtf
from ..shared import kept, spread
from ..sources.files import BATCH_BYTES, FileReader, put_file
from .metrics import PHASES
from .outcomes import IO_TYPES, TRANSIENT_TYPES, classify_error, describe_reason, outcome_of

PHASE_NAMES = [p for p, _ in PHASES]


@dataclass(frozen=True)
class Limits:
    """What a conversion may take, and how it writes.

    ``attempts`` in total for a document, ``delay_ms`` times the number of the attempt before the next; ``timeout_s`` for one attempt, 0 for no limit. With ``out``, outputs are
    files below that folder; without, the text stays in the column ``rtf``. ``base64`` puts outputs in envelopes.
    """

    attempts: int = 3
    delay_ms: int = 0
    timeout_s: float = 60.0
    out: str | None = None
    base64: bool = False
    cleanup: CleanUp = field(default_factory=CleanUp)


ADDED = T.StructType(
    [
        *(T.StructField(n, T.StringType()) for n in ("worker", "rtf", "output", "error_type", "error_message")),
        *(T.StructField(n, T.LongType()) for n in ("thread_id", "task", "start_us", "duration_ns", "hresult", "attempts", "bytes_in", "bytes_out", *(f"{p}_ns" for p in PHASE_NAMES))),
    ]
)


class Lap:
    """Nanoseconds by phase, on a clock that never goes back."""

    def __init__(self) -> None:
        self.spent, self.mark = dict.fromkeys(PHASE_NAMES, 0), time.perf_counter_ns()

    def end(self, phase: str) -> None:
        now = time.perf_counter_ns()
        self.spent[phase] += now - self.mark
        self.mark = now


def _attempt(row: dict, read: Callable[[str], bytes | None], fn: Callable[[str], str], limits: Limits) -> tuple[str | None, int, int, Lap]:
    """(rtf, bytes in, bytes out, phases) of one attempt."""
    lap = Lap()
    if row.get("refused"):
        raise document.DocumentError("IOException", document.EXISTS)
    content = row["content"] if "content" in row else read(row["path"])
    if content is None and "content" not in row:
        raise document.DocumentError("FileNotFoundException", document.GONE)
    lap.end("read")
    text = document.text_of(document.payload_of(content))
    lap.end("decode")
    document.validate(text)
    lap.end("validate")
    with document.limited(limits.timeout_s):
        text = document.clean(text, limits.cleanup)
        lap.end("import")
        rtf = fn(text)
        lap.end("export")
    data = rtf.encode("ascii")
    if limits.base64:
        data = document.base64_line(data)
    if limits.out:
        put_file(limits.out, row["output_rel"], data)
    lap.end("write")
    return (None if limits.out else data.decode("ascii")), len(content or b""), len(data), lap


def _retries(e: document.DocumentError) -> bool:
    """Whether a failure may pass: transient, and neither a licence nor a full disk."""
    return e.kind in TRANSIENT_TYPES and "license" not in e.message.lower() and not (e.kind in IO_TYPES and e.hresult)


def _converted(row: dict, read, fn, limits: Limits) -> dict:
    """What ``ADDED`` says of one document; no error leaves it."""
    out = dict.fromkeys(ADDED.fieldNames())
    began, out["start_us"] = time.perf_counter_ns(), time.time_ns() // 1000
    out |= {"hresult": 0, "attempts": 0, "bytes_in": 0, "bytes_out": 0} | {f"{p}_ns": 0 for p in PHASE_NAMES}
    while out["attempts"] < max(1, limits.attempts):
        out["attempts"] += 1
        try:
            rtf, out["bytes_in"], out["bytes_out"], lap = _attempt(row, read, fn, limits)
            out |= {"rtf": rtf, "output": row["output_rel"], "error_type": None, "error_message": None, "hresult": 0} | {f"{p}_ns": n for p, n in lap.spent.items()}
            break
        except (Exception, document.Overtime) as e:  # one bad document must not fail the others
            failed = document.described(e)
            out |= {"error_type": failed.kind, "error_message": failed.message, "hresult": failed.hresult}
            if not _retries(failed):
                break
            if limits.delay_ms and out["attempts"] < limits.attempts:
                time.sleep(limits.delay_ms * out["attempts"] / 1000)
    out["duration_ns"] = time.perf_counter_ns() - began
    return out


def refuse_existing(documents: DataFrame, outputs: DataFrame) -> DataFrame:
    """Adds ``refused``: whether a document's output is among ``outputs`` (output, below the output root), ignoring case.

    What is there counts as it was listed before the run, so a task that is repeated doesn't refuse what it has written itself.
    """
    there = outputs.select(F.lower("output").alias("_there")).distinct().withColumn("refused", F.lit(True))
    own = F.lower(output_path_of(F.col("date_folder"), F.col("sub_folder"), F.col("stem")))
    rows = documents.drop("refused").withColumn("_own", own)
    return rows.join(there, F.col("_own") == F.col("_there"), "left").drop("_own", "_there").withColumn("refused", F.coalesce("refused", F.lit(False)))


def convert_traced(documents: DataFrame, limits: Limits | None = None, fn: Callable[[str], str] = to_rtf) -> DataFrame:
    """Documents (date_folder, sub_folder, stem, and path or content; batch_id, refused as there are) with rtf, outcome, error and trace.

    Adds worker_slot, thread_id, task, start_utc, end_utc, duration_ms, attempts, seven phases in ms, bytes_in, bytes_out, rtf or the
    file ``output``, error (type, message), category, reason and outcome. Phases are of the attempt that succeeded and 0 for others, and sum up to the duration
    at most. A worker is a Python process, which holds one document at a time; ``worker_slot`` numbers them from 1. Content isn't kept. ``fn`` makes
    RTF of a text in the worker. A document that failed has no output; one that takes too long fails alone, with TimeoutException.
    """
    limits = limits or Limits()
    rows = documents.drop(*ADDED.fieldNames()).withColumn("output_rel", output_path_of(F.col("date_folder"), F.col("sub_folder"), F.col("stem")))
    rows = spread(rows, "path") if "path" in rows.columns and "content" not in rows.columns else rows  # content isn't shuffled
    names, plain = rows.columns, [c for c in rows.columns if c not in ("content", "output_rel")]
    need = [c for c in ("path", "content", "refused", "output_rel") if c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, who, task = FileReader(), f"{socket.gethostname()}:{os.getpid()}", TaskContext.get()
        own = {"worker": who, "thread_id": threading.get_native_id(), "task": task.taskAttemptId() if task else 0}
        for b in batches:
            first, done, size = 0, [], 0
            for i in range(b.num_rows):
                row = {c: b.column(c)[i].as_py() for c in need}
                done.append(_converted(row, read, fn, limits) | own)
                size += done[-1]["bytes_out"] if not limits.out else 0
                if size > BATCH_BYTES or i == b.num_rows - 1:
                    part = b.slice(first, len(done))
                    added = [pa.array([d[f.name] for d in done], pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in ADDED.fields]
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in plain), *added], [*plain, *ADDED.fieldNames()])
                    first, done, size = i + 1, [], 0

    schema = T.StructType([*(f for f in rows.schema.fields if f.name in plain), *ADDED.fields])
    return _judged(kept(rows.mapInArrow(run, schema), "traced"), plain)


def _judged(rows: DataFrame, plain: list[str]) -> DataFrame:
    slots = rows.select("worker").distinct().withColumn("worker_slot", F.row_number().over(W.orderBy("worker")))  # a row for each worker process
    rows = rows.join(F.broadcast(slots), "worker")
    kind = F.when(F.col("error_type").isNotNull(), classify_error(F.col("error_type"), F.array("error_message"), F.col("hresult")))
    rows = rows.withColumn("category", kind)
    ms = lambda c: (F.col(c) / 1e6).alias(c[:-2] + "ms")
    start = F.timestamp_micros("start_us")
    return rows.select(
        *plain, "worker_slot", "thread_id", "task", start.alias("start_utc"), F.timestamp_micros(F.col("start_us") + F.ceil(F.col("duration_ns") / 1000).cast("long")).alias("end_utc"), ms("duration_ns"), "attempts",
        *[ms(f"{p}_ns") for p in PHASE_NAMES], "bytes_in", "bytes_out", "rtf", "output", F.when(F.col("error_type").isNotNull(), F.struct(F.col("error_type").alias("type"), F.col("error_message").alias("message"))).alias("error"),
        "category", F.when(F.col("error_type").isNotNull(), describe_reason(F.col("error_type"), F.col("category"))).alias("reason"), outcome_of(F.col("category")).alias("outcome"),
    )
