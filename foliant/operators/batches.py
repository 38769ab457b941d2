"""Numbering of documents: batches within a folder, and rows across all parts of a report.

A window over a whole folder, or over everything, would put all of it on one task. So numbers are prefix sums over sorted
runs: rows are written once, sorted, each with its run (range partition) and its place in it, and what lies before a run is
one small row for each run, and for each group in it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import file_tasks, kept

#: Places in a run are the low bits of monotonically_increasing_id, runs the high ones.
PLACE_BITS = 33
#: Ranges of a task, and their number at most.
RANGES_A_TASK, MOST_RANGES = 16, 4096


def number_rows(df: DataFrame, order: list[str], within: str | None = None, out: str = "row") -> DataFrame:
    """Adds ``out``: 1, 2, ... by ``order``, for each value of ``within`` or over all rows.

    ``order`` should be unique (in each ``within``). The sorted runs are written, so numbers stay the same whatever is lost
    later. A value of ``within`` may span any number of runs. No rows give no rows; nulls come first, and null is a group like others.
    """
    keys = ([within] if within else []) + order
    runs = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    runs = kept(runs, "runs").withColumns({"_run": F.shiftright("_id", PLACE_BITS), "_at": F.col("_id").bitwiseAND((1 << PLACE_BITS) - 1)})
    group = ["_run"] + ([within] if within else [])
    starts = runs.groupBy(*group).agg(F.min("_at").alias("_first"), F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(_before(within)), F.lit(0))
    shift = starts.select(F.col("_run").alias("_of"), *([F.col(within).alias("_in")] if within else []), (before - F.col("_first") + 1).alias("_shift"))
    if within:
        joined = runs.join(shift, (F.col("_run") == F.col("_of")) & runs[within].eqNullSafe(F.col("_in")))
    else:
        joined = runs.join(F.broadcast(shift), F.col("_run") == F.col("_of"))  # a row for each run
    return joined.select(*df.columns, (F.col("_at") + F.col("_shift")).cast("long").alias(out))


def _before(within: str | None):
    """The runs before a run; a group has at most as many rows here as there are runs."""
    by = W.partitionBy(within).orderBy("_run") if within else W.orderBy("_run")
    return by.rowsBetween(W.unboundedPreceding, -1)


def count_up_to(values: list[int], c: Column) -> Column:
    """How many of the sorted ``values`` are at most c, by rows of about the square root of their number. The values are one literal, whatever their number."""
    if not values:
        return F.lit(0)
    rows = max(1, round(len(values) ** 0.5))
    table = [values[i : i + rows] for i in range(0, len(values), rows)]
    literal = lambda v, kind: F.from_json(F.lit(json.dumps(v)), kind)
    at = F.size(F.filter(literal([t[0] for t in table], "array<long>"), lambda x: x <= c))
    inside = F.size(F.filter(F.element_at(literal(table, "array<array<long>>"), F.greatest(at, F.lit(1))), lambda x: x <= c))
    return F.when(at == 0, F.lit(0)).otherwise((at - 1) * rows + inside)


def deal_parts(df: DataFrame, key: Column, order: list[Column], size: int) -> DataFrame | None:
    """Adds ``part`` (1, 2, ...) and ``_n``, the number of each row by ``order``: parts are of ``size`` rows, and each is in one task. None where too many rows share a key.

    ``key`` is a long that ``order`` starts with; further ties go by all columns. Rows are shuffled once and never written: they go by ranges of the key, of which
    a sample gives the bounds and a count over all rows says what lies before each. A range that holds the border of two tasks goes to both, and each keeps what is in its own parts.
    So ``df`` has to give the same rows whenever it is read. At most ``MOST_RANGES`` counts come to the driver.
    """
    columns, spark = df.columns, df.sparkSession
    total = df.count()
    parts = -(-total // size)
    tasks = min(file_tasks(spark), max(1, parts))
    m = min(RANGES_A_TASK * tasks, MOST_RANGES)
    keyed = df.withColumn("_key", F.coalesce(key, F.lit(-(2**63))))
    some = keyed.select("_key").sample(min(1.0, 50 * m / max(1, total)), 7)
    bounds = some.agg(F.percentile_approx("_key", [i / m for i in range(1, m)], 10 * m)).first()[0] or [] if m > 1 else []
    b = count_up_to(sorted(set(bounds)), F.col("_key")).cast("int")
    of = lambda row: row // size * tasks // parts  # noqa: E731  the task of a row's part
    places, base, before = [], {}, 0
    for r in sorted(keyed.groupBy(b.alias("b")).count().collect(), key=lambda r: r["b"]):
        first, last = of(before), of(before + r["count"] - 1)
        if last - first > 2:
            return None
        places.append((r["b"], first, last))
        for t in range(first, last + 1):
            base.setdefault(t, before)
        before += r["count"]
    places = F.broadcast(spark.createDataFrame(places, "_b int, _first int, _last int"))
    bases = F.broadcast(spark.createDataFrame(sorted(base.items()), "_t int, _base long"))
    # every range has its place; an inner join would find each row's range twice, to see that it isn't null
    dealt = keyed.withColumn("_b", b).join(places, "_b", "left").select(*columns, "_key", F.explode(F.sequence("_first", "_last")).alias("_t"))
    runs = dealt.repartitionById(tasks, F.col("_t")).sortWithinPartitions("_key", *order, *columns).withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << PLACE_BITS) - 1))
    numbered = runs.join(bases, "_t").withColumn("_n", F.col("_base") + F.col("_at") + 1)
    own = F.floor((F.col("_n") - 1) / size)
    mine = F.floor(own * tasks / parts) == F.col("_t")
    return numbered.where(mine).select(*columns, (own + 1).alias("part"), "_n")


def assign_batches(manifest: DataFrame, size: int = 1000, order: list[str] | None = None) -> DataFrame:
    """Adds batch_no and batch_id (``folder#0001``): chunks of ``size`` in each date folder, by relative path."""
    if size < 1:
        raise ValueError("a batch holds at least one document")
    rows = number_rows(manifest, order or ["rel_path"], within="date_folder", out="_pos")
    n = F.floor((F.col("_pos") - 1) / size) + 1
    return rows.withColumn("batch_no", n.cast("long")).withColumn("batch_id", F.format_string("%s#%04d", F.col("date_folder"), F.col("batch_no"))).drop("_pos")


def batch_count(documents: str, size: int):
    """Batches of a folder of so many documents; an empty folder has one."""
    return F.greatest(F.lit(1), F.ceil(F.col(documents) / size)).cast("long")


def batch_progress(trace: DataFrame, run: str | None = None) -> DataFrame:
    """([run,] batch_id, batch_end, done, succeeded, failed, files_per_s): running totals of each run after each batch, in the order of their ends.

    ``run`` is the column that tells runs apart; without it all batches are of one run. Done are documents that succeeded or failed;
    the rate is of them, since the run's first start. A run has a row for each batch, so its window is small.
    """
    keys = [run] if run else []
    ok, bad = F.count_if(F.col("outcome") == "Succeeded"), F.count_if(F.startswith("outcome", F.lit("Failed")))
    by = trace.groupBy(*keys, "batch_id").agg(F.min("start_utc").alias("batch_start"), F.max("end_utc").alias("batch_end"), ok.alias("ok"), bad.alias("bad"))
    part = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    so_far = part.orderBy("batch_end", "batch_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    ok, bad = F.sum("ok").over(so_far), F.sum("bad").over(so_far)
    seconds = (F.unix_micros("batch_end") - F.unix_micros(F.min("batch_start").over(part))) / 1e6
    return by.select(*keys, "batch_id", "batch_end", (ok + bad).alias("done"), ok.alias("succeeded"), bad.alias("failed"), F.coalesce(F.try_divide((ok + bad).cast("double"), seconds), F.lit(0.0)).alias("files_per_s"))


def batch_barrier_check(trace: DataFrame) -> DataFrame:
    """(date_folder, batch_id, holds): whether a batch starts only once the one before it, in its folder, has ended.

    Batches go by their number, the digits at the end of the id; ids without one come first, by text.
    """
    by = trace.groupBy("date_folder", "batch_id").agg(F.min("start_utc").alias("first"), F.max("end_utc").alias("last"))
    number = F.nullif(F.regexp_extract("batch_id", "([0-9]{1,18})$", 1), F.lit("")).cast("long")
    before = F.lag("last").over(W.partitionBy("date_folder").orderBy(number.asc_nulls_first(), "batch_id"))
    return by.select("date_folder", "batch_id", F.coalesce(F.col("first") >= before, F.lit(True)).alias("holds"))
