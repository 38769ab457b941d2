"""Shared helpers: where intermediate tables go, and how tables are read."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import delete, new_path

def keep(df: DataFrame, name: str, compression: str = "zstd", path: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage so that a lost executor costs no recomputation of what was kept. A result that is
    still lazy reads such tables, so they stay until whoever runs the job calls ``shared.clear``.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Kept tables that are deleted at the end of the ``with`` block. What is used later must be kept outside of it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.count = spark, new_path(spark, name), 0

    def keep(self, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
        self.count += 1
        return keep(df, name, compression, f"{self.path}/{self.count}-{name}")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        delete(self.spark, self.path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The letters that contracts fold to lower case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def text_of(c: Column | str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Parts of Spark's batches: what Python holds at a time stays small where rows are whole texts."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def release() -> None:
    """Give memory that this process no longer uses back to the system; what follows on the driver needs it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


_kept: dict = {}


def once(key, of, make):
    """``make()``, kept for the tasks that a worker process runs one after the other on the same object ``of``; one for each ``key``."""
    held = _kept.get(key)
    if held is None or held[0] is not of:
        held = _kept[key] = (of, make())
    return held[1]
