"""The folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where that is unset, a temporary folder, in local mode only: on a cluster each executor would write to its own disk."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="spark-foliant-")
    return _own_dirs[app]


def own_dir(spark: SparkSession) -> str:
    """The folder of this application's tables."""
    return f"{shared_dir(spark)}/foliant/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete all tables that this application has kept. For the end of a run: results that are still lazy read them."""
    delete(spark, own_dir(spark))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its store, as Spark's own sources show it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


#: Tasks for a core where each row is work on a file.
TASKS_A_CORE = 4


def file_tasks(spark: SparkSession) -> int:
    """Tasks that sort rows and write them to files: those of a shuffle, and enough for all cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_A_CORE * spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, *by: str, least: int = 0) -> DataFrame:
    """Dealt by the columns ``by`` over tasks for all cores, ``least`` at least. For rows that are paths, or make a file each: by their few bytes Spark would put them into one task."""
    return df.repartition(max(least, TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism), *by)


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back, so that what is used several times is computed once. It stays until ``clear``."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
