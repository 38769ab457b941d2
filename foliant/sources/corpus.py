"""Any table of documents as a corpus of enveloped files, and the manifest of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decode import base64_line
from ..functions.paths import matches_pattern, split_path
from ..operators.batches import assign_batches


def url_folder(url: Column) -> Column:
    """First segment of a url's path, ``root`` where there is none."""
    found = F.coalesce(F.regexp_extract(url, "://[^/]+/([^/?#]+)", 1), F.lit(""))
    return F.when(found != "", found).otherwise("root")


def url_host(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit(""))


def documents_table(df: DataFrame, text: Column, date_folder: Column, sub_folder: Column, file_name: Column) -> DataFrame:
    """A table with a text column as enveloped files: content is the one-line Base64 of the UTF-8 text."""
    envelope = base64_line(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).cast("binary")
    rows = df.select(date_folder.alias("date_folder"), sub_folder.alias("_sub"), file_name.alias("_name"), envelope.alias("content"))
    rel = F.concat_ws("/", F.when(F.col("_sub") != "", F.col("_sub")), "_name")
    rows = split_path(rows.withColumn("rel_path", rel)).drop("_sub", "_name")
    return rows.withColumns({"folder_path": F.col("date_folder"), "path": F.concat_ws("/", "date_folder", "rel_path"), "length": F.octet_length("content").cast("long")})


def pages_corpus(pages: DataFrame) -> DataFrame:
    return documents_table(pages, F.col("html"), url_folder(F.col("url")), url_host(F.col("url")), F.format_string("page_%d.xhtml", F.col("page_id")))


def manifest_of(files: DataFrame, pattern: str = "*.xhtml", batch: int = 1000) -> DataFrame:
    """Files with ``matched``; those that match also with batch_no and batch_id. Content is not read."""
    rows = files.drop("content").withColumn("matched", matches_pattern(F.col("file_name"), pattern))
    good = assign_batches(rows.where("matched"), batch)
    return good.unionByName(rows.where("not matched"), allowMissingColumns=True)
