"""The conversion itself: decode, gate, clean up, render; one lazy plan over enveloped files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decode import error_of, read_documents, staged
from ..functions.gate import content_error
from ..functions.markup_tree import CleanUp, normalize
from ..functions.rtf import render_rtf
from .outcomes import classify_error, describe_reason, outcome_of


def convert(df: DataFrame, fn: Callable[[Column], Column] = render_rtf, text: str = "text") -> DataFrame:
    """Adds rtf and rtf_error of ``text`` by ``fn``, a column function to a struct of rtf and error. Null texts cost nothing."""
    got = F.when(F.col(text).isNotNull(), fn(F.coalesce(F.col(text), F.lit(""))))
    out = df.withColumn("_r", got)
    return out.withColumns({"rtf": F.col("_r.rtf"), "rtf_error": F.col("_r.error")}).drop("_r")


def convert_files(files: DataFrame, options: CleanUp | None = None, fn: Callable[[Column], Column] = render_rtf) -> DataFrame:
    """Enveloped files with text, rtf, error, category, reason and outcome. Files in error are not rendered."""
    rows = read_documents(files)
    rows = staged(rows, error=F.coalesce("error", F.when(F.col("text").isNotNull(), content_error(F.col("text")))))
    rows = staged(rows, text=F.when(F.col("error").isNull(), F.col("text")))
    rows = rows.withColumn("_n", F.when(F.col("text").isNotNull(), normalize(F.coalesce("text", F.lit("")), options)))
    rows = staged(rows, text=F.col("_n.text"), _clean=F.col("_n.error")).drop("_n")
    rows = convert(rows, fn)
    failed = F.coalesce("_clean", "rtf_error")
    said = F.when(failed.isNotNull(), F.struct(failed.alias("type"), F.lit("The document could not be converted.").alias("message")))
    rows = staged(rows, error=F.coalesce("error", said)).drop("_clean", "rtf_error")
    kind = classify_error(F.col("error.type"), F.array(F.col("error.message")), F.lit(0))
    rows = staged(rows, category=F.when(F.col("error").isNotNull(), kind))
    return rows.withColumns(
        {
            "reason": F.when(F.col("error").isNotNull(), describe_reason(F.col("error.type"), F.col("category"))),
            "outcome": outcome_of(F.col("category")),
            "output_bytes": F.octet_length("rtf").cast("long"),
        }
    )


__all__ = ["convert", "convert_files", "error_of"]
