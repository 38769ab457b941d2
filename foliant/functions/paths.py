"""Column functions over paths and file names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Folders that never hold input.
RESERVED = ("archive", "error")


def glob_regex(pattern: str) -> str:
    """A wildcard pattern (``*`` and ``?``) as a regular expression for lower-cased names."""
    return "(?s)^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern.lower()) + "$"


def matches_pattern(file_name: Column, pattern: str) -> Column:
    """Whether a name fits the wildcard, ignoring case; a null name doesn't."""
    return F.coalesce(F.lower(file_name).rlike(glob_regex(pattern)), F.lit(False))


def shortened(text: Column, width: int) -> Column:
    """The text, or if it is longer than ``width`` characters, its first ones and ``~``."""
    return F.when(F.char_length(text) <= width, text).when(text.isNotNull(), F.concat(F.substring(text, 1, width - 1), F.lit("~")))


def file_name_of(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def sub_folder_of(rel_path: Column) -> Column:
    """Folders of a relative path, empty where it has none."""
    return F.when(F.contains(rel_path, F.lit("/")), F.regexp_replace(rel_path, "/[^/]*$", "")).otherwise("")


def stem_of(name: Column) -> Column:
    return F.when(F.contains(name, F.lit(".")), F.regexp_replace(name, "\\.[^.]*$", "")).otherwise(name)


def ext_of(name: Column) -> Column:
    """Extension with its dot, empty where there is none."""
    return F.regexp_extract(name, "(\\.[^.]*)$", 1)


def split_path(df: DataFrame, path: str = "rel_path") -> DataFrame:
    """Adds sub_folder, file_name, stem and ext of the relative path in column ``path``."""
    name = file_name_of(F.col(path))
    return df.withColumns({"sub_folder": sub_folder_of(F.col(path)), "file_name": name, "stem": stem_of(name), "ext": ext_of(name)})


def output_path_of(date_folder: Column, sub_folder: Column, stem: Column, ext: str = ".rtf") -> Column:
    """Where the output of a document goes, below the output root."""
    return F.concat_ws("/", date_folder, F.when(sub_folder != "", sub_folder), F.concat(stem, F.lit(ext)))


def exclude_reserved(df: DataFrame, name: str = "date_folder", claim_folder: str | None = None) -> DataFrame:
    """Drops rows whose folder is reserved, ignoring case, or is the claim folder."""
    taken = [*RESERVED, *([claim_folder.lower()] if claim_folder else [])]
    return df.where(~F.lower(F.col(name)).isin(*taken))


def classify_location(path: Column) -> Column:
    """unprocessed, archived, error or rtf; null for a log in an error folder, which is no document."""
    low = F.lower(path)
    return (
        F.when(low.endswith(".rtf"), "rtf")
        .when(low.rlike("/archive/"), "archived")
        .when(low.rlike("/error/"), F.when(~low.endswith(".log"), "error"))
        .otherwise("unprocessed")
    )
