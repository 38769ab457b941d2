"""Times as reports show them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats of reports and of names of files.
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
STAMP = "yyyyMMdd_HHmmss"


def hms(ms: Column) -> Column:
    """A duration as hh:mm:ss. Whole days are dropped, as in the reports; null stays null."""
    s = F.floor(ms / 1000)
    return F.when(ms.isNotNull(), F.format_string("%02d:%02d:%02d", F.floor(s / 3600) % 24, F.floor(s / 60) % 60, s % 60))


def iso_utc(at: Column) -> Column:
    return F.date_format(at, ISO)


def run_stamp(at: Column) -> Column:
    """The stamp that names a run's files."""
    return F.date_format(at, STAMP)
