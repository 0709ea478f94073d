"""Date and time expressions on naive UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(col: Column) -> Column:
    """Text to timestamp; null where the text is not a timestamp."""
    return col.try_cast("timestamp_ntz")


def parse_date(col: Column) -> Column:
    return parse_timestamp(col).cast("date")


def hours_between(earlier: Column, later: Column) -> Column:
    """Hour boundaries crossed from ``earlier`` to ``later``."""
    start = F.date_trunc("hour", earlier.cast("timestamp_ntz"))
    end = F.date_trunc("hour", later.cast("timestamp_ntz"))
    return F.timestamp_diff("HOUR", start, end)
