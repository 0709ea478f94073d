"""Numeric expressions whose results do not depend on the engine or on row order.

Money is an exact decimal while it is added up and a double only in finished models, so a sum
does not change with the order in which partitions arrive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATIO = "decimal(6,4)"


def money(col: Column) -> Column:
    return col.cast(MONEY)


def ratio(col: Column) -> Column:
    return col.cast(RATIO)


def to_double(*names: str) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]


def round_half_away(x: Column, places: int) -> Column:
    """Round a double, halves away from zero, by scaling in binary.

    ``F.round`` on a double goes through its decimal text instead, which gives another answer
    for values such as 1.005.
    """
    scale = F.lit(float(10**places))
    return F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double; null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def whole_number(col: Column) -> Column:
    """Text to int, fractions rounded; raises where the text is not a number."""
    return F.round(col.cast("decimal(18,4)"), 0).cast("int")


def parse_whole_number(col: Column) -> Column:
    """Text to int, fractions rounded; null where the text is not a number."""
    return F.round(col.try_cast("decimal(18,4)"), 0).try_cast("int")


def spread_bucket(key: Column, buckets: int) -> Column:
    """Stable bucket of a key from the first 32 bits of its md5, the same in any engine."""
    head = F.substring(F.md5(key.cast("string").cast("binary")), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(buckets))
