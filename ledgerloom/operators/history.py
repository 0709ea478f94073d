"""Slowly changing dimension, type 2, by comparing a snapshot with the open rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def empty_history(snapshot: DataFrame) -> DataFrame:
    """History before the first snapshot."""
    return _opened(snapshot, F.lit(None)).filter(F.lit(False))


def _opened(rows: DataFrame, at: Column) -> DataFrame:
    return rows.withColumns({
        "valid_from": at.cast("timestamp_ntz"),
        "valid_to": F.lit(None).cast("timestamp_ntz"),
    })


def apply_snapshot(history: DataFrame, snapshot: DataFrame, key: str, checked: Sequence[str],
                   at: dt.datetime) -> DataFrame:
    """History after one more snapshot taken ``at``.

    A changed key closes its open row and opens another, a missing key closes its row, and a
    key that comes back opens a new row. Nulls compare as equal.

    One full join of the open rows with the snapshot decides all cases: each joined pair emits
    the old row (kept or closed), the new row, or both. Rows already closed pass through.
    """
    now = F.lit(at).cast("timestamp_ntz")
    columns = [key, *checked]
    is_open = F.col("valid_to").isNull()

    before = history.filter(is_open).select(
        F.col(key), F.struct(*checked, "valid_from").alias("_old"))
    after = snapshot.select(F.col(key), F.struct(*checked).alias("_new"))
    pairs = before.join(after, key, "full")

    had, has = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in checked],
    )
    unchanged = had & has & same
    never = F.lit(None).cast("timestamp_ntz")
    old_row = F.struct(
        *[F.col(f"_old.{c}").alias(c) for c in checked],
        F.col("_old.valid_from").alias("valid_from"),
        F.when(unchanged, never).otherwise(now).alias("valid_to"),
    )
    new_row = F.struct(
        *[F.col(f"_new.{c}").alias(c) for c in checked],
        now.alias("valid_from"), never.alias("valid_to"),
    )
    rows = F.array_compact(F.array(F.when(had, old_row), F.when(has & ~unchanged, new_row)))
    current = pairs.select(key, F.inline(rows))
    return history.filter(~is_open).select(*columns, "valid_from", "valid_to").unionByName(current)
