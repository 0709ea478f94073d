"""Keyed incremental update of a table partitioned by business day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARLIEST = dt.date(1900, 1, 1)


class SchemaChange(Exception):
    """A batch's columns differ from those of the table it should update."""


def trailing_start(target: DataFrame, date_col: str, days: int,
                   backfill_start: dt.date | None = None) -> DataFrame:
    """One row, ``start``: the first day an incremental build recomputes.

    That is ``days`` before the target's newest day, or the start of a backfill if earlier.
    """
    newest = F.coalesce(F.max(date_col), F.lit(EARLIEST))
    start = F.date_sub(newest, days)
    if backfill_start is not None:
        start = F.least(start, F.lit(backfill_start))
    return target.agg(start.alias("start"))


def trailing_batch(model: DataFrame, target: DataFrame, date_col: str, days: int,
                   backfill_start: dt.date | None = None) -> DataFrame:
    """Rows of ``model`` inside the trailing window of ``target``.

    The bound is a scalar subquery, so it reaches partition pruning of the model's source.
    """
    start = trailing_start(target, date_col, days, backfill_start).scalar()
    return model.filter(F.col(date_col) >= start)


def check_same_columns(target: DataFrame, batch: DataFrame) -> None:
    """Raise unless both have the same columns of the same types."""
    have = {f.name: f.dataType.simpleString() for f in target.schema}
    got = {f.name: f.dataType.simpleString() for f in batch.schema}
    if have != got:
        changed = sorted(n for n in have.keys() | got.keys() if have.get(n) != got.get(n))
        raise SchemaChange(f"columns changed: {', '.join(changed)}")


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], mode: str = "key",
           window: Column | None = None) -> DataFrame:
    """The target after delete and insert of the batch.

    ``mode="key"`` removes the target rows whose key is in the batch. ``mode="window"`` removes
    all target rows matching ``window``, so a key that vanished from the batch goes as well.
    """
    check_same_columns(target, batch)
    if mode == "key":
        kept = target.join(batch.select(*keys), list(keys), "left_anti")
    elif mode == "window" and window is not None:
        kept = target.filter(~F.coalesce(window, F.lit(False)))
    else:
        raise ValueError(f"mode {mode!r} needs to be 'key', or 'window' with a predicate")
    return kept.unionByName(batch)
