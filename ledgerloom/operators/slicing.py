"""Which days a run covers, and which source rows belong to each of them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import parse_date
from ledgerloom.sources.files import EVENT_TIME

Day = dt.date | Column


def plan_window(bounds: DataFrame, mark: DataFrame, max_days: int,
                start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Business days of the next run, one row per day; none when there is nothing to do.

    ``bounds`` holds first_day and last_day of the source and ``mark`` last_loaded_date, one
    row each. Without a start the run continues after the mark; without an end it covers
    ``max_days``; either is clamped to the source.
    """
    last_loaded = mark.select("last_loaded_date").scalar()
    first_day, last_day = F.col("first_day"), F.col("last_day")
    begin = (F.lit(start).cast("date") if start is not None
             else F.coalesce(F.date_add(last_loaded, 1), first_day))
    until = F.lit(end).cast("date") if end is not None else F.date_add(begin, max_days - 1)
    window = bounds.select(
        F.greatest(begin, first_day).alias("start"), F.least(until, last_day).alias("end")
    )
    return window.filter(F.col("start") <= F.col("end")).select(
        F.explode(F.sequence("start", "end")).alias("business_day"))


def slice_days(df: DataFrame, event_day: Column, start: Day, end: Day,
               lookback_days: int) -> DataFrame:
    """Each row once per ingest day of [start, end] whose re-scan window covers it.

    A day re-scans itself and the ``lookback_days`` before it, so a row belongs to its own day
    and the days after. All days come out of one pass; a row without a day matches none.
    """
    first = F.greatest(event_day, F.lit(start))
    last = F.least(F.date_add(event_day, lookback_days), F.lit(end))
    days = F.when(event_day.isNotNull() & (first <= last), F.sequence(first, last))
    return df.withColumn("ingest_date", F.explode(days))


def slice_orders(orders: DataFrame, start: Day, end: Day, lookback_days: int) -> DataFrame:
    return slice_days(orders, parse_date(F.col(EVENT_TIME)), start, end, lookback_days)


def slice_items(items: DataFrame, order_slice: DataFrame) -> DataFrame:
    """Order lines of the sliced orders, once per ingest day of their order.

    The slice is folded to one row per order first, with the set of its days (at most the days
    of the run), so lines join a unique key and copies of an order do not multiply them. The
    join is left to the planner: a small slice is broadcast, and items are read once.
    """
    days = order_slice.groupBy("order_id").agg(F.collect_set("ingest_date").alias("_days"))
    joined = items.join(days, "order_id")
    return joined.withColumn("ingest_date", F.explode("_days")).drop("_days")


def daily_snapshot(df: DataFrame, start: Day, end: Day) -> DataFrame:
    """The whole table once per ingest day."""
    return df.withColumn("ingest_date", F.explode(F.sequence(F.lit(start), F.lit(end))))


def rows_landed(slices: dict[str, DataFrame]) -> DataFrame:
    """(table_name, ingest_date, row_count) over all landed tables."""
    counts = [
        df.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "ingest_date", "row_count")
        for name, df in slices.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
