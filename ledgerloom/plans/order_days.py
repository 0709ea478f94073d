"""On which business day each order counts: an index in hash buckets of the order.

An order whose purchase time is corrected counts on its new day; the index tells the day it leaves,
however far back that is. Such days are noted in the index with the same version that moves the
order, and struck off once they are rebuilt, so a run that dies in between leaves them to the next.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sinks import manifest
from ledgerloom.sinks.buckets import BUCKETS, Buckets

SCHEMA = "order_id string, order_date date, _ingest_date string, _loaded_at string"
LEFT = "left"


class OrderDays:
    def __init__(self, spark: SparkSession, path: str, count: int = BUCKETS):
        self.table = Buckets(spark, path, SCHEMA, ("order_id",), count)

    def exists(self) -> bool:
        return manifest.newest(self.table.spark, self.table.path).number > 0

    def left(self) -> list[dt.date]:
        """Days that orders have left and that are not rebuilt yet."""
        facts = manifest.newest(self.table.spark, self.table.path).facts
        return [dt.date.fromisoformat(d) for d in facts.get(LEFT, "").split()]

    def update(self, orders: DataFrame) -> None:
        """Take in rows of orders, in any order and any number of times; the newest counts."""
        table = self.table
        with manifest.writing(table.spark, table.path) as draft:
            count = table.stored_count(draft.base)
            newer = table.newer(draft, orders.select(
                "order_id", "order_date", "_ingest_date", "_loaded_at"), ("order_date",))
            changed = table.touched(newer, count)
            if not changed:
                return
            then = table.read(draft.base, changed).select("order_id", F.col("order_date").alias("_then"))
            days = {r[0].isoformat() for r in newer.join(then, "order_id").filter(
                "_then <> order_date").select("_then").distinct().collect()}
            parts = table.replace(draft, newer, changed)
            draft.publish(parts, {"buckets": str(count), LEFT: " ".join(
                sorted(days | set(draft.base.facts.get(LEFT, "").split())))})

    def rebuilt(self, days: Collection[dt.date]) -> None:
        """Strike off days that were rebuilt."""
        if not days:
            return
        with manifest.writing(self.table.spark, self.table.path) as draft:
            rest = set(draft.base.facts.get(LEFT, "").split()) - {d.isoformat() for d in days}
            draft.publish(draft.base.parts, dict(draft.base.facts) | {LEFT: " ".join(sorted(rest))})

    def counting(self, headers: DataFrame) -> DataFrame:
        """The headers without those of orders that count on another day."""
        version = manifest.newest(self.table.spark, self.table.path)
        only = self.table.touched(headers, self.table.stored_count(version))
        known = self.table.read(version, only).select("order_id", F.col("order_date").alias("_now"))
        return headers.join(known, "order_id", "left").filter(
            "_now IS NULL OR _now = order_date").drop("_now")
