"""The daily models on an unbounded feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.functions import parse_date
from ledgerloom.operators.dedup import latest_wins
from ledgerloom.plans import daily_run
from ledgerloom.plans.daily_run import Job
from ledgerloom.sinks import manifest
from ledgerloom.sinks.buckets import BUCKETS, Buckets
from ledgerloom.sources import lake
from ledgerloom.sources.files import EVENT_TIME

EVENT_VALUE = "decimal(18,2)"


def raw_stream(spark: SparkSession, root: str, table: str, files_per_batch: int) -> DataFrame:
    """New files of a raw table as they land, at most ``files_per_batch`` at a time."""
    return (
        spark.readStream.schema(lake.raw_schema(table))
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(lake.raw_path(root, table))
    )


def touched_days(job: Job, batch: DataFrame) -> list[dt.date]:
    """Business days of the orders that a batch of landed orders and order lines belongs to.

    A line lands in the partition of its order, so its day is looked up in the partitions of the
    batch only. The days are at most those of the calendar, however many rows the batch has.
    """
    landed = [r[0] for r in batch.select("ingest_date").distinct().collect()]
    orders = lake.read_raw(job.spark, job.root, "orders").filter(
        F.col("ingest_date").isin(landed)).select(
            "order_id", "ingest_date", parse_date(F.col(EVENT_TIME)).alias("day"))
    lines = batch.filter("day IS NULL").select("order_id", "ingest_date").distinct()
    days = batch.filter("day IS NOT NULL").select("day").unionByName(
        orders.join(lines, ["order_id", "ingest_date"], "left_semi").select("day"))
    return sorted(r[0] for r in days.filter("day IS NOT NULL").distinct().collect())


def refresh_fact(job: Job, batch: DataFrame) -> None:
    """Bring the sales fact up to date for the days a batch touches.

    ``batch`` has order_id, ingest_date and, for orders, the day. The days are rebuilt from the
    lake, so a late or repeated order, lines that land after their order, an order split over
    batches and a replay of the whole batch all end in the same fact. An order whose purchase time
    is corrected also rebuilds the day it leaves.
    """
    days = touched_days(job, batch)
    if not days:
        return
    landed = [r[0] for r in batch.select("ingest_date").distinct().collect()]
    index = daily_run.order_days(job)
    index.update(lake.read_raw(job.spark, job.root, "orders").filter(
        F.col("ingest_date").isin(landed)).select(
            "order_id", parse_date(F.col(EVENT_TIME)).alias("order_date"), "_ingest_date",
            "_loaded_at").filter("order_date IS NOT NULL"))
    left = index.left()
    _, attributes = daily_run.build_dimensions(
        job, daily_run.Window(min(landed), max(landed)), relanded=False)
    daily_run.rebuild_days(job, sorted({*days, *left}), attributes, exact=left)
    index.rebuilt(left)


def landed_keys(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """What ``refresh_fact`` needs of landed orders and order lines, tables or streams."""
    return orders.select("order_id", "ingest_date", parse_date(F.col(EVENT_TIME)).alias("day")) \
        .unionByName(lines.select("order_id", "ingest_date", F.lit(None).cast("date").alias("day")))


def stream_fact(job: Job, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Keep the sales fact up to date with the orders and order lines landing in the lake.

    The query works off all files there are and stops; the next start continues after them.
    """
    keys = landed_keys(*(raw_stream(job.spark, job.root, table, files_per_batch)
                         for table in ("orders", "order_items")))
    return (
        keys.writeStream.foreachBatch(lambda batch, _: refresh_fact(job, batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def latest_table(spark: SparkSession, path: str, keys: tuple[str, ...],
                 ties: tuple[str, ...], count: int = BUCKETS) -> Buckets:
    """The table of the newest raw row per key, in hash buckets of the key."""
    columns = [*keys, *ties, "_ingest_date", "_loaded_at"]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return Buckets(spark, path, schema, keys, count)


def merge_latest(batch: DataFrame, path: str, keys: tuple[str, ...], ties: tuple[str, ...],
                 count: int = BUCKETS) -> list[int]:
    """Merge a batch of snapshots into the table of the newest row per key.

    Streaming deduplication would keep the first row of a key; this keeps the last, however late
    the batch is. Only buckets in which a row changes are rewritten (their numbers are returned), so a
    batch of k keys rewrites at most k, and a replayed batch none.
    """
    table = latest_table(batch.sparkSession, path, keys, ties, count)
    return table.merge_latest(batch.select(*table.schema.fieldNames()), ties)


def stream_latest(stream: DataFrame, path: str, keys: tuple[str, ...], ties: tuple[str, ...],
                  checkpoint: str, count: int = BUCKETS) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(
            lambda batch, _: merge_latest(batch, path, keys, ties, count) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def daily_totals(events: DataFrame, lateness: str | None = None) -> DataFrame:
    """Events and value per day and type; the same plan for a table and for a stream.

    On a stream, ``lateness`` such as ``"3 days"`` closes a day once the feed is that far past
    it, which bounds the state.
    """
    if lateness is not None:
        # Event time of a stream must be a zoned timestamp; the session zone is UTC.
        events = events.withColumn("ts", F.col("ts").cast("timestamp"))
        events = events.withWatermark("ts", lateness)
    return (
        events.groupBy(F.window("ts", "1 day"), "event_type")
        .agg(F.expr("count(1) AS events"),
             F.expr(f"double(sum(CAST(value AS {EVENT_VALUE}))) AS total_value"))
        .select(F.expr("date(window.start) AS event_day"), "event_type", "events", "total_value")
    )


def stream_daily_totals(events: DataFrame, out: str, checkpoint: str,
                        lateness: str = "3 days") -> StreamingQuery:
    """Append each day's totals once the day can no longer change."""
    return (
        daily_totals(events, lateness).writeStream.outputMode("append").format("parquet")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


# Totals of days as they are kept between batches: exact, so that partial sums add up.
_TOTALS = "event_day date, event_type string, events bigint, total decimal(38,2)"
# Late rows are gathered into one folder once they lie in so many.
LATE_PARTS = 32


class ClosedDays:
    """Totals of days that are final, open days, and the rows that came after their day was closed.

    A day is closed once the newest event seen before a batch is ``lateness`` past its end. A batch
    adds its rows to the open days, puts rows of closed days and rows without a time aside, and
    publishes all of it as one version with its batch number, so a replayed batch changes nothing and
    totals plus late rows are always the rows read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, lateness: str):
        self.spark, self.path, self.schema, self.lateness = spark, path, schema, lateness

    def add(self, batch: DataFrame, number: int) -> None:
        with manifest.writing(self.spark, self.path) as draft:
            facts = dict(draft.base.facts)
            if number <= int(facts.get("batch", -1)):
                return
            batch = batch.persist()
            try:
                before = F.lit(facts.get("watermark")).cast("timestamp_ntz")
                newest = batch.agg(F.expr(
                    f"string(max(CAST(ts AS timestamp_ntz)) - INTERVAL {self.lateness})")).first()[0]
                facts |= {"batch": str(number), "watermark": max(
                    filter(None, (facts.get("watermark"), newest)), default=None)}
                parts = self._write(draft, batch, before, facts["watermark"])
                draft.publish(parts, {k: v for k, v in facts.items() if v is not None})
            finally:
                batch.unpersist()

    def _write(self, draft: manifest.Draft, batch: DataFrame, before: Column,
               watermark: str | None) -> dict[str, str]:
        day = F.col("ts").cast("date")
        closed_before = F.coalesce(F.date_add(day, 1).cast("timestamp_ntz") <= before, F.lit(False))
        late = F.col("ts").isNull() | closed_before
        # Late rows: at most one folder a batch.
        parts = {n: f for n, f in draft.base.parts.items() if n.startswith("late")}
        rows = batch.filter(late)
        if not rows.isEmpty():
            if len(parts) >= LATE_PARTS:
                rows, parts = rows.unionByName(self.late(draft.base)), {}
            parts[f"late{draft.number:010d}"] = f"{draft.folder}/late"
            rows.write.mode("overwrite").parquet(f"{self.path}/{draft.folder}/late")
        # One row per day and type, so all of them are written anew.
        totals = batch.filter(~late).groupBy(day.alias("event_day"), "event_type").agg(
            F.count(F.lit(1)).alias("events"),
            F.sum(F.col("value").cast(EVENT_VALUE)).cast("decimal(38,2)").alias("total"))
        folder = f"{draft.folder}/days"
        totals.unionByName(self._days(draft.base)).groupBy("event_day", "event_type").agg(
            F.sum("events").alias("events"),
            F.sum("total").cast("decimal(38,2)").alias("total")).withColumn(
                "closed", F.coalesce(F.date_add("event_day", 1).cast("timestamp_ntz")
                                     <= F.lit(watermark).cast("timestamp_ntz"), F.lit(False))).write.mode(
                "overwrite").parquet(f"{self.path}/{folder}")
        return parts | {"days": folder}

    def _days(self, version: manifest.Manifest) -> DataFrame:
        parts = {n: f for n, f in version.parts.items() if n == "days"}
        return manifest.read_parts(self.spark, self.path, parts, f"{_TOTALS}, closed boolean").drop(
            "closed")

    def totals(self, closed: bool = True) -> DataFrame:
        """Totals of closed days, which are final, or of open ones."""
        version = manifest.newest(self.spark, self.path)
        parts = {n: f for n, f in version.parts.items() if n == "days"}
        rows = manifest.read_parts(self.spark, self.path, parts, f"{_TOTALS}, closed boolean")
        return rows.filter(F.col("closed") == closed).select(
            "event_day", "event_type", "events", F.col("total").cast("double").alias("total_value"))

    def late(self, version: manifest.Manifest | None = None) -> DataFrame:
        """The rows that came too late or have no time."""
        version = version or manifest.newest(self.spark, self.path)
        parts = {n: f for n, f in version.parts.items() if n.startswith("late")}
        return manifest.read_parts(self.spark, self.path, parts, self.schema)


def stream_closed_days(events: DataFrame, path: str, checkpoint: str,
                       lateness: str = "3 days") -> StreamingQuery:
    """Keep ``ClosedDays`` up to date with a stream of events."""
    days = ClosedDays(events.sparkSession, path, events.schema, lateness)
    return (
        events.writeStream.foreachBatch(days.add).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
