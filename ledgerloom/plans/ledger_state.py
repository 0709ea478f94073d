"""The inventory ledger's state between runs: sales rolled up by product and restock interval.

Within a restock interval a product's supply stands still and its units sold only grow, so the ledger's
worst day is the interval's last, and the latest position follows from the units of all intervals. A
run rolls up again the intervals that hold changed days, from their own day partitions: new days
extend the last interval, late, moved and deleted orders change the intervals of their days. Intervals
count from the first day with sales; if that moves, all are rolled up again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators.checks import Check, as_results, run_checks
from ledgerloom.params import Params
from ledgerloom.plans import inventory
from ledgerloom.sinks import manifest
from ledgerloom.sinks.day_state import changes, fingerprints, noted, of_days
from ledgerloom.sinks.tables import hadoop_path
from ledgerloom.sources.lake import read_table

SCHEMA = "product_id string, units bigint, least_units bigint, sales bigint"
INTERVAL = "interval"


@dataclass(frozen=True)
class LedgerState:
    """The rolled-up form of the day-partitioned daily sales at ``source``."""

    spark: SparkSession
    path: str
    source: str
    source_schema: str
    params: Params

    def daily(self) -> DataFrame:
        return read_table(self.spark, self.source, self.source_schema)

    def refresh(self) -> list[int]:
        """Roll up the intervals with changed days; return their numbers."""
        step = self.params.restock_interval_days
        with manifest.writing(self.spark, self.path) as draft:
            now = fingerprints(self.spark, self.source, "order_date")
            first, last = min(now, default=None), max(now, default=None)
            anchor = f"{first} {step}"
            same = draft.base.facts.get("anchor") == anchor
            changed = changes(now, draft.base.facts if same else {})
            if not changed and same:
                return []
            stale = sorted({(day - first).days // step for day in changed}) if first else []
            days = [d for d in now if (d - first).days // step in set(stale)]
            parts = {n: f for n, f in draft.base.parts.items() if same and int(n) not in stale}
            if days:
                parts |= self._write(draft, days, first)
            draft.publish(parts, noted(now) | {
                "anchor": anchor, "first": str(first), "last": str(last)})
            return stale

    def _write(self, draft: manifest.Draft, days: list[dt.date], first: dt.date) -> dict[str, str]:
        target = f"{self.path}/{draft.folder}"
        number = F.floor(F.datediff("order_date", F.lit(first))
                         / F.lit(self.params.restock_interval_days)).cast("int")
        rolled = of_days(self.daily(), "order_date", days).groupBy(
            "product_id", number.alias(INTERVAL)).agg(
                F.sum("units_sold").alias("units"), F.min("units_sold").alias("least_units"),
                F.count(F.lit(1)).alias("sales"))
        rolled.hint("rebalance", INTERVAL).write.mode("overwrite").partitionBy(INTERVAL).parquet(target)
        folder, fs = hadoop_path(self.spark, target)
        names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
        return {n.removeprefix(f"{INTERVAL}="): f"{draft.folder}/{n}" for n in names}

    def _rows(self, version: manifest.Manifest) -> DataFrame:
        """Units per product and interval."""
        # One folder per interval; its name carries the number.
        rows = manifest.read_parts(self.spark, self.path, version.parts, SCHEMA)
        place = F.regexp_extract(F.col("_metadata.file_path"), f"{INTERVAL}=([0-9]+)/", 1)
        return rows.withColumn(INTERVAL, place.cast("int")) if version.parts else rows.withColumn(
            INTERVAL, F.lit(0))

    def _span(self, version: manifest.Manifest) -> tuple[Column, Column]:
        return tuple(F.lit(version.facts.get(k)).try_cast("date") for k in ("first", "last"))

    def health(self, attributes: DataFrame) -> DataFrame:
        """The health mart, from the rolled-up units."""
        version = manifest.newest(self.spark, self.path)
        totals = self._rows(version).groupBy("product_id").agg(F.sum("units").alias("cum_units"))
        return inventory.health(inventory.position_of_totals(
            totals, *self._span(version), self.params, attributes))

    def suspects(self, checks: Sequence[Check]) -> DataFrame:
        """Products for which the ledger can break a check on some day."""
        version = manifest.newest(self.spark, self.path)
        first, last = self._span(version)
        step = self.params.restock_interval_days
        order = Window.partitionBy("product_id").orderBy(INTERVAL)
        whole = Window.partitionBy("product_id")
        elapsed = F.datediff(last, first)
        ends = self._rows(version).select(
            "product_id", "least_units",
            F.sum("units").over(order).alias("cum_units"),
            F.least((F.col(INTERVAL) + 1) * step - 1, elapsed).alias("days_elapsed"),
            inventory.demand(F.sum("units").over(whole), elapsed + 1))
        broken = F.col("least_units") < 0
        for check in checks:
            if check.kind == "row":
                broken = broken | F.coalesce(check.bad(), F.lit(False))
        # A filter on the ledger itself would repeat its expressions, the md5 too, in every condition.
        return inventory.ledger(ends, self.params).groupBy("product_id").agg(
            F.bool_or(broken).alias("_broken")).filter("_broken").select("product_id")

    def checks(self, checks: Sequence[Check], attributes: DataFrame,
               warn_only: Sequence[str] = (), suite: str = "model") -> DataFrame:
        """Results of checks on the dense ledger, whose rows are made for suspect products only.

        A product is suspect if the ledger breaks a check on the last day of an interval, or if its
        units ever shrink; for all others no day can break one.
        """
        suspects = self.suspects(checks)
        if suspects.isEmpty():
            return as_results(self.spark, suite, [(c, 0) for c in checks])
        first, last = self._span(manifest.newest(self.spark, self.path))
        span = F.struct(first.alias("first_day"), last.alias("last_day"))
        dense = inventory.inventory_position(
            self.daily().join(suspects, "product_id", "left_semi"), self.params, attributes, span)
        return run_checks(suite, {checks[0].model: dense}, checks, warn_only)

    def orphans(self, parent: DataFrame, column: str) -> DataFrame:
        """How many sales have a product that ``parent`` lacks: one row, ``failing_rows``."""
        version = manifest.newest(self.spark, self.path)
        known = parent.select(F.col(column).alias("product_id"))
        return self._rows(version).filter("product_id IS NOT NULL").join(
            known, "product_id", "left_anti").agg(
                F.coalesce(F.sum("sales"), F.lit(0)).alias("failing_rows"))
