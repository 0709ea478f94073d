"""What follows from a day-partitioned table day by day, kept up to date for changed days only.

Every write names its files anew, so a day whose files are those of the last refresh has not changed
and is not read again. A day that was rewritten, by a run or by anyone else, is.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sinks import manifest
from ledgerloom.sinks.tables import hadoop_path
from ledgerloom.sources.lake import read_table

TAG = "tag"


def fingerprints(spark: SparkSession, path: str, day_column: str) -> dict[dt.date, str]:
    """A digest of the names of each day's data files, from one listing."""
    target, fs = hadoop_path(spark, path)
    names: dict[str, list[str]] = {}
    if fs.exists(target):
        found = fs.listFiles(target, True)
        while found.hasNext():
            file = found.next().getPath()
            day, name = file.getParent().getName(), file.getName()
            if day.startswith(f"{day_column}=") and not name.startswith(("_", ".")):
                names.setdefault(day.removeprefix(f"{day_column}="), []).append(name)
    return {dt.date.fromisoformat(day): hashlib.md5("\n".join(sorted(held)).encode()).hexdigest()[:16]
            for day, held in names.items()}


def changes(now: Mapping[dt.date, str], facts: Mapping[str, str]) -> list[dt.date]:
    """Days that are new, differ or are gone since ``facts`` were noted, in order."""
    then = {dt.date.fromisoformat(day): f for day, f in facts.items() if day[:1].isdigit()}
    return sorted(day for day in now.keys() | then.keys() if now.get(day) != then.get(day))


def noted(now: Mapping[dt.date, str]) -> dict[str, str]:
    return {day.isoformat(): digest for day, digest in now.items()}


def of_days(df: DataFrame, column: str, days: Collection[dt.date]) -> DataFrame:
    """Rows of some days; on a partition column only their files are opened."""
    return df.filter(F.col(column).isin(list(days))) if days else df.filter(F.lit(False))


@dataclass(frozen=True)
class DayState:
    """A small table with some rows per day, derived from the days of a large one.

    ``tag`` names the rules of the derivation: where it differs from the stored one, all days are
    derived again. The table has a few rows a day, so a version holds all of it.
    """

    spark: SparkSession
    path: str
    schema: str
    source: str
    source_schema: str
    day: str
    tag: str = ""

    def read(self, version: manifest.Manifest | None = None) -> DataFrame:
        version = version or manifest.newest(self.spark, self.path)
        return manifest.read_parts(self.spark, self.path, version.parts, self.schema)

    def refresh(self, derive: Callable[[DataFrame], DataFrame]) -> list[dt.date]:
        """Derive the changed days anew; return them."""
        with manifest.writing(self.spark, self.path) as draft:
            facts = draft.base.facts if draft.base.facts.get(TAG) == self.tag else {}
            now = fingerprints(self.spark, self.source, self.day)
            changed = changes(now, facts)
            if not changed and draft.base.number:
                return []
            source = read_table(self.spark, self.source, self.source_schema)
            rows = derive(of_days(source, self.day, [d for d in changed if d in now]))
            if facts:
                rows = rows.unionByName(
                    self.read(draft.base).filter(~F.col(self.day).isin(changed)))
            rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{draft.folder}")
            draft.publish({"rows": draft.folder}, noted(now) | {TAG: self.tag})
            return changed
