"""A type-2 history of which a snapshot rewrites only what it changes.

Open rows lie in hash buckets of the key, closed rows apart from them in folders that are only added to.
With each bucket a version keeps the digest of the snapshot rows its open rows stand for, so the
next snapshot is digested in one aggregation and only buckets that differ are read, compared and
written. A snapshot equal to the one before writes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.history import apply_snapshot
from ledgerloom.sinks import manifest
from ledgerloom.sinks.buckets import BUCKET, BUCKETS, Buckets, bucket_of

CLOSED = "closed"
# Closed rows are gathered into one folder once they lie in so many.
CLOSED_PARTS = 32


def digests(rows: DataFrame, columns: Sequence[str], key: str, count: int) -> dict[int, str]:
    """Per bucket, a digest of its rows that their order does not change: 128 bits and the count."""
    sums = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")) for seed in (1, 2)]
    found = rows.groupBy(bucket_of([key], count).alias(BUCKET)).agg(
        F.concat_ws(":", F.count(F.lit(1)), *sums).alias("digest"))
    return {r[BUCKET]: r["digest"] for r in found.collect()}


@dataclass(frozen=True)
class HistoryTable:
    spark: SparkSession
    path: str
    key: str
    checked: tuple[str, ...]
    schema: str  # key, checked columns, valid_from, valid_to
    count: int = BUCKETS

    def _buckets(self) -> Buckets:
        return Buckets(self.spark, self.path, self.schema, (self.key,), self.count)

    def read(self) -> DataFrame:
        """All rows, open and closed."""
        version = manifest.newest(self.spark, self.path)
        return manifest.read_parts(self.spark, self.path, version.parts, self.schema)

    def read_closed(self, version: manifest.Manifest) -> DataFrame:
        parts = {n: f for n, f in version.parts.items() if n.startswith(CLOSED)}
        return manifest.read_parts(self.spark, self.path, parts, self.schema)

    def apply(self, snapshot: DataFrame, at: dt.datetime, owner: str = "") -> list[int]:
        """Take in a snapshot; return the buckets rewritten."""
        buckets, columns = self._buckets(), [self.key, *self.checked]
        snapshot = snapshot.select(*columns)
        with manifest.writing(self.spark, self.path, owner) as draft:
            count = buckets.stored_count(draft.base)
            known = {int(b): d for b, d in draft.base.facts.items() if b.isdigit()}
            now = digests(snapshot, columns, self.key, count)
            changed = sorted(b for b in known.keys() | now.keys() if known.get(b) != now.get(b))
            if not changed:
                return []
            own = bucket_of([self.key], count).isin(changed)
            rows = apply_snapshot(buckets.read(draft.base, changed), snapshot.filter(own), self.key,
                                  list(self.checked), at).persist()
            try:
                is_open = F.col("valid_to").isNull()
                parts = buckets.write(draft, rows.filter(is_open), changed, count)
                closed = rows.filter(~is_open)
                if not closed.isEmpty():
                    folders = [n for n in parts if n.startswith(CLOSED)]
                    if len(folders) >= CLOSED_PARTS:
                        closed = closed.unionByName(self.read_closed(draft.base))
                        parts = {n: f for n, f in parts.items() if n not in folders}
                    closed.write.mode("overwrite").parquet(f"{self.path}/{draft.folder}-{CLOSED}")
                    parts[f"{CLOSED}{draft.number:010d}"] = f"{draft.folder}-{CLOSED}"
                draft.publish(parts, {"buckets": str(count)} | {str(b): d for b, d in now.items()})
                return changed
            finally:
                rows.unpersist()
