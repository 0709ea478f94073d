"""Keyed state in hash buckets, of which an update rewrites only those it changes.

A key belongs to the bucket of its hash. A version (``sinks/manifest.py``) names the folder of each
bucket, so a bucket that an update leaves alone keeps its files. The number of buckets is a property
of the stored table; ``rebucket`` changes it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.dedup import latest_wins
from ledgerloom.operators.materialize import materialize
from ledgerloom.sinks import manifest
from ledgerloom.sinks.tables import hadoop_path

BUCKETS = 64
BUCKET = "bucket"


def bucket_of(keys: Sequence[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")


@dataclass(frozen=True)
class Buckets:
    """A table of the columns of ``schema`` in hash buckets of ``keys``."""

    spark: SparkSession
    path: str
    schema: T.StructType | str
    keys: tuple[str, ...]
    count: int = BUCKETS

    def stored_count(self, version: manifest.Manifest) -> int:
        return int(version.facts.get("buckets", self.count))

    def read(self, version: manifest.Manifest | None = None,
             only: Iterable[int] | None = None) -> DataFrame:
        """All rows of a version, or those of some buckets; no other file is opened."""
        version = version or manifest.newest(self.spark, self.path)
        wanted = None if only is None else {str(b) for b in only}
        parts = {n: f for n, f in version.parts.items() if wanted is None or n in wanted}
        return manifest.read_parts(self.spark, self.path, parts, self.schema)

    def write(self, draft: manifest.Draft, rows: DataFrame, changed: Iterable[int],
              count: int) -> dict[str, str]:
        """Write ``changed`` buckets, all of whose rows are ``rows``; return the parts of the version."""
        target = f"{self.path}/{draft.folder}"
        rows.withColumn(BUCKET, bucket_of(self.keys, count)).hint("rebalance", BUCKET).write.mode(
            "overwrite").partitionBy(BUCKET).parquet(target)
        folder, fs = hadoop_path(self.spark, target)
        written = {s.getPath().getName().removeprefix(f"{BUCKET}=") for s in fs.listStatus(folder)
                   if s.isDirectory()}
        gone = {str(b) for b in changed} - written
        parts = {n: f for n, f in draft.base.parts.items() if n not in gone}
        return parts | {n: f"{draft.folder}/{BUCKET}={n}" for n in written}

    def touched(self, rows: DataFrame, count: int) -> list[int]:
        """The buckets of some rows: at most ``count`` numbers, however many rows."""
        found = rows.select(bucket_of(self.keys, count).alias(BUCKET)).distinct().collect()
        return sorted(r[0] for r in found)

    def newer(self, draft: manifest.Draft, batch: DataFrame, ties: Sequence[str]) -> DataFrame:
        """The batch's newest row per key where it beats the stored one, stored as a table.

        The batch is stored as it came: one shuffle then serves its own versions and the stored rows.
        """
        batch = materialize(batch, "bucket_batch")
        stored = self.read(draft.base, self.touched(batch, self.stored_count(draft.base)))
        both = stored.withColumn("_stored", F.lit(1)).unionByName(batch.withColumn("_stored", F.lit(0)))
        return materialize(latest_wins(both, self.keys, (*ties, "_stored")).filter(
            "_stored = 0").drop("_stored"), "bucket_newer")

    def replace(self, draft: manifest.Draft, newer: DataFrame, changed: Iterable[int]
                ) -> dict[str, str]:
        """Write the ``changed`` buckets with the rows of ``newer`` in place of those of their keys."""
        keys = newer.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(self.keys)])
        # A null key is a key like others.
        same = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(self.keys)]
        rows = self.read(draft.base, changed).join(keys, same, "left_anti").unionByName(newer)
        return self.write(draft, rows, changed, self.stored_count(draft.base))

    def merge_latest(self, batch: DataFrame, ties: Sequence[str], owner: str = "") -> list[int]:
        """Keep the newest of the stored rows and the batch's per key; return the buckets rewritten.

        A row that is stored already loses nothing and wins nothing, so a replay writes nothing.
        """
        with manifest.writing(self.spark, self.path, owner) as draft:
            count = self.stored_count(draft.base)
            newer = self.newer(draft, batch, ties)
            changed = self.touched(newer, count)
            if changed:
                draft.publish(self.replace(draft, newer, changed), {"buckets": str(count)})
            return changed

    def rebucket(self, count: int, owner: str = "") -> None:
        """Deal all rows to ``count`` buckets."""
        with manifest.writing(self.spark, self.path, owner) as draft:
            old = range(self.stored_count(draft.base))
            parts = self.write(draft, self.read(draft.base), old, count)
            draft.publish({n: f for n, f in parts.items() if f.startswith(draft.folder)},
                          {"buckets": str(count)})
