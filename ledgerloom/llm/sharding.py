"""Proportional stratified interleaving of documents into shards.

Rows are shuffled by a seeded hash within their source, ranked, and placed at their fractional rank
(rank + start) / rows of the source, where each source has a seeded start between 0 and 1, so that
many small sources do not all land in one spot. The order of fractional ranks is cut into equal
shards, so each shard holds every source in the proportion of the whole. Shard sizes differ by at
most one row.

No window ever spans a source or the table. Ranks come from counts of hash ranges: rows are counted
per (source, range), the counts are summed up in range order, and only rows of one range are ranked
in one task. The number of ranges follows the number of rows, so a source with a third of all rows
is as many ranges as its size asks for.

Defined results: rows with a null source are a source of their own; null ids and texts are placed
like others; repeated rows are placed one by one (which of two equal rows is first does not show).
An empty table gives no rows. Only the columns named here are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_or_empty
from ledgerloom.operators.materialize import materialize

# Rows that one task ranks at a time, on average.
RANGE_ROWS = 20_000
# Hash values are 52 bits, so that they are exact in every engine's doubles.
HASH_BITS = 52


def _hash(parts: str, digits: int) -> str:
    """The first hex digits of an md5 as a number; the same in any engine."""
    return f"cast(conv(substr(md5(concat_ws('|', {parts})), 1, {digits}), 16, 10) AS bigint)"


def _ranks(rows: DataFrame, strata: list[str], range_column: str, order: list[str],
           name: str) -> DataFrame:
    """``rows`` with the 0-based ``name`` in the order of (range, order) within ``strata``."""
    keys = [*strata, range_column]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # One row per range: the sums run over counts, not over documents.
    running = Window.partitionBy(*strata).orderBy(range_column)
    offsets = counts.select(
        *keys, (F.sum("_n").over(running) - F.col("_n")).alias("_offset"))
    within = Window.partitionBy(*keys).orderBy(*order)
    placed = rows.withColumn("_within", F.row_number().over(within) - 1)
    on = [placed[k].eqNullSafe(offsets[k]) for k in keys]
    joined = placed.join(offsets, on, "left").select(
        *[placed[c] for c in placed.columns], offsets["_offset"])
    return joined.withColumn(name, F.col("_offset") + F.col("_within")).drop("_offset", "_within")


def interleave(docs: DataFrame, shards: int, seed: int = 0,
               range_rows: int = RANGE_ROWS) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row."""
    base = docs.select(
        "doc_id", "source",
        (F.octet_length(text_or_empty()) + 8).cast("long").alias("size"),
        F.crc32(text_or_empty().cast("binary")).alias("text_crc32"))
    rows = materialize(base.withColumn("_u", F.expr(_hash(
        f"'{seed}', coalesce(cast(doc_id AS string), ''), cast(text_crc32 AS string)",
        HASH_BITS // 4))), "shard_rows")
    total = rows.count()
    ranges = max(1, -(-total // range_rows))
    width = -(-(1 << HASH_BITS) // ranges)
    rows = rows.withColumn("_range", F.expr(f"int(_u div {width})"))
    ranked = _ranks(rows, ["source"], "_range", ["_u", "doc_id", "text_crc32", "size"], "_rank")
    per_source = rows.groupBy("source").agg(F.count(F.lit(1)).alias("_of"))
    at = ranked.join(per_source, ranked["source"].eqNullSafe(per_source["source"]), "left").select(
        *[ranked[c] for c in ranked.columns], per_source["_of"])
    # The fractional rank as an exact integer: the start has 20 bits, the quotient 52.
    start = _hash(f"'{seed}', coalesce(cast(source AS string), '')", 5)
    at = at.withColumn("_at", F.expr(
        f"bigint((CAST(_rank * {1 << 20} + {start} AS decimal(28, 0))"
        f" * CAST({1 << (HASH_BITS - 20)} AS decimal(10, 0))) div _of)"))
    at = at.withColumn("_range", F.expr(f"int(_at div {width})"))
    placed = _ranks(at.withColumn("_one", F.lit(0)), ["_one"], "_range",
                    ["_at", "source", "_rank"], "_position")
    # Shard k is positions ceil(k * total / shards) up to the next: sizes differ by one at most.
    shard = F.expr(f"int((_position * {shards}) div {max(total, 1)})")
    first = F.expr(f"(bigint(shard) * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("_position") - first).select(
        "doc_id", "source", "size", "text_crc32", "shard", "slot")
