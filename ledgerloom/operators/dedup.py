"""Latest-wins deduplication of overlapping snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECENCY = ("_ingest_date", "_loaded_at")


def latest_wins(df: DataFrame, keys: Sequence[str], ties: Sequence[str],
                recency: Sequence[str] = RECENCY) -> DataFrame:
    """Keep one row per key: the one ingested, then loaded, last.

    ``ties`` makes the order total, so a rerun picks the same row. A caller that needs fewer
    columns passes a prefix of the same ``ties`` and gets the same values for them.

    The rank-equals-one filter lets Spark cut each input partition to one row per key before
    the shuffle, so a key with very many copies stays cheap.
    """
    order = ", ".join(f"`{c}` DESC NULLS LAST" for c in (*recency, *ties))
    partition = ", ".join(f"`{k}`" for k in keys)
    rank = F.expr(f"row_number() OVER (PARTITION BY {partition} ORDER BY {order}) AS _rank")
    return df.select("*", rank).where("_rank = 1").drop("_rank")
