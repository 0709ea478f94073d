"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.materialize import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count(F.lit(1)), F.expr("sum(cast(xxhash64(u, v) AS decimal(20, 0)))")).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, of every node of ``edges`` (a, b).

    Nodes without an edge to another node are left out, so no edges give no rows; repeated edges and
    loops change nothing, and edges with a null end are none. The rounds are stored, so a lost executor
    costs a re-read; per-node minima are combined before they are shuffled.
    """
    now = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(), "component_edges")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.expr(
            "array(struct(u AS u, m AS v), struct(v AS u, m AS v))")).alias("e")).select("e.*")
        after = materialize(small.where("u <> v").distinct(), "component_edges")
        state_after = _state(after)
        if state_after == state:
            break
        now, state = after, state_after
    roots = after.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct())
