from collections import Counter

import pytest

from ledgerloom.operators.dedup import latest_wins
from ledgerloom.operators.skew import BUCKETS, heavy_buckets, spread_join

# A third of all rows share one key, some have none.
KEYS = ["hot"] * 400 + [None] * 100 + [f"k{i % 250}" for i in range(700)]
LEFT = [(key, i) for i, key in enumerate(KEYS)]
RIGHT = [("hot", 1.0)] + [(f"k{i}", float(i)) for i in range(0, 250, 2)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("spread_rows, buckets", [(50, BUCKETS), (50, 8), (10**9, BUCKETS)])
def test_spread_join_gives_the_plain_join(spark, how, spread_rows, buckets):
    left = spark.createDataFrame(LEFT, "key string, n int")
    right = spark.createDataFrame(RIGHT, "key string, value double")
    values = dict(RIGHT)
    want = Counter((k, n, values.get(k)) for k, n in LEFT if how == "left" or k in values)
    joined = spread_join(left, right, "key", how, spread_by=["n"], spread_rows=spread_rows,
                         buckets=buckets)
    assert joined.columns == ["key", "n", "value"]
    assert Counter(tuple(r) for r in joined.collect()) == want


def test_only_overloaded_keys_are_split(spark):
    left = spark.createDataFrame(LEFT, "key string, n int")
    pieces = sorted(r["_pieces"] for r in heavy_buckets(left, "key", 50).collect())
    assert pieces == [2, 8]
    assert heavy_buckets(left, "key", 1000).count() == 0


def test_load_table_is_bounded(spark):
    left = spark.range(20_000).withColumnRenamed("id", "key")
    assert heavy_buckets(left, "key", 0, buckets=16).count() <= 16


SNAPSHOTS = [
    ("a", "2020-01-01", "08:00", "old"),
    ("a", "2020-01-02", "07:00", "new"),
    ("a", "2020-01-02", "06:00", "mid"),
    ("b", "2020-01-01", "08:00", "x"),
    ("b", "2020-01-01", "08:00", "y"),
    ("c", "2020-01-01", None, "no time"),
    ("c", "2020-01-01", "01:00", "time"),
]


def test_latest_wins(spark):
    columns = "key string, _ingest_date string, _loaded_at string, value string"
    df = spark.createDataFrame(SNAPSHOTS + SNAPSHOTS, columns)
    got = {r["key"]: r["value"] for r in latest_wins(df, ["key"], ["value"]).collect()}
    assert got == {"a": "new", "b": "y", "c": "time"}


def test_copies_are_cut_before_the_shuffle(spark):
    columns = "key string, _ingest_date string, _loaded_at string, value string"
    df = latest_wins(spark.createDataFrame(SNAPSHOTS, columns), ["key"], ["value"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle
