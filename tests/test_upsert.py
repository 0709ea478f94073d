import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import upsert as u
from ledgerloom.sinks.tables import drop_days, write_days

SCHEMA = "order_date date, product_id string, units int"
KEYS = ["order_date", "product_id"]


def day(n):
    return dt.date(2020, 1, n)


def table(spark, *cells):
    return spark.createDataFrame([(day(d), p, n) for d, p, n in cells], SCHEMA)


TARGET = ((1, "a", 1), (2, "a", 2), (2, "gone", 9), (5, "a", 5))
BATCH = ((2, "a", 20), (2, "late", 3), (5, "a", 50))


def test_key_mode_keeps_a_key_that_left_the_batch(spark, rows):
    once = u.upsert(table(spark, *TARGET), table(spark, *BATCH), KEYS)
    want = rows(table(spark, (1, "a", 1), (2, "a", 20), (2, "gone", 9), (2, "late", 3), (5, "a", 50)))
    assert rows(once) == want
    assert rows(u.upsert(once, table(spark, *BATCH), KEYS)) == want


def test_window_mode_drops_it(spark, rows):
    window = F.col("order_date") >= F.lit(day(2))
    got = u.upsert(table(spark, *TARGET), table(spark, *BATCH), KEYS, "window", window)
    assert rows(got) == rows(table(spark, (1, "a", 1), *BATCH))


def test_trailing_start(spark):
    def start(df, *args):
        return u.trailing_start(df, "order_date", 3, *args).first()[0]

    target = table(spark, *TARGET)
    assert start(target) == day(2)
    assert start(target, day(1)) == day(1)
    assert start(target, day(4)) == day(2)
    assert start(target.filter("false")) == dt.date(1899, 12, 29)


def test_trailing_batch(spark, rows):
    got = u.trailing_batch(table(spark, *BATCH, (1, "old", 1)), table(spark, *TARGET), "order_date", 3)
    assert rows(got) == rows(table(spark, *BATCH))


@pytest.mark.parametrize("change", [
    lambda df: df.withColumn("extra", F.lit(1)),
    lambda df: df.drop("units"),
    lambda df: df.withColumn("units", F.col("units").cast("string")),
])
def test_changed_columns_raise(spark, change):
    with pytest.raises(u.SchemaChange):
        u.upsert(table(spark, *TARGET), change(table(spark, *BATCH)), KEYS)


def test_days_are_replaced_in_place(spark, rows, tmp_path):
    path = str(tmp_path / "fact")
    write_days(table(spark, *TARGET), path, "order_date")
    for _ in range(2):
        target = spark.read.schema(SCHEMA).parquet(path)
        recent = target.filter(F.col("order_date") >= F.lit(day(2)))
        write_days(u.upsert(recent, table(spark, *BATCH), KEYS), path, "order_date")
    got = spark.read.schema(SCHEMA).parquet(path).select("order_date", "product_id", "units")
    assert rows(got) == rows(u.upsert(table(spark, *TARGET), table(spark, *BATCH), KEYS))
    drop_days(spark, path, "order_date", [day(2), day(9)])
    assert spark.read.schema(SCHEMA).parquet(path).count() == 2
