import datetime as dt
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom import functions as f


def evaluate(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("value, places, want", [
    (1.005, 2, 1.0), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.12345, 4, 0.1235), (60.05, 1, 60.1),
    (0.0, 4, 0.0)])
def test_round_half_away(spark, value, places, want):
    assert evaluate(spark, f.round_half_away(F.lit(value), places)) == want


def test_ratio_of_zero_is_null(spark):
    assert evaluate(spark, f.safe_ratio(F.lit(1), F.lit(0))) is None


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(min_size=1, max_size=12), min_size=1, max_size=20))
def test_bucket_is_the_md5_bucket(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r[0] for r in df.select(f.spread_bucket(F.col("k"), 1000)).collect()]
    assert got == [int(hashlib.md5(k.encode()).hexdigest()[:8], 16) % 1000 for k in keys]


@pytest.mark.parametrize("earlier, later, want", [
    ("10:59:59", "11:00:01", 1), ("10:00:00", "10:59:59", 0), ("08:30:00", "11:00:00", 3)])
def test_hours_are_boundaries_crossed(spark, earlier, later, want):
    a, b = (F.lit(f"2020-01-01 {t}") for t in (earlier, later))
    assert evaluate(spark, f.hours_between(a, b)) == want


@pytest.mark.parametrize("text, want", [("7", 7), ("4.7", 5), ("many", None), (None, None)])
def test_soft_whole_number(spark, text, want):
    assert evaluate(spark, f.parse_whole_number(F.lit(text).cast("string"))) == want


def test_hard_casts_raise(spark):
    for column in (f.whole_number(F.lit("many")), f.money(F.lit("dear")),
                   F.lit("soon").cast("timestamp_ntz")):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            evaluate(spark, column)


def test_money_is_exact_in_any_order(spark):
    df = spark.range(1000).select(f.money(F.lit("0.10")).alias("x"))
    assert float(df.repartition(7).agg(F.sum("x")).first()[0]) == 100.0


def test_parse_date(spark):
    assert evaluate(spark, f.parse_date(F.lit("2020-01-02 23:59:59"))) == dt.date(2020, 1, 2)
    assert evaluate(spark, f.parse_date(F.lit("soon"))) is None
