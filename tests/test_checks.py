import datetime as dt

import pytest

from ledgerloom.operators import checks as c
from ledgerloom.operators.conform import MART_SCHEMAS, conform
from ledgerloom.operators.upsert import SchemaChange
from ledgerloom.params import Params
from ledgerloom.plans.marts import reconciliation, run_status, source_freshness
from ledgerloom.plans.model_checks import model_checks, parse_checks, raw_checks
from ledgerloom.sources.audit import AUDIT_SCHEMA


def outcome(models, *checks, warn_only=()):
    results = c.run_checks("t", models, list(checks), warn_only).collect()
    return {(r["column_name"], r["test"]): (r["failing_rows"], r["status"]) for r in results}


@pytest.fixture
def models(spark):
    child = [("a", 1.0, "x"), ("a", -1.0, "X"), ("b", None, None), (None, 5.0, "x"),
             (None, 7.0, "z"), ("b", 1.0, "x"), ("c", 2.0, "x")]
    return {
        "child": spark.createDataFrame(child, "key string, value double, word string"),
        "parent": spark.createDataFrame([("a",), ("c",)], "key string"),
    }


def test_failing_rows_of_each_kind(models):
    got = outcome(
        models,
        c.not_null("child", "key"), c.unique("child", "key"), c.unique("child", "key", "value"),
        c.in_set("child", "word", ["x"]), c.in_range("child", "value", 0, 5),
        c.references("child", "key", "parent", "key"), c.column_exists("child", "key"),
        c.column_exists("child", "lost"), c.min_rows("child", 7), c.min_rows("parent", 3))
    failing = {name: rows for name, (rows, _) in got.items()}
    assert failing == {
        ("key", "not_null"): 2, ("key", "unique"): 2, ("key,value", "unique_combination"): 0,
        ("word", "accepted_values"): 2, ("value", "accepted_range"): 2,
        ("key", "relationships"): 2, ("key", "column_exists"): 0, ("lost", "column_exists"): 1,
        ("*", "row_count"): 1,
    }
    assert all((rows > 0) == (status == "fail") for rows, status in got.values())


def test_null_is_part_of_a_combined_key(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", None)], "x string, y string")
    assert outcome({"m": df}, c.unique("m", "x", "y"))[("x,y", "unique_combination")][0] == 1


def test_text_ranges_are_lenient_and_parse_checks_are_not(spark):
    df = spark.createDataFrame([("1.5",), ("-2",), ("dear",), (None,)], "price string")
    got = outcome({"m": df}, c.in_range("m", "price", 0, 9, lenient=True),
                  c.parsable("m", "price", "decimal(18,2)"))
    assert [rows for rows, _ in got.values()] == [1, 1]


def test_empty_model_passes_all_but_the_row_count(spark):
    df = spark.createDataFrame([], "x string")
    got = outcome({"m": df}, c.not_null("m", "x"), c.unique("m", "x"), c.min_rows("m", 1))
    assert [rows for rows, _ in got.values()] == [0, 0, 1]


def test_verdict(models):
    good, bad = c.not_null("parent", "key"), c.not_null("child", "key")
    assert c.raise_on_failure(c.run_checks("t", models, [good])) == (1, 0)
    with pytest.raises(c.CheckFailure, match="child.key not_null: 2") as failure:
        c.raise_on_failure(c.run_checks("t", models, [good, bad]))
    assert (failure.value.passed, failure.value.failed) == (1, 1)
    lenient = c.run_checks("t", models, [good, bad], ["child.key.not_null"])
    assert c.raise_on_failure(lenient) == (1, 0)
    assert {tuple(r) for r in c.summary(lenient).collect()} == {("t", "pass", 1), ("t", "warn", 1)}


def test_number_of_checks():
    assert len(raw_checks(Params())) == 13
    assert len(parse_checks()) == 4
    kinds = [check.test for check in model_checks(Params())]
    assert {kind: kinds.count(kind) for kind in set(kinds)} == {
        "not_null": 20, "unique": 8, "unique_combination": 6, "accepted_range": 14,
        "accepted_values": 3, "relationships": 2, "row_count": 1}


def mart(spark, name, **changes):
    schema = ", ".join(f"{c} {t}" for c, t, _ in MART_SCHEMAS[name])
    values = {c: "p" if t == "string" else None for c, t, _ in MART_SCHEMAS[name]} | changes
    return spark.createDataFrame([tuple(values.values())], schema)


def test_conform(spark):
    good = mart(spark, "dim_product")
    assert conform(good.select(*reversed(good.columns)), "dim_product").columns == good.columns
    for wrong in (good.drop("category_en"), good.withColumnRenamed("cost_ratio", "ratio"),
                  good.selectExpr("* EXCEPT (cost_ratio)", "1 AS cost_ratio")):
        with pytest.raises(SchemaChange):
            conform(wrong, "dim_product")
    with pytest.raises(Exception, match="dim_product.product_id must not be null"):
        conform(mart(spark, "dim_product", product_id=None), "dim_product").collect()


NOW = dt.datetime(2020, 1, 10, 12, 0, 1)


def audit_row(finished, status, failed=0):
    return (f"r{finished}", finished, finished, "incremental", None, None, 10, 54, failed, status)


@pytest.mark.parametrize("rows, health, hours", [
    ([], "UNKNOWN", None),
    ([audit_row(dt.datetime(2020, 1, 1), "FAIL")], "UNKNOWN", None),
    ([audit_row(dt.datetime(2020, 1, 10, 10, 59, 59), "PASS"),
      audit_row(dt.datetime(2020, 1, 10, 11, 30), "FAIL", 3)], "PASSING", 2),
    ([audit_row(dt.datetime(2020, 1, 9, 12), "PASS", 1)], "FAILING", 24),
])
def test_run_status_is_one_row(spark, rows, health, hours):
    fact = spark.createDataFrame([(dt.date(2020, 1, 9),)], "order_date date")
    got = run_status(spark.createDataFrame(rows, AUDIT_SCHEMA), fact, NOW).collect()
    assert [(r["pipeline_health"], r["hours_since_refresh"]) for r in got] == [(health, hours)]
    assert got[0]["data_through_date"] == dt.date(2020, 1, 9)


@pytest.mark.parametrize("loaded, status", [
    ("2020-01-09 23:00:00", "pass"), ("2020-01-08 23:59:59", "warn"),
    ("2020-01-07 11:00:00", "error"), ("yesterday", "error")])
def test_freshness(spark, loaded, status):
    raw = spark.createDataFrame([(loaded,), (None,)], "_loaded_at string")
    assert source_freshness(raw, NOW, 36, 72).first()["status"] == status


def test_reconciliation_names_the_days_that_differ(spark):
    fact = spark.createDataFrame([(1, 2, 1.0), (2, 1, 5.0), (3, 1, 1.0)], "d int, units int, revenue double")
    daily = spark.createDataFrame([(1, 2, 1.0), (2, 1, 6.0), (4, 1, 1.0)], "d int, units_sold int, r double")
    day = "date_add(DATE '2020-01-01', d - 1) AS order_date"
    got = reconciliation(fact.selectExpr(day, "units", "revenue"),
                         daily.selectExpr(day, "units_sold", "CAST(r AS decimal(18,2)) AS revenue"))
    assert sorted(r["order_date"].day for r in got.collect()) == [2, 3, 4]
