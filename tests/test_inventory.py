"""The ledger against a plain loop over products and days."""

import datetime as dt
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.params import Params
from ledgerloom.plans import inventory

D0 = dt.date(2020, 1, 1)
SCHEMA = ("order_date date, product_id string, category_pt string, category_en string, "
          "units_sold bigint, revenue decimal(28,2)")
PARAMS = Params()


def sales(n_products=12, n_days=40):
    rng = random.Random(7)
    made = {}
    for p in range(n_products):
        for d in range(n_days):
            if rng.random() < (p + 1) / (2 * n_products):
                made[f"p{p}", d] = rng.randint(1, 3 + p)
    made["rare", 17] = 1
    made["ends", 0] = 2
    made["ends", n_days - 1] = 40
    return made


def frame(spark, made):
    rows = [(D0 + dt.timedelta(days=d), p, f"c{p}", f"e{p}", n, n * 2) for (p, d), n in made.items()]
    return spark.createDataFrame(
        rows, SCHEMA.replace("decimal(28,2)", "int")).selectExpr(
        "* EXCEPT (revenue)", "CAST(revenue AS decimal(28,2)) AS revenue")


def half_away(x, places):
    return math.floor(abs(x) * 10**places + 0.5) / 10**places * (1 if x >= 0 else -1)


def expected(made):
    days = max(d for _, d in made) - min(d for _, d in made) + 1
    first = min(d for _, d in made)
    for p in {p for p, _ in made}:
        total = sum(n for (q, _), n in made.items() if q == p)
        demand = max(total / days, 0.1)
        factor = 0.2 + 1.8 * ((int(hashlib.md5(p.encode()).hexdigest()[:8], 16) % 1000) / 1000.0)
        opening = max(5, math.ceil(demand * 45.0 * factor))
        restock = max(1, math.ceil(demand * 21.0 * factor))
        cum = 0
        for d in range(first, first + days):
            units = made.get((p, d), 0)
            cum += units
            supply = opening + (d - first) // 14 * restock
            on_hand = supply - cum
            supplied = half_away(max(on_hand, 0) / demand, 1)
            yield (p, D0 + dt.timedelta(days=d), units, cum, opening, restock, supply, on_hand,
                   max(on_hand, 0), math.ceil(demand * 10.0), supplied, on_hand <= math.ceil(demand * 10.0),
                   on_hand <= 0, supplied > 60, half_away(cum / supply, 4))


COLUMNS = ["product_id", "inv_date", "units_sold", "cum_units", "opening_stock", "restock_qty",
           "total_supply", "on_hand", "on_hand_units", "reorder_point", "days_of_supply",
           "is_stockout_risk", "is_stockout", "is_overstock", "sell_through_rate"]


def test_ledger(spark, rows):
    made = sales()
    position = inventory.inventory_position(frame(spark, made), PARAMS)
    assert rows(position.select(*COLUMNS)) == sorted(expected(made), key=repr)


def test_closed_form_is_the_ledgers_last_day(spark, rows):
    daily = frame(spark, sales())
    from_ledger = inventory.inventory_health(inventory.inventory_position(daily, PARAMS))
    closed = inventory.inventory_health_closed(daily, PARAMS)
    assert rows(closed) == rows(from_ledger)
    assert len({r["inventory_status"] for r in closed.collect()}) >= 3


def test_two_categories_on_one_day_are_one_sale_day(spark):
    daily = frame(spark, sales())
    twice = daily.filter("product_id = 'p3'").withColumn("category_pt", F.lit("a")).unionByName(daily)
    ledger = inventory.inventory_position(twice, PARAMS)
    days = daily.select("order_date").agg(F.datediff(F.max("order_date"), F.min("order_date"))).first()[0] + 1
    assert ledger.filter("product_id = 'p3'").count() == days
    for column in ("units_sold", "revenue"):
        assert (ledger.agg(F.sum(column)).first()[0]
                == float(twice.agg(F.sum(column)).first()[0]))
    assert {r["category_pt"] for r in ledger.filter("product_id = 'p3'").collect()} == {"cp3"}
    closed = inventory.inventory_health_closed(twice, PARAMS)
    assert closed.count() == closed.select("product_id").distinct().count()


def test_categories_may_come_from_the_product_master(spark, rows):
    daily = frame(spark, sales())
    master = daily.select("product_id", "category_pt", "category_en").distinct().filter(
        "product_id <> 'rare'")
    closed = inventory.inventory_health_closed(daily.drop("category_pt", "category_en"), PARAMS, master)
    by_id = {r["product_id"]: r["category_en"] for r in closed.collect()}
    assert by_id["p3"] == "ep3" and by_id["rare"] == "unknown"
    dense = inventory.inventory_position(daily.drop("category_pt", "category_en"), PARAMS, master)
    assert dense.count() == inventory.inventory_position(daily, PARAMS).count()


def test_status_ladder(spark):
    flags = [(True, True, True, "STOCKOUT"), (False, True, True, "REORDER_NOW"),
             (False, False, True, "OVERSTOCK"), (False, False, False, "HEALTHY")]
    positions = spark.createDataFrame(
        [(str(i), "c", D0, 1, 1, 1.0, 0.5, *f[:3]) for i, f in enumerate(flags)],
        "product_id string, category_en string, inv_date date, on_hand_units bigint, "
        "reorder_point bigint, days_of_supply double, sell_through_rate double, "
        "is_stockout boolean, is_stockout_risk boolean, is_overstock boolean")
    got = {r["product_id"]: r["inventory_status"] for r in inventory.health(positions).collect()}
    assert [got[str(i)] for i in range(4)] == [f[3] for f in flags]


@pytest.mark.parametrize("days, want", [(1, 1), (3, 3)])
def test_spine(spark, days, want):
    daily = frame(spark, {("a", 0): 1, ("a", days - 1): 1})
    assert inventory.date_spine(daily).count() == want


def test_stock_is_worked_out_per_run_of_days_not_per_day(spark):
    """A product's md5 is read for runs between sales and restocks; days are made after that."""
    daily = frame(spark, {("a", 0): 1, ("a", 300): 1, ("b", 20): 2})
    plan = inventory.inventory_position(daily, PARAMS)._jdf.queryExecution().optimizedPlan().toString()
    days = plan.index("Generate explode(CASE WHEN (_from")
    assert "md5" in plan[days:] and "md5" not in plan[:days]


def test_ledger_of_sales_without_a_day_or_product(spark):
    """Sales without a day make the days up to the product's first dated sale, at their own units."""
    sold = spark.createDataFrame(
        [(None, "a", 3), (D0 + dt.timedelta(days=16), "a", 1), (D0, None, 2), (D0, "b", 1)],
        "order_date date, product_id string, units_sold bigint").selectExpr(
        "*", "CAST(units_sold AS decimal(28,2)) AS revenue")
    found = inventory.inventory_position(
        sold.selectExpr("*", "'c' AS category_pt", "'e' AS category_en"), PARAMS)
    a = [(r["inv_date"], r["units_sold"], r["cum_units"]) for r in
         found.filter("product_id = 'a'").collect()]
    undated = [(D0 + dt.timedelta(days=n), 0, 3) for n in range(16)]
    dated = [(D0 + dt.timedelta(days=n), int(n == 16), 4 * (n == 16)) for n in range(17)]
    assert sorted(a) == sorted(undated + dated)
    assert found.filter("product_id IS NULL").count() == found.filter("product_id = 'b'").count() == 17
