"""The test tables in the shape of the raw tables, so the same plans run on them.

Every raw column is text, as it would be after landing. Orders appear once per re-scan day, and
the first two snapshots show them as still pending, so that keeping the latest one matters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.params import Params

PARAMS = Params(
    accepted_statuses=("F", "O", "P"),
    valid_statuses=("f", "o"),
    cost_ratios={"ECONOMY": "0.58", "LARGE": "0.45", "MEDIUM": "0.62", "PROMO": "0.74",
                 "SMALL": "0.55"},
)

# Fixed times in place of the clock.
AS_OF = dt.datetime(2001, 8, 6, 12, 30)
LOADED_AT = "2001-08-06 06:17:00"

STAMPS = ("ingest_date", "string(ingest_date) AS _ingest_date",
          "string(ingest_date) || ' 06:17:00' AS _loaded_at")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a source file would deliver them, one row each."""
    return table(spark, sf_dir, "orders").selectExpr(
        "string(o_orderkey) AS order_id",
        "string(o_custkey) AS customer_id",
        "o_orderstatus AS order_status",
        "string(o_orderdate) AS order_purchase_timestamp",
        "CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '5-LOW' THEN 'n/a' "
        "ELSE string(o_orderdate) END AS order_approved_at",
        "CASE WHEN o_orderstatus = 'F' THEN string(o_orderdate + INTERVAL 7 DAYS) END "
        "AS order_delivered_customer_date",
        "string(o_orderdate + INTERVAL 14 DAYS) AS order_estimated_delivery_date",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the lake: a snapshot on the day itself and on each of the three days after."""
    aged = source_orders(spark, sf_dir).selectExpr("*", "explode(sequence(0, 3)) AS _age")
    return aged.selectExpr(
        "* EXCEPT (order_status, _age)",
        "IF(_age < 2, 'P', order_status) AS order_status",
        "date_add(date(order_purchase_timestamp), _age) AS ingest_date",
    ).selectExpr("* EXCEPT (ingest_date)", *STAMPS)


def _raw_items(lineitem: DataFrame, product_id: str) -> DataFrame:
    return lineitem.selectExpr(
        "string(l_orderkey) AS order_id",
        "string(l_linenumber) AS order_item_id",
        f"{product_id} AS product_id",
        "string(l_suppkey) AS seller_id",
        "string(CAST(l_extendedprice AS decimal(18,2))) AS price",
        "string(CAST(round(CAST(l_extendedprice AS decimal(18,2)) "
        "* CAST(l_tax AS decimal(4,2)), 2) AS decimal(18,2))) AS freight_value",
        "string(l_shipdate) AS shipping_limit_date",
        "date(l_shipdate) AS ingest_date",
        "string(date(l_shipdate)) AS _ingest_date",
        "string(l_shipdate) AS _loaded_at",
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in the lake. Line keys repeat, and the one shipped last is the newest."""
    return _raw_items(table(spark, sf_dir, "lineitem"), "string(l_partkey)")


def raw_brand_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose product is the brand, for a ledger of few, fast-selling products."""
    part = table(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_brand")
    return _raw_items(table(spark, sf_dir, "lineitem").join(part, "l_partkey"), "p_brand")


def _snapshots(df: DataFrame) -> DataFrame:
    """Two daily dimension snapshots, ``_age`` 0 and 1."""
    days = "explode(array(DATE '2001-08-04', DATE '2001-08-05')) AS ingest_date"
    return df.selectExpr("*", days).selectExpr(
        "*", *STAMPS[1:], "datediff(ingest_date, DATE '2001-08-04') AS _age")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products; the older snapshot has another category, size 13 has a blank one."""
    return _snapshots(table(spark, sf_dir, "part")).selectExpr(
        "string(p_partkey) AS product_id",
        "CASE WHEN _age = 0 THEN 'UNSORTED' WHEN p_size = 13 THEN '' ELSE p_type END "
        "AS product_category_name",
        "string(p_size) AS product_weight_g",
        "IF(p_brand = 'Brand#1', 'many', string(p_size)) AS product_photos_qty",
        "ingest_date", "_ingest_date", "_loaded_at",
    )


def raw_brand_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.expr("min(p_type) AS product_category_name"))
    return _snapshots(brands).selectExpr(
        "p_brand AS product_id", "product_category_name",
        "string(NULL) AS product_weight_g", "string(NULL) AS product_photos_qty",
        "ingest_date", "_ingest_date", "_loaded_at",
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer").join(nation, "c_nationkey")
    return _snapshots(customer).selectExpr(
        "string(c_custkey) AS customer_id",
        "c_name AS customer_unique_id",
        "IF(_age = 0, 'moved', lower(n_name)) AS customer_state",
        "c_mktsegment AS customer_city",
        "ingest_date", "_ingest_date", "_loaded_at",
    )


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lower-case word per category; STANDARD has no translation."""
    categories = table(spark, sf_dir, "part").where("p_type <> 'STANDARD'")
    return _snapshots(categories.select("p_type").distinct()).selectExpr(
        "p_type AS product_category_name",
        "IF(_age = 0, 'draft', lower(p_type)) AS product_category_name_english",
        "ingest_date", "_ingest_date", "_loaded_at",
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": raw_orders(spark, sf_dir),
        "order_items": raw_order_items(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "customers": raw_customers(spark, sf_dir),
        "category_translation": raw_category_translation(spark, sf_dir),
    }


def audit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run history derived from the orders: one run per business day, up to the last month.

    A run failed where more than half of the day's orders are pending, Sunday runs are
    backfills, and urgent orders beyond half of the day count as failed tests.
    """
    orders = table(spark, sf_dir, "orders")
    newest = orders.agg(F.expr("max(date(o_orderdate))")).scalar()
    daily = (
        orders.where(F.expr("date(o_orderdate)") <= F.date_sub(newest, 30))
        .groupBy(F.expr("date(o_orderdate) AS window_start"))
        .agg(
            F.expr("count(1) AS rows_extracted"),
            F.expr("count_if(o_orderstatus = 'P') AS _pending"),
            F.expr("count_if(o_orderpriority = '1-URGENT') AS _urgent"),
        )
    )
    started = "CAST(window_start AS timestamp_ntz) + INTERVAL '1 06:17' DAY TO MINUTE"
    failed = "int(greatest(_urgent * 2 - rows_extracted, 0))"
    return daily.selectExpr(
        "'run-' || string(window_start) AS run_id",
        f"{started} AS run_started_at",
        f"{started} + INTERVAL 9 MINUTES AS run_finished_at",
        "IF(dayofweek(window_start) = 1, 'backfill', 'incremental') AS mode",
        "window_start",
        "window_start AS window_end",
        "rows_extracted",
        f"54 - {failed} AS tests_passed",
        f"{failed} AS tests_failed",
        "IF(_pending * 2 > rows_extracted, 'FAIL', 'PASS') AS status",
    )
