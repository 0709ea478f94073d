"""Models over tables that the test makes."""

import datetime as dt

from ledgerloom.catalog.queries import Models


def test_brand_sales_take_the_order_headers_at_hand(spark, tmp_path):
    """With headers given, the orders are not staged again: there is no orders table here."""
    day = dt.datetime(2020, 1, 1)
    for name, rows, schema in (
            ("part", [(1, "Brand#1", "PROMO", 3), (2, "Brand#2", "SMALL", 4)],
             "p_partkey bigint, p_brand string, p_type string, p_size int"),
            ("lineitem", [(7, 1, 9, 1, 10.0, 0.0, day), (7, 2, 9, 2, 5.0, 0.0, day),
                          (8, 1, 9, 1, 1.0, 0.0, day)],
             "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
             "l_extendedprice double, l_tax double, l_shipdate timestamp_ntz")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    headers = spark.createDataFrame([("7", "f", day.date()), ("8", "p", day.date())],
                                    "order_id string, order_status string, order_date date")
    found = Models(spark, str(tmp_path)).brand_daily(headers).collect()
    assert {(r["product_id"], r["units_sold"], float(r["revenue"])) for r in found} == {
        ("Brand#1", 1, 10.0), ("Brand#2", 1, 5.0)}
