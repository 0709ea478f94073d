"""Typed, deduplicated models over the raw text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import money, parse_timestamp, parse_whole_number, whole_number
from ledgerloom.operators.dedup import latest_wins

# Tie-break columns after recency. The sales models read only the first ones, so those lead.
ORDER_TIES = ("order_purchase_timestamp", "order_status", "customer_id", "order_approved_at",
              "order_delivered_customer_date", "order_estimated_delivery_date")
ITEM_TIES = ("product_id", "price", "seller_id", "freight_value", "shipping_limit_date")
PRODUCT_TIES = ("product_category_name", "product_weight_g", "product_photos_qty")
CUSTOMER_TIES = ("customer_unique_id", "customer_state", "customer_city")
TRANSLATION_TIES = ("product_category_name_english",)

AUDIT = ("_ingest_date", "_loaded_at")


def _latest(raw: DataFrame, keys: tuple[str, ...], ties: tuple[str, ...]) -> DataFrame:
    return latest_wins(raw.select(*keys, *ties, *AUDIT), keys, ties)


def _order_columns() -> dict:
    purchased = F.col("order_purchase_timestamp").cast("timestamp_ntz")
    return {
        "order_status": F.lower("order_status"),
        "order_purchased_at": purchased,
        "order_date": purchased.cast("date"),
    }


def stg_orders(raw: DataFrame) -> DataFrame:
    typed = _order_columns()
    return _latest(raw, ("order_id",), ORDER_TIES).select(
        "order_id",
        "customer_id",
        *[expr.alias(name) for name, expr in typed.items()],
        parse_timestamp(F.col("order_approved_at")).alias("order_approved_at"),
        parse_timestamp(F.col("order_delivered_customer_date")).alias("order_delivered_at"),
        parse_timestamp(F.col("order_estimated_delivery_date")).alias("order_estimated_at"),
        F.col("_ingest_date").cast("date").alias("ingest_date"),
        parse_timestamp(F.col("_loaded_at")).alias("loaded_at"),
    )


def order_headers(raw: DataFrame) -> DataFrame:
    """What the sales models need of ``stg_orders``, from a narrower scan."""
    typed = _order_columns()
    return _latest(raw, ("order_id",), ORDER_TIES[:2]).select(
        "order_id", typed["order_status"].alias("order_status"),
        typed["order_date"].alias("order_date"))


def stg_order_items(raw: DataFrame) -> DataFrame:
    return _latest(raw, ("order_id", "order_item_id"), ITEM_TIES).select(
        "order_id",
        whole_number(F.col("order_item_id")).alias("order_item_id"),
        "product_id",
        "seller_id",
        parse_timestamp(F.col("shipping_limit_date")).alias("shipping_limit_at"),
        money(F.col("price")).alias("item_price"),
        money(F.col("freight_value")).alias("freight_value"),
        F.lit(1).alias("units"),
        F.col("_ingest_date").cast("date").alias("ingest_date"),
    )


def order_lines(raw: DataFrame) -> DataFrame:
    """What the sales models need of ``stg_order_items``, from a narrower scan."""
    return _latest(raw, ("order_id", "order_item_id"), ITEM_TIES[:2]).select(
        "order_id",
        whole_number(F.col("order_item_id")).alias("order_item_id"),
        "product_id",
        money(F.col("price")).alias("item_price"),
        F.lit(1).alias("units"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return _latest(raw, ("product_id",), PRODUCT_TIES).select(
        "product_id",
        F.nullif(F.col("product_category_name"), F.lit("")).alias("category_pt"),
        parse_whole_number(F.col("product_weight_g")).alias("product_weight_g"),
        parse_whole_number(F.col("product_photos_qty")).alias("product_photos_qty"),
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return _latest(raw, ("customer_id",), CUSTOMER_TIES).select(
        "customer_id",
        "customer_unique_id",
        F.upper("customer_state").alias("customer_state"),
        "customer_city",
    )


def stg_category_translation(raw: DataFrame) -> DataFrame:
    return _latest(raw, ("product_category_name",), TRANSLATION_TIES).select(
        F.col("product_category_name").alias("category_pt"),
        F.col("product_category_name_english").alias("category_en"),
    )
