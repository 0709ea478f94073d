"""A small set of source files for tests of whole runs."""

from __future__ import annotations

import csv
import datetime as dt
import pathlib

D0 = dt.date(2020, 3, 1)
DAYS = 10
CATEGORIES = {"cama_mesa_banho": "bed", "beleza_saude": "beauty", "sem_par": None}
STATUSES = ("delivered", "shipped", "canceled", "invoiced")


def day(n: int) -> dt.date:
    return D0 + dt.timedelta(days=n)


def tables() -> dict[str, list[dict]]:
    orders, items = [], []
    for d in range(DAYS):
        for k in range(4):
            order = f"o{d}_{k}"
            orders.append({
                "order_id": order, "customer_id": f"c{k}", "order_status": STATUSES[k],
                "order_purchase_timestamp": f"{day(d)} 0{k}:15:00", "order_approved_at": "",
                "order_delivered_carrier_date": "", "order_delivered_customer_date": "NA",
                "order_estimated_delivery_date": f"{day(d + 9)} 00:00:00"})
            for line in range(1 + (d + k) % 2):
                items.append({
                    "order_id": order, "order_item_id": line + 1, "product_id": f"p{(k + line) % 4}",
                    "seller_id": "s", "shipping_limit_date": "",
                    "price": f"{10 + d}.{k}5", "freight_value": "1.50"})
    categories = list(CATEGORIES)
    return {
        "orders": orders,
        "order_items": items,
        "products": [
            {"product_id": f"p{i}", "product_category_name": categories[i] if i < 3 else "",
             "product_weight_g": "100", "product_photos_qty": "2"} for i in range(4)],
        "customers": [
            {"customer_id": f"c{k}", "customer_unique_id": f"u{k}", "customer_state": "sp",
             "customer_city": "x"} for k in range(4)],
        "category_translation": [
            {"product_category_name": pt, "product_category_name_english": en}
            for pt, en in CATEGORIES.items() if en],
    }


FILES = {
    "orders": "shop_orders_dataset.csv",
    "order_items": "shop_order_items_dataset.csv",
    "products": "shop_products_dataset.csv",
    "customers": "shop_customers_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
}


def write(directory: pathlib.Path, made: dict[str, list[dict]]) -> str:
    directory.mkdir(parents=True, exist_ok=True)
    for table, rows in made.items():
        with open(directory / FILES[table], "w", newline="") as out:
            writer = csv.DictWriter(out, fieldnames=list(rows[0]))
            writer.writeheader()
            writer.writerows(rows)
    return str(directory)


class Clock:
    """A clock that moves one second per look."""

    def __init__(self, start: dt.datetime = dt.datetime(2020, 3, 12, 6, 17)):
        self.now = start

    def __call__(self) -> dt.datetime:
        self.now += dt.timedelta(seconds=1)
        return self.now


def expected_fact(made: dict[str, list[dict]], upto: int = DAYS) -> dict:
    """(day, product) -> (units, revenue) of realised sales, by a plain loop."""
    headers = {o["order_id"]: o for o in made["orders"]}
    fact: dict = {}
    for item in made["order_items"]:
        order = headers[item["order_id"]]
        bought = dt.date.fromisoformat(order["order_purchase_timestamp"][:10])
        if order["order_status"] != "canceled" and bought < day(upto):
            units, revenue = fact.get((bought, item["product_id"]), (0, 0.0))
            fact[bought, item["product_id"]] = (units + 1, round(revenue + float(item["price"]), 2))
    return fact
