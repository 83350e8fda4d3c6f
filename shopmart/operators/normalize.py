"""Split the wide raw table into the seven core tables (K2–K8).

Each function takes the raw frame (after ``fill_defaults``) and returns one
core table in contract column order.  Reading parquet, each table scans
only its own columns, so seven tables cost about one pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shopmart.contracts import ORDER_ITEMS, ORDERS
from shopmart.functions.text import address_part
from shopmart.operators.cleaning import dedupe_by_key, require

ORDER_COLUMNS = tuple(c for c in ORDERS.names if c != "delivery_city")
ORDER_ITEM_COLUMNS = tuple(c for c in ORDER_ITEMS.names if c != "order_item_sk")


def users(raw: DataFrame) -> DataFrame:
    return dedupe_by_key(require(raw.select("user_id", "user_phone"), ["user_id"]), ["user_id"])


def stores(raw: DataFrame) -> DataFrame:
    """Stores, with ``store_city`` = trimmed second comma part of the address."""
    df = require(raw.select("store_id", "store_address"), ["store_id"])
    df = df.withColumn("store_city", address_part("store_address", 1))
    return dedupe_by_key(df, ["store_id"])


def drivers(raw: DataFrame) -> DataFrame:
    return dedupe_by_key(require(raw.select("driver_id", "driver_phone"), ["driver_id"]),
                         ["driver_id"])


def items(raw: DataFrame) -> DataFrame:
    """Items; a row without a title is not an item."""
    df = require(raw.select("item_id", "item_title", "item_category"), ["item_id", "item_title"])
    return dedupe_by_key(df, ["item_id"])


def orders(raw: DataFrame) -> DataFrame:
    """Orders with a user, ``delivery_city`` = trimmed first comma part of the address."""
    df = raw.select(*ORDER_COLUMNS).withColumn("delivery_city", address_part("address_text", 0))
    df = require(df, ["order_id", "user_id"])
    df = dedupe_by_key(df, ["order_id"])
    return df.select(*ORDERS.names)


def order_items(raw: DataFrame, line_key: list[str] | None = None) -> DataFrame:
    """Order lines with order, item, quantity and price.

    Lines are not de-duplicated (a raw row per courier repeats its line);
    pass ``line_key`` to keep one line per key instead.
    """
    df = require(raw.select(*ORDER_ITEM_COLUMNS),
                 ["order_id", "item_id", "item_quantity", "item_price"])
    if line_key:
        df = dedupe_by_key(df, line_key)
    return df.select(*ORDER_ITEM_COLUMNS)


def order_drivers(raw: DataFrame) -> DataFrame:
    """Distinct (order, courier) pairs."""
    return require(raw.select("order_id", "driver_id"), ["order_id", "driver_id"]).distinct()


# What each table reads of the raw frame, and those that keep a raw row's copies.
RAW_COLUMNS = {
    "users": ("user_id", "user_phone"), "stores": ("store_id", "store_address"),
    "drivers": ("driver_id", "driver_phone"), "items": ("item_id", "item_title", "item_category"),
    "orders": ORDER_COLUMNS, "order_items": ORDER_ITEM_COLUMNS, "order_drivers": ("order_id", "driver_id"),
}
KEEPS_COPIES = frozenset({"order_items"})

CORE_BUILDERS = {
    "users": users, "stores": stores, "drivers": drivers, "items": items,
    "orders": orders, "order_items": order_items, "order_drivers": order_drivers,
}
