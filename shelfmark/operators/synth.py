"""Source tables made from the sales files: named sellers and an inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import id_prefix

# Product limit, stock range, number of warehouses, stamp.
INVENTORY_PRODUCTS = 500
STOCK_FROM, STOCK_TO = 10, 500
WAREHOUSES = 5
INVENTORY_DATE = "2017-01-01"


def _draw(column: str, digits_from: int, span: int) -> Column:
    """A number in [0, span) that depends only on the id: re-run tasks draw the same."""
    digits = F.substring(F.md5(F.col(column)), digits_from, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(span))


def named_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        F.concat(F.lit("Seller_"), id_prefix("seller_id")).alias("seller_name"),
        "city",
        "state",
    )


def first_products(order_items: DataFrame, limit: int = INVENTORY_PRODUCTS) -> DataFrame:
    """The first distinct product ids in key order (rows of a table have no file order)."""
    ids = order_items.select("product_id").dropna().distinct()
    return ids.orderBy("product_id").limit(limit)


def drawn_inventory(order_items: DataFrame, limit: int | None = None) -> DataFrame:
    """A stock for every product sold, or for the first ``limit`` of them."""
    span = STOCK_TO - STOCK_FROM + 1
    every = order_items.select("product_id").dropna().distinct()
    products = every if limit is None else first_products(order_items, limit)
    return products.select(
        "product_id",
        (_draw("product_id", 1, span) + STOCK_FROM).cast("int").alias("stock_quantity"),
        F.concat(F.lit("WH"), (_draw("product_id", 9, WAREHOUSES) + 1).cast("string")).alias(
            "warehouse_location"
        ),
        F.lit(INVENTORY_DATE).cast("date").alias("last_updated"),
    )
