"""Staging tables to three dimensions and the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import lenient_double, sale_amount, stock_status, text_key
from shelfmark.operators.conform import rename_present, select_present

# What the product service may tell of a product.
METADATA_COLUMNS = ("product_id", "brand", "rating", "stock", "category")


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_name", "email", "signup_date")


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "seller_name", "city", "state")


def conformed_metadata(metadata: DataFrame) -> DataFrame:
    """The metadata columns a product dimension uses, as far as the source has them."""
    return rename_present(
        select_present(metadata, METADATA_COLUMNS), {"stock": "api_stock", "category": "api_category"}
    )


def dim_products(products: DataFrame, inventory: DataFrame, metadata: DataFrame) -> DataFrame:
    """Every product with its stock and service metadata, where known.

    All three tables hold one row per product and join on the key as text, so
    the row count is that of ``products`` and no key is hot. Metadata columns
    the source lacks fall back to the product's own values; the schema decides
    that when the plan is built.
    """
    extra = conformed_metadata(metadata)
    fallback = {
        "brand": text_key("product_id"),
        "rating": lenient_double("product_id"),
        "api_stock": F.col("stock_quantity"),
        "api_category": F.col("category"),
    }
    stock = inventory.select(
        text_key("product_id").alias("product_id"),
        "stock_quantity",
        "warehouse_location",
        "last_updated",
    )
    return (
        products.withColumn("product_id", text_key("product_id"))
        .join(stock, "product_id", "left")
        .join(extra.withColumn("product_id", text_key("product_id")), "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "category",
            "price",
            "stock_quantity",
            "warehouse_location",
            "last_updated",
            *[
                (F.col(name) if name in extra.columns else instead).alias(name)
                for name, instead in fallback.items()
            ],
            stock_status("stock_quantity").alias("stock_status"),
        )
    )


def fact_sales(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order line that has an order.

    Meant for stored orders, as ``build_star`` passes them. Both sides are then
    shuffled by the join itself, and AQE splits the partition of an order with
    very many lines; orders that come straight out of their own dedup keep its
    partitioning, and the lines joined to that cannot be split.
    """
    placed = orders.select("order_id", "customer_id", "order_date", "status")
    return order_items.join(placed, "order_id", "inner").select(
        "order_id",
        "product_id",
        "customer_id",
        F.col("order_item_id").alias("quantity"),
        "order_date",
        "status",
        F.col("price").alias("unit_price"),
        "freight_value",
        sale_amount("order_item_id", "price").alias("sale_amount"),
        F.year("order_date").alias("year"),
        F.month("order_date").alias("month"),
    )


def fact_sales_by_seller(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """The sales fact with the seller of each line, so that ``dim_sellers`` joins to it."""
    placed = orders.select("order_id", "customer_id", "order_date", "status")
    return order_items.join(placed, "order_id", "inner").select(
        "order_id",
        "order_item_id",
        "seller_id",
        "product_id",
        "customer_id",
        "order_date",
        "status",
        F.col("price").alias("unit_price"),
        "freight_value",
    )


def fact_line_revenue(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue next to the ``sale_amount`` of the schema, which takes a line's number as its quantity.

    Every line is one unit sold at its price: ``line_revenue`` is the price and
    ``units`` is one.
    """
    return fact_sales(order_items, orders).select(
        "order_id",
        F.col("quantity").alias("order_item_id"),
        "product_id",
        "order_date",
        "sale_amount",
        F.lit(1).alias("units"),
        F.col("unit_price").alias("line_revenue"),
    )
