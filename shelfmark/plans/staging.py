"""Raw tables to the seven cleaned staging tables.

Each function narrows its input to the columns it needs and drops rows without
a key before anything is shuffled, then keeps one row per key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import contact_email, exact_mean, parsed_date, product_label, text_key
from shelfmark.functions.cleaning import DATE_PATTERN, SIGNUP_DATE, TIMESTAMP_PATTERN
from shelfmark.operators.conform import rename_present
from shelfmark.operators.dedup import having_keys, one_per_key
from shelfmark.sources.files import CORRUPT, DELIVERED, SOURCE_FILE

_RANK = "__rank"


def delivery_columns(raw: DataFrame) -> list[str]:
    """The columns that order deliveries, where the landing noted them."""
    if DELIVERED not in raw.columns:
        return []
    return [name for name in (DELIVERED, SOURCE_FILE) if name in raw.columns]


def _newest(df: DataFrame, keys: list[str], *versions: str) -> DataFrame:
    """One row per key: the newest delivery where the landing noted it, then ``versions``."""
    newest = one_per_key(df, keys, newest=[*delivery_columns(df), *versions])
    return newest.drop(DELIVERED, SOURCE_FILE)


def newest_delivered(
    raw: DataFrame, *keys: str, each: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """All rows of the newest file that has a key, so copies within a file count.

    Rows of a key in older files are superseded. Rows without a key have nothing
    to supersede and stay, as does everything where no delivery is noted.

    ``each`` is done to the rows with all keys and to those without one apart: a
    window over ``keys`` then needs no shuffle after the one here.
    """
    versions = delivery_columns(raw)
    if not versions:
        return each(raw)
    order = [F.col(name).desc_nulls_last() for name in versions]
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(*order))
    newest = having_keys(raw, *keys).withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK)
    keyless = reduce(or_, [F.col(name).isNull() for name in keys])
    return each(newest).unionByName(each(raw.filter(keyless)))


def named_customers(raw: DataFrame) -> DataFrame:
    return having_keys(raw, "customer_id").select(
        text_key("customer_id").alias("customer_id"),
        F.col("customer_unique_id").alias("customer_name"),
        *delivery_columns(raw),
    )


def with_contact(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_name",
        contact_email("customer_name").alias("email"),
        F.lit(SIGNUP_DATE).cast("date").alias("signup_date"),
        *delivery_columns(customers),
    )


def stage_customers(raw: DataFrame) -> DataFrame:
    return with_contact(_newest(named_customers(raw), ["customer_id"]))


def average_prices(order_items: DataFrame) -> DataFrame:
    """The mean price of every product over all lines; of a line delivered again, the newest."""
    lines = newest_delivered(order_items, "order_id", "order_item_id")
    return lines.groupBy(text_key("product_id").alias("product_id")).agg(
        exact_mean("price").alias("price")
    )


def stage_products(raw: DataFrame, order_items: DataFrame) -> DataFrame:
    """Products with the average price they sold for; NULL when never sold.

    Pass the raw order items for an average over every line including repeated
    ones, which is what the star schema reports, or the staged ones to count
    each line once. Copies of a product are dropped before the join, and both
    sides are then spread by product_id, so the join adds no shuffle.
    """
    products = _newest(described_products(raw), ["product_id"])
    return with_prices(products, average_prices(order_items))


def described_products(raw: DataFrame) -> DataFrame:
    return having_keys(raw, "product_id").select(
        text_key("product_id").alias("product_id"),
        F.col("product_category_name").alias("category"),
        *delivery_columns(raw),
    )


def with_prices(products: DataFrame, prices: DataFrame) -> DataFrame:
    return products.join(prices, "product_id", "left").select(
        "product_id",
        product_label("category", "product_id").alias("product_name"),
        "category",
        "price",
        *delivery_columns(products),
    )


def dated_orders(raw: DataFrame) -> DataFrame:
    return having_keys(raw, "order_id").select(
        text_key("order_id").alias("order_id"),
        text_key("customer_id").alias("customer_id"),
        F.col("order_status").alias("status"),
        parsed_date(raw, "order_purchase_timestamp", TIMESTAMP_PATTERN).alias("order_date"),
        *delivery_columns(raw),
    )


def stage_orders(raw: DataFrame) -> DataFrame:
    """An unreadable purchase time gives a NULL order_date; the order is kept."""
    return _newest(dated_orders(raw), ["order_id"])


def typed_lines(raw: DataFrame) -> DataFrame:
    """Every raw line, also repeated ones and those without a key."""
    return raw.select(
        text_key("order_id").alias("order_id"),
        "order_item_id",
        text_key("product_id").alias("product_id"),
        text_key("seller_id").alias("seller_id"),
        "price",
        "freight_value",
        *delivery_columns(raw),
    )


def stage_order_items(raw: DataFrame) -> DataFrame:
    """One row per order line. Lines without an order id stay, for the gate to report."""
    lines = having_keys(typed_lines(raw), "order_item_id")
    return _newest(lines, ["order_id", "order_item_id"])


def stage_sellers(raw: DataFrame, filter_after: bool = False) -> DataFrame:
    """All source columns, one named row per seller.

    ``filter_after`` drops unnamed rows only after one row per seller was
    chosen, which loses a seller whose chosen row has no name.
    """
    keyed = having_keys(raw.drop(CORRUPT), "seller_id")
    if filter_after:
        return having_keys(_newest(keyed, ["seller_id"]), "seller_name")
    return _newest(having_keys(keyed, "seller_name"), ["seller_id"])


def stage_inventory(raw: DataFrame, filter_after: bool = False) -> DataFrame:
    """All source columns, the newest row with a stock per product; see ``stage_sellers``."""
    keyed = having_keys(raw.drop(CORRUPT), "product_id").withColumns(
        {
            "product_id": text_key("product_id"),
            "last_updated": parsed_date(raw, "last_updated", DATE_PATTERN),
        }
    )
    if filter_after:
        return having_keys(_newest(keyed, ["product_id"], "last_updated"), "stock_quantity")
    return _newest(having_keys(keyed, "stock_quantity"), ["product_id"], "last_updated")


def stage_product_metadata(raw: DataFrame) -> DataFrame:
    """All source columns under ``product_id``, one row per product."""
    named = having_keys(rename_present(raw.drop(CORRUPT), {"id": "product_id"}), "product_id")
    return _newest(named.withColumn("product_id", text_key("product_id")), ["product_id"])
