"""The test tables as the raw tables of the retail jobs (see FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Values nulled so that staging meets missing categories, stocks and ids.
UNCATEGORIZED_TYPE = "PROMO"
UNCOUNTED_SIZE = 50
UNLISTED_BRAND = "Brand#25"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _key(column: str, name: str):
    return F.col(column).cast("string").alias(name)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _key("c_custkey", "customer_id"), F.col("c_name").alias("customer_unique_id")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _key("p_partkey", "product_id"),
        F.nullif("p_type", F.lit(UNCATEGORIZED_TYPE)).alias("product_category_name"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _key("o_orderkey", "order_id"),
        _key("o_custkey", "customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _key("l_orderkey", "order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _key("l_partkey", "product_id"),
        _key("l_suppkey", "seller_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _key("s_suppkey", "seller_id"),
            F.col("s_name").alias("seller_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
        )
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        _key("p_partkey", "product_id"),
        (F.nullif("p_size", F.lit(UNCOUNTED_SIZE)) - 1).alias("stock_quantity"),
        F.concat(F.lit("WH"), (part % 5 + 1).cast("string")).alias("warehouse_location"),
        F.date_add(F.lit("2017-01-01").cast("date"), (part % 10).cast("int")).alias(
            "last_updated"
        ),
    )


def product_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id stays a number, as the product service sends it."""
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_brand") != UNLISTED_BRAND, F.col("p_partkey")).alias("id"),
        F.col("p_brand").alias("brand"),
        (F.col("p_size") / F.lit(10.0)).alias("rating"),
        F.col("p_size").alias("stock"),
        F.lower("p_type").alias("category"),
    )


RAW_TABLES = {
    read.__name__: read
    for read in (customers, products, orders, order_items, sellers, inventory, product_metadata)
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return RAW_TABLES[name](spark, sf_dir)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: read(spark, sf_dir) for name, read in RAW_TABLES.items()}
