"""Staging tables laid out so that their joins need no shuffle.

Orders and lines are bucketed and sorted by order, products and prices by
product, once, when they are written. Every join on these keys then reads bucket
by bucket. A bucket is read by one task and can't be split, so rows of keys with
very many rows stay outside the buckets, in a folder that is written by many
tasks and joined to the few matching rows of the other table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.plans import staging, star
from shelfmark.sinks.files import write_parquet

# Rows of one key from which on they stay outside the buckets.
HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class Bucketed:
    """A table in buckets by ``key``, and below another folder the rows of hot keys, if there are any."""

    table: str
    path: str
    key: str
    hot: bool

    def cold_rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.table(self.table)

    def hot_rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/hot")


def write_bucketed(
    df: DataFrame, table: str, path: str, key: str, buckets: int, hot_rows: int = HOT_ROWS
) -> Bucketed:
    """Write ``df`` in buckets, one sorted file each, and the rows of hot keys apart.

    ``table`` is the name under which the session's catalog knows the buckets. Rows
    without a key are in the bucket of NULL unless these, too, are many.
    """
    spark = df.sparkSession
    write_parquet(df.groupBy(key).count().where(F.col("count") > hot_rows).select(key), f"{path}/hot_keys")
    hot_keys = spark.read.parquet(f"{path}/hot_keys")
    hot = not hot_keys.isEmpty()
    cold = df
    if hot:
        named = hot_keys.withColumnRenamed(key, "__hot")
        among = F.col(key).eqNullSafe(F.col("__hot"))
        write_parquet(df.join(F.broadcast(named), among, "left_semi").hint("rebalance"), f"{path}/hot")
        cold = df.join(F.broadcast(named), among, "left_anti")
    writer = cold.repartition(buckets, key).write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, key).sortBy(key).option("path", f"{path}/buckets").saveAsTable(table)
    return Bucketed(table, path, key, hot)


def register(spark: SparkSession, table: str, path: str, key: str, buckets: int, schema: str) -> Bucketed:
    """Make buckets that another application wrote known to this session."""
    spark.sql(
        f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {buckets} BUCKETS LOCATION '{path}/buckets'"
    )
    hot = not spark.read.parquet(f"{path}/hot_keys").isEmpty()
    return Bucketed(table, path, key, hot)


def colocated_fact(spark: SparkSession, lines: Bucketed, orders: Bucketed) -> DataFrame:
    """``fact_sales`` of bucketed lines and orders. An order is one row, so only lines have hot keys."""
    placed = orders.cold_rows(spark)
    fact = star.fact_sales(lines.cold_rows(spark), placed)
    if not lines.hot:
        return fact
    hot_lines = lines.hot_rows(spark)
    hot_keys = spark.read.parquet(f"{lines.path}/hot_keys")
    few = placed.join(hot_keys, lines.key, "left_semi")
    return fact.unionByName(star.fact_sales(hot_lines, few))


def colocated_products(spark: SparkSession, products: Bucketed, prices: Bucketed) -> DataFrame:
    """Staged products from described products and mean prices, both in buckets by product."""
    return staging.with_prices(products.cold_rows(spark), prices.cold_rows(spark))
