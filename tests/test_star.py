"""The star schema on small tables (FIXTURES.md E9-E12)."""

import datetime
from functools import partial

from pyspark.sql import functions as F

from shelfmark.plans import star
from shelfmark.plans.refresh import staged_table, star_table
from shelfmark.schemas import STAGING, STAR
from shelfmark.workload import inputs

DAY = datetime.date


def staged(spark, name, rows):
    return spark.createDataFrame(rows, STAGING[name])


def products(spark, *ids):
    return staged(spark, "products", [(i, f"toys_{i}", "toys", 1.5) for i in ids])


def test_stock_status_boundaries(spark, rows):
    stocks = {"a": 0, "b": 19, "c": 20, "d": -1, "e": 500}
    inventory = staged(spark, "inventory", [(k, v, "WH1", None) for k, v in stocks.items()])
    dim = star.dim_products(
        products(spark, "a", "b", "c", "d", "e", "none"), inventory,
        staged(spark, "product_metadata", []),
    )
    assert dict(rows(dim, "product_id", "stock_status")) == {
        "a": "OUT_OF_STOCK", "b": "LOW_STOCK", "c": "IN_STOCK", "d": "LOW_STOCK",
        "e": "IN_STOCK", "none": "UNKNOWN",
    }


def test_numeric_metadata_ids_join_text_product_ids(spark, rows):
    metadata = spark.createDataFrame(
        [(7, "Acme", 4.5, 3, "toy"), (8, "Other", 1.0, 1, "x")],
        "product_id int, brand string, rating double, stock int, category string",
    )
    dim = star.dim_products(
        products(spark, "7", "9f86d081"), staged(spark, "inventory", []), metadata
    )
    assert rows(dim, "product_id", "brand", "rating", "api_stock", "api_category") == [
        ("7", "Acme", 4.5, 3, "toy"), ("9f86d081", None, None, None, None),
    ]


def test_absent_metadata_columns_fall_back_to_the_product(spark, rows):
    ids = spark.createDataFrame([("7",)], "product_id string")
    inventory = staged(spark, "inventory", [("7", 3, "WH1", DAY(2017, 1, 1))])
    dim = star.dim_products(products(spark, "7", "9f86d081"), inventory, ids)
    assert rows(dim, "product_id", "brand", "rating", "api_stock", "api_category") == [
        ("7", "7", 7.0, 3, "toys"), ("9f86d081", "9f86d081", None, None, "toys"),
    ]


def test_fact_drops_lines_without_an_order(spark, rows):
    items = staged(
        spark, "order_items",
        [("o1", 3, "p", "s", 2.5, 0.5), ("gone", 1, "p", "s", 1.0, 0.0),
         (None, 1, "p", "s", 1.0, 0.0), ("o2", 1, "p", "s", None, None)],
    )
    orders = staged(
        spark, "orders", [("o1", "c", "done", DAY(2018, 2, 3)), ("o2", "c", "done", None)]
    )
    assert rows(star.fact_sales(items, orders)) == [
        ("o1", "p", "c", 3, DAY(2018, 2, 3), "done", 2.5, 0.5, 7.5, 2018, 2),
        ("o2", "p", "c", 1, None, "done", None, None, None, None, None),
    ]


def test_star_columns(spark):
    empty = {name: spark.createDataFrame([], schema) for name, schema in STAGING.items()}
    for name in STAR:
        df = star_table(name, empty.__getitem__)
        assert df.columns == STAR[name].names
        assert dict(df.dtypes) == {f.name: f.dataType.simpleString() for f in STAR[name]}


def test_dimensions_are_unique_and_complete(spark, sf_dir):
    raw = partial(inputs.raw_table, spark, sf_dir)
    staged_all = {name: staged_table(name, raw) for name in STAGING}
    tables = {name: star_table(name, staged_all.__getitem__) for name in STAR}
    for name, key in (
        ("dim_customers", "customer_id"), ("dim_sellers", "seller_id"), ("dim_products", "product_id")
    ):
        counted = tables[name].agg(F.count(key).alias("n"), F.countDistinct(key).alias("d")).first()
        assert counted.n == counted.d > 0
    assert tables["dim_products"].count() == staged_all["products"].count()
    lines = staged_all["order_items"].join(staged_all["orders"], "order_id", "left_semi")
    assert tables["fact_sales"].count() == lines.count()
