"""Joins of bucketed staging tables move no rows."""

import uuid

import pytest
from pyspark.sql import functions as F

from shelfmark.plans import star
from shelfmark.plans.colocated import colocated_fact, colocated_products, register, write_bucketed
from shelfmark.schemas import STAGING


@pytest.fixture
def bucketed(spark, tmp_path):
    names = []

    def write(df, key, **options):
        names.append(f"t_{uuid.uuid4().hex}")
        return write_bucketed(df, names[-1], str(tmp_path / names[-1]), key, 4, **options)

    yield write
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture
def sales(spark):
    orders = spark.range(300).selectExpr(
        "cast(id as string) order_id", "'c' customer_id", "'s' status", "date_add(date'2018-01-01', cast(id as int)) order_date"
    )
    lines = spark.range(3000).selectExpr(
        "if(id % 3 = 0, '7', cast(id % 400 as string)) order_id", "cast(id as int) order_item_id", "'p' product_id",
        "'s' seller_id", "1.5D price", "0.5D freight_value",
    )
    return lines, orders


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_fact_joins_without_an_exchange(spark, conf, bucketed, sales, rows):
    conf(autoBroadcastJoinThreshold="-1")
    lines, orders = sales
    fact = colocated_fact(spark, bucketed(lines, "order_id"), bucketed(orders, "order_id"))
    assert "Exchange" not in plan_of(fact) and "SortMergeJoin" in plan_of(fact)
    assert rows(fact) == rows(star.fact_sales(lines, orders))
    assert fact.count() > 1500


def test_a_hot_order_stays_outside_the_buckets(spark, bucketed, sales, rows):
    lines, orders = sales
    held = bucketed(lines, "order_id", hot_rows=500)
    assert held.hot and held.cold_rows(spark).where("order_id = '7'").count() == 0
    assert held.hot_rows(spark).count() == lines.where("order_id = '7'").count() >= 1000
    fact = colocated_fact(spark, held, bucketed(orders, "order_id"))
    assert rows(fact) == rows(star.fact_sales(lines, orders))


def test_lines_without_an_order(spark, bucketed, sales, rows):
    lines, orders = sales
    lines = lines.withColumn("order_id", F.when(F.col("order_item_id") % 2 == 0, F.col("order_id")))
    for hot_rows in (10_000, 100):
        held = bucketed(lines, "order_id", hot_rows=hot_rows)
        fact = colocated_fact(spark, held, bucketed(orders, "order_id"))
        assert rows(fact) == rows(star.fact_sales(lines, orders))
        stored = held.cold_rows(spark).count() + (held.hot_rows(spark).count() if held.hot else 0)
        assert stored == 3000


def test_products_and_prices(spark, conf, bucketed, rows):
    conf(autoBroadcastJoinThreshold="-1")
    products = spark.range(50).selectExpr("cast(id as string) product_id", "if(id % 5 = 0, null, 'toys') category")
    prices = spark.range(40).selectExpr("cast(id * 2 as string) product_id", "id + 0.5D price")
    staged = colocated_products(spark, bucketed(products, "product_id"), bucketed(prices, "product_id"))
    assert "Exchange" not in plan_of(staged)
    assert rows(staged, "product_id", "price")[:2] == [("0", 0.5), ("1", None)]
    assert staged.count() == 50 and [f.name for f in staged.schema] == STAGING["products"].names


def test_buckets_of_another_application(spark, conf, bucketed, sales, rows):
    conf(autoBroadcastJoinThreshold="-1")
    lines, orders = sales
    written = [bucketed(lines, "order_id"), bucketed(orders, "order_id")]
    known = []
    for held, df in zip(written, sales):
        schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
        spark.sql(f"DROP TABLE {held.table}")  # as if this session had never heard of it; the files stay
        known.append(register(spark, held.table, held.path, "order_id", 4, schema))
    fact = colocated_fact(spark, *known)
    assert "Exchange" not in plan_of(fact)
    assert rows(fact) == rows(star.fact_sales(lines, orders))
