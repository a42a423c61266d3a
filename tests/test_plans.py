"""The physical plans the jobs rely on, and their behaviour under hot keys."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.dedup import latest_per_key, one_per_key
from shelfmark.operators.incremental import delta_since, upsert
from shelfmark.operators.quality import table_profile
from shelfmark.plans import staging, star
from shelfmark.sinks.files import write_parquet
from shelfmark.sources.files import read_parquet
from shelfmark.workload import inputs
from shelfmark.workload.queries import QUERIES


@pytest.fixture
def plan(capsys):
    def explain(df):
        capsys.readouterr()
        df.explain()
        return capsys.readouterr().out

    return explain


@pytest.fixture
def stored(spark, sf_dir, tmp_path):
    """The raw tables as Parquet, as landing leaves them."""
    for name, df in inputs.raw_tables(spark, sf_dir).items():
        write_parquet(df, str(tmp_path / name))
    return lambda name: read_parquet(spark, str(tmp_path / name))


def exchanges(text):
    return re.findall(r"Exchange (\w+)", text)


SIDE_EFFECTS = ("sink_", "src_csv", "land_", "api_", "schema_", "observed_", "dq_gate", "full_", "delivery_")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(SIDE_EFFECTS)))
def test_no_python_and_no_cartesian_product(spark, sf_dir, plan, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Generate explode"):
        assert bad not in text


def test_key_filters_and_columns_reach_the_scan(stored, plan):
    text = plan(staging.stage_customers(stored("customers")))
    assert "PushedFilters: [IsNotNull(customer_id)]" in text
    text = plan(staging.average_prices(stored("order_items")))
    assert "ReadSchema: struct<product_id:string,price:double>" in text


def test_profile_reads_only_the_key(stored, plan):
    text = plan(table_profile(stored("order_items"), "order_items", "order_id"))
    assert "ReadSchema: struct<order_id:string>" in text
    assert exchanges(text) == ["SinglePartition"]


def test_dedup_limits_groups_before_its_only_shuffle(stored, plan):
    text = plan(staging.stage_order_items(stored("order_items")))
    assert exchanges(text) == ["hashpartitioning"]
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_product_joins_add_no_shuffle(stored, plan, conf):
    conf(autoBroadcastJoinThreshold="-1")
    products = staging.stage_products(stored("products"), stored("order_items"))
    assert len(exchanges(plan(products))) == 2
    dim = star.dim_products(
        products,
        staging.stage_inventory(stored("inventory")),
        staging.stage_product_metadata(stored("product_metadata")),
    )
    assert len(exchanges(plan(dim))) == 4


def test_watermark_filter_reaches_the_scan(spark, sf_dir, plan):
    events = inputs.table(spark, sf_dir, "events")
    delta = delta_since(events, "ts", F.lit("2024-01-15").cast("timestamp_ntz"))
    assert "GreaterThan(ts" in plan(delta)


def test_small_delta_does_not_shuffle_the_snapshot(spark, tmp_path, plan):
    snapshot, delta = str(tmp_path / "snapshot"), str(tmp_path / "delta")
    table = spark.range(200_000).select(
        F.col("id").alias("k"), F.lit(1).alias("v"), F.lit("2024-01-01").cast("date").alias("d")
    )
    table.write.parquet(snapshot)
    table.limit(10).withColumn("d", F.lit("2024-01-02").cast("date")).write.parquet(delta)
    merged = upsert(spark.read.parquet(snapshot), spark.read.parquet(delta), ["k"], "d")
    text = plan(merged)
    first = text[text.index("LeftAnti"):text.index("LeftAnti") + 400]
    assert "BuildRight" in first and "SortMergeJoin" not in text
    for scan in re.finditer(r"Scan parquet.*snapshot", text):
        above = text[:scan.start()].splitlines()[-4:]
        assert not any("hashpartitioning" in line for line in above)
    assert merged.count() == 200_000


def test_large_delta_shuffles_whole_rows_of_the_snapshot_once(spark, sf_dir, plan, conf, tmp_path):
    conf(autoBroadcastJoinThreshold="-1")
    path = str(tmp_path / "snapshot")
    inputs.table(spark, sf_dir, "events").write.parquet(path)
    events = inputs.table(spark, sf_dir, "events")
    merged = upsert(spark.read.parquet(path), events, ["event_id"], "ts", one_row_per_key=True)
    text = plan(merged)
    assert "Broadcast" not in text and set(exchanges(text)) == {"hashpartitioning"}
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    # Whole rows of the snapshot and of the delta once each; else keys and versions.
    assert sorted(len(scan.split(",")) for scan in scans) == [2, 2, 2, 6, 6]


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    """A third of the rows share a key; each task sends at most one of them."""
    copies = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("version"),
    )
    kept = latest_per_key(copies, ["k"], "version")
    assert kept.filter("k = 'hot'").first().version == 89_997
    assert kept.count() == 60_001


@pytest.mark.parametrize("stored_lines", [True, False])
def test_many_lines_of_one_order_are_split_over_tasks(spark, conf, plan, tmp_path, stored_lines):
    """The final plan marks the join as skewed, and the result is whole."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="64k",
        shuffle__partitions="16",
        files__maxPartitionBytes="64k",
        files__openCostInBytes="0",
    )
    lines = spark.range(0, 120_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        F.lit("p").alias("product_id"), F.lit("s").alias("seller_id"),
        F.rand(1).alias("price"), F.rand(2).alias("freight_value"),
    )
    orders = lines.select("order_id").distinct().select(
        "order_id", F.lit("c").alias("customer_id"), F.lit("done").alias("order_status"),
        F.lit("2018-01-01 00:00:00").alias("order_purchase_timestamp"),
    )
    items, placed = str(tmp_path / "items"), str(tmp_path / "orders")
    write_parquet(staging.stage_orders(orders), placed)
    staged = staging.stage_order_items(lines)
    if stored_lines:
        write_parquet(staged, items)
        staged = read_parquet(spark, items)
    fact = star.fact_sales(staged, read_parquet(spark, placed))
    summed = fact.agg(F.count("sale_amount").alias("n"), F.max("status"), F.max("unit_price"))
    assert summed.collect()[0].n == 120_000
    assert "SortMergeJoin(skew=true)" in plan(summed)


def test_hot_month_is_written_by_several_tasks(spark, conf, tmp_path):
    conf(adaptive__advisoryPartitionSizeInBytes="64k")
    path = str(tmp_path / "fact")
    rows = spark.range(0, 200_000, 1, 8).withColumns(
        {
            "year": F.lit(2018),
            "month": F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 11 + 2).cast("int")),
        }
    )
    write_parquet(rows, path, partition_by=("year", "month"))
    files = {m: len(list(Path(path).glob(f"year=2018/month={m}/*.parquet"))) for m in range(1, 13)}
    assert files[1] > 2
    assert read_parquet(spark, path).count() == 200_000


def test_small_months_are_one_file_each(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.range(0, 10_000, 1, 8).withColumns(
        {"year": F.lit(2018), "month": (F.col("id") % 12 + 1).cast("int")}
    )
    write_parquet(rows, path, partition_by=("year", "month"))
    assert len(list(Path(path).glob("year=2018/month=*/*.parquet"))) == 12


def test_dedup_without_other_columns(spark):
    assert one_per_key(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"]).count() == 2
