"""One query per operator, each over whole test tables.

The JDBC reader and writer have no entry: they need a database that every
executor can reach.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StructType

from shelfmark.functions import (
    id_prefix,
    lenient_double,
    parsed_date,
    product_label,
    text_key,
)
from shelfmark.functions import stock_status as status_of
from shelfmark.functions.cleaning import DATE_PATTERN, TIMESTAMP_PATTERN
from shelfmark.operators import conform, incremental, profiles, quality, snapshots, synth, widening
from shelfmark.operators.dedup import having_keys, latest_per_key, one_per_key
from shelfmark.plans import colocated, delivery, history, refresh, staging, star
from shelfmark.plans.refresh import staged_table, star_table
from shelfmark.schemas import RAW
from shelfmark.session import scratch_dir
from shelfmark.sinks.files import write_csv, write_parquet
from shelfmark.sources.files import (
    CORRUPT,
    SOURCE_FILE,
    bad_record_count,
    data_columns,
    inferred_csv,
    read_csv,
    read_parquet,
    read_text_csv,
)
from shelfmark.sources.multiline import read_multiline_csv
from shelfmark.sources.payloads import read_payloads
from shelfmark.sources.types import type_versions, widen_types
from shelfmark.streaming.landing import land_csv
from shelfmark.workload import inputs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

WATERMARK = "2024-01-15"
LAST_DAYS = "2024-01-29"
LATER_THAN_ALL = "2100-01-01"
NEVER_LOADED = "returns"
# The order lines that get an unreadable number and an unreadable price.
DIRTY_LINE, DIRTY_PRICE = 7, 3

# What the second delivery changes, by order and customer numbers.
MOVED, UNDATED, LATE, RENAMED, MOVED_DAYS = 7, 8, 1, 3, 40

# Between two snapshots of the sellers.
NEW_STATE, LOST_STATE, MOVED_STATE = "EUROPE", "ASIA", "AMERICA"
SNAPSHOT_DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")
BUCKETS = 8

# The columns of order lines that are profiled, and the return flag that counts as missing there.
PROFILED = ["l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"]
UNFLAGGED = "R"

# For each raw table a column and a value that counts as missing there.
MISSING_VALUES = (
    ("customers", "customer_unique_id", "Customer#000000000"),
    ("products", "product_category_name", ""),
    ("orders", "order_status", "P"),
    ("order_items", "order_item_id", 1),
    ("sellers", "state", "ASIA"),
    ("inventory", "stock_quantity", 0),
    ("product_metadata", "id", 0),
)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _clock_text(column: str, pattern: str):
    """The time as text in no time zone; both patterns are prefixes of Spark's own form."""
    return F.substring(F.col(column).cast("string"), 1, len(pattern))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events")


def _staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return staged_table(name, partial(inputs.raw_table, spark, sf_dir))


def _stored(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """The table after it was written, as jobs hand tables to each other."""
    path = scratch_dir(spark, name)
    write_parquet(df, path)
    return read_parquet(spark, path)


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _purchase_text(raw_orders: DataFrame) -> DataFrame:
    """Orders as a raw file holds them, with the purchase time as text."""
    return raw_orders.withColumn(
        "order_purchase_timestamp", _clock_text("order_purchase_timestamp", TIMESTAMP_PATTERN)
    )


# --- sources


@query
def src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "order_items_csv")
    write_csv(inputs.order_items(spark, sf_dir), path)
    return data_columns(read_csv(spark, path, RAW["order_items"]))


@query
def src_csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "product_metadata_csv")
    described = inputs.product_metadata(spark, sf_dir).withColumn(
        "description", F.concat("brand", F.lit('\n"'), "category", F.lit('", boxed'))
    )
    write_csv(described, path)
    return data_columns(read_csv(spark, path, RAW["product_metadata"], multiline=True))


@query
def src_csv_multiline_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line with a remark of several lines, in files that are read block by block."""
    path = scratch_dir(spark, "remarks_csv")
    remark = F.concat(F.lit('said "'), "seller_id", F.lit('",\r\n\nthen "'), "product_id", F.lit('"'))
    write_csv(inputs.order_items(spark, sf_dir).withColumn("remark", remark), path)
    return data_columns(read_multiline_csv(spark, path, RAW["order_items"]))


@query
def src_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/lineitem.parquet")


@query
def api_products_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of three products each, landed as one JSON line per answer, with all their fields."""
    path = scratch_dir(spark, "product_answers")
    answers = inputs.table(spark, sf_dir, "part").select(
        F.to_json(
            F.struct(
                F.transform(
                    F.array(F.lit(0), F.lit(1), F.lit(2)),
                    lambda i: F.struct(
                        (F.col("p_partkey") * 3 + i).alias("id"),
                        F.col("p_brand").alias("brand"),
                        (F.col("p_size") / F.lit(10.0)).alias("rating"),
                        (F.col("p_size") + i).alias("stock"),
                        F.lower("p_type").alias("category"),
                        F.col("p_name").alias("title"),
                        F.struct(F.col("p_size").alias("width"), F.col("p_brand").alias("made_by")).alias("box"),
                    ),
                ).alias("products")
            )
        ).alias("value")
    )
    answers.write.text(path)
    products = data_columns(read_payloads(spark, path, element=None))
    return products.select(
        *RAW["product_metadata"].names, "title", F.col("box.width").alias("box_width"), F.col("box.made_by").alias("box_made_by")
    )


@query
def land_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries and three runs: every file is landed once."""
    root = scratch_dir(spark, "deliveries")
    drop, target, checkpoint = f"{root}/drop", f"{root}/landed", f"{root}/checkpoint"
    raw = _purchase_text(inputs.orders(spark, sf_dir))
    for delivery in (F.col("order_status") != "P", F.col("order_status") == "P"):
        raw.filter(delivery).write.mode("append").option("header", True).csv(drop)
        land_csv(spark, drop, target, checkpoint, RAW["orders"])
    land_csv(spark, drop, target, checkpoint, RAW["orders"])
    return spark.read.parquet(target).select(*RAW["orders"].names)


@query
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types inferred from files of the raw tables against the declared ones."""
    reports = []
    for name, df in inputs.raw_tables(spark, sf_dir).items():
        path = scratch_dir(spark, f"{name}_csv")
        write_csv(df, path)
        reports.append(conform.schema_drift(name, RAW[name], inferred_csv(spark, path)))
    return _union(reports)


# What three deliveries of orders are declared to hold, and which of their totals are unreadable.
DELIVERED_ORDERS = StructType().add("order_id", LongType()).add("total", LongType()).add("ordered", DateType())
UNREADABLE = 7


def _widening_orders(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, dict[str, str]]:
    """Three deliveries of orders, each of other types; where the versions are, all rows as text, the last types.

    The first has whole totals and dates, the second totals with cents, the third
    times, unreadable totals, and text in a column that was not declared.
    """
    root = scratch_dir(spark, "widening")
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    delivery = key % 3 + 1
    cents = F.col("o_totalprice").cast("decimal(15,2)")
    orders = inputs.table(spark, sf_dir, "orders").select(
        delivery.alias("delivery"),
        key.cast("string").alias("order_id"),
        F.when((delivery == 3) & (key % 100 == UNREADABLE), F.lit("n/a"))
        .when(delivery == 1, F.floor(cents).cast("string"))
        .otherwise(cents.cast("string"))
        .alias("total"),
        F.when(delivery == 3, F.concat(day, F.lit(" 12:30:00"))).otherwise(day).alias("ordered"),
        F.when(delivery == 1, (key % 10).cast("string")).when(delivery == 3, F.col("o_orderstatus")).alias("note"),
    )
    delivered = []
    for number in (1, 2, 3):
        path = f"{root}/delivery{number}"
        write_csv(orders.where(F.col("delivery") == number).drop("delivery"), path)
        rows = read_text_csv(spark, path)
        counts = widening.form_counts(rows, [SOURCE_FILE])
        _, forms = widen_types(spark, f"{root}/types", "orders", counts, DELIVERED_ORDERS)
        delivered.append(rows.drop(SOURCE_FILE).withColumn("delivery", F.lit(number)))
    return f"{root}/types", _union(delivered), forms


@query
def delivered_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of the types of a table that widen over three deliveries."""
    path, _, _ = _widening_orders(spark, sf_dir)
    return type_versions(spark, path).select("version", "column_name", "form")


@query
def delivered_rows_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of three deliveries, in the types that hold them all."""
    _, rows, forms = _widening_orders(spark, sf_dir)
    return widening.typed(rows, forms, keep=["delivery"])[0]


@query
def delivered_rows_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows with cells that no compatible type holds, as text, and the columns that don't fit."""
    _, rows, forms = _widening_orders(spark, sf_dir)
    others = widening.typed(rows, forms, keep=["delivery"])[1]
    return others.withColumn("columns", F.array_join(widening.REASONS, ",")).drop(widening.REASONS)


# --- sinks


@query
def sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, "orders", staging.stage_orders(inputs.orders(spark, sf_dir)))


@query
def sink_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact by month, then one year of it written again in place."""
    path, months = scratch_dir(spark, "fact_by_month"), ("year", "month")
    fact = _stored(spark, "fact_sales", fact_sales(spark, sf_dir))
    write_parquet(fact, path, partition_by=months)
    write_parquet(
        fact.filter(F.col("year") == 1998), path, partition_by=months, only_touched_partitions=True
    )
    return read_parquet(spark, path)


@query
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "inventory_csv")
    write_csv(inputs.inventory(spark, sf_dir), path)
    return data_columns(read_csv(spark, path, RAW["inventory"]))


@query
def observed_write_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three writes report about themselves, without reading anything back."""
    rows = []
    for name, column in (
        ("orders", "order_date"), ("order_items", "order_id"), ("products", "category")
    ):
        written = write_parquet(
            _staged(spark, sf_dir, name),
            scratch_dir(spark, name),
            metrics=[quality.nulls_metric(column)],
        )
        rows.append((name, column, written["row_count"], written["null_count"]))
    return spark.createDataFrame(
        rows, "table_name string, column_name string, row_count long, null_count long"
    )


# --- projections and filters


@query
def avg_price_per_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.average_prices(inputs.order_items(spark, sf_dir))


@query
def metadata_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    metadata = staging.stage_product_metadata(inputs.product_metadata(spark, sf_dir))
    return star.conformed_metadata(metadata.drop("brand"))


@query
def filter_not_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return having_keys(inputs.product_metadata(spark, sf_dir), "id")


@query
def join_mixed_type_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text product ids against numeric service ids, each side one row per id."""
    products = one_per_key(inputs.products(spark, sf_dir), ["product_id"])
    metadata = having_keys(inputs.product_metadata(spark, sf_dir).select("id", "brand"), "id")
    brands = one_per_key(metadata, ["id"]).select(text_key("id").alias("product_id"), "brand")
    return products.join(brands, "product_id", "left")


# --- aggregation and dedup


@query
def row_counts_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(
        df.agg(quality.rows_metric()).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in inputs.raw_tables(spark, sf_dir).items()
    )


@query
def null_counts_all_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.raw_tables(spark, sf_dir)
    return _union(
        quality.table_profile(
            raw[name].withColumn(column, F.nullif(column, F.lit(missing))), name, column
        )
        for name, column, missing in MISSING_VALUES
    )


@query
def dedup_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(_events(spark, sf_dir), ["user_id"], "ts")


@query
def dedup_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = staging.stage_order_items(inputs.order_items(spark, sf_dir))
    return lines.select("order_id", "order_item_id", "product_id", "price")


@query
def distinct_products_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.first_products(inputs.order_items(spark, sf_dir))


# --- scalar functions


@query
def fn_concat_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.products(spark, sf_dir).select(
        "product_id", product_label("product_category_name", "product_id").alias("product_name")
    )


@query
def fn_substring_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", id_prefix("o_orderpriority").alias("prefix")
    )


def _mixed_text(spark: SparkSession, sf_dir: str, text) -> DataFrame:
    """Events with a text that is readable except for errors, which carry JSON."""
    unreadable = F.col("event_type") == "error"
    return _events(spark, sf_dir).select(
        "event_id", F.when(unreadable, F.col("props")).otherwise(text).alias("text")
    )


@query
def fn_try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _mixed_text(spark, sf_dir, F.col("user_id").cast("string"))
    return texts.select("event_id", lenient_double("text").alias("number"))


@query
def fn_parse_ts_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _mixed_text(spark, sf_dir, _clock_text("ts", TIMESTAMP_PATTERN))
    return texts.select("event_id", parsed_date(texts, "text", TIMESTAMP_PATTERN).alias("day"))


@query
def fn_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _mixed_text(spark, sf_dir, _clock_text("ts", DATE_PATTERN))
    return texts.select("event_id", parsed_date(texts, "text", DATE_PATTERN).alias("day"))


@query
def fn_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.orders(spark, sf_dir).select(
        "order_id",
        F.year("order_purchase_timestamp").alias("year"),
        F.month("order_purchase_timestamp").alias("month"),
    )


@query
def stock_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.inventory(spark, sf_dir).select(
        "product_id", "stock_quantity", status_of("stock_quantity").alias("stock_status")
    )


@query
def synth_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.named_sellers(inputs.sellers(spark, sf_dir))


@query
def synth_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.drawn_inventory(inputs.order_items(spark, sf_dir))


# --- incremental load


@query
def delta_since_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.delta_since(_events(spark, sf_dir), "ts", _ntz(WATERMARK))


@query
def delta_or_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delta after a mark, and the whole table when the mark is past every row."""
    events = _events(spark, sf_dir)
    return _union(
        incremental.delta_or_full(events, "ts", _ntz(mark)).withColumn("since", F.lit(mark))
        for mark in (WATERMARK, LATER_THAN_ALL)
    )


@query
def read_watermark_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of a loaded and of a never loaded source, from a control table of event types."""
    control = _events(spark, sf_dir).groupBy(F.col("event_type").alias("source")).agg(
        F.max("ts").alias("watermark")
    )
    return _union(
        incremental.watermark_of(control, source) for source in ("purchase", NEVER_LOADED)
    )


@query
def advance_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next mark after a delta, and after one without rows."""
    events = _events(spark, sf_dir)
    return _union(
        incremental.advanced_watermark(
            incremental.delta_since(events, "ts", _ntz(mark)), "ts", _ntz(mark)
        ).withColumn("since", F.lit(mark))
        for mark in (WATERMARK, LATER_THAN_ALL)
    )


@query
def upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    before = events.filter(F.col("ts") <= _ntz(WATERMARK))
    snapshot = _stored(spark, "snapshot", latest_per_key(before, ["user_id"], "ts"))
    delta = incremental.delta_since(events, "ts", _ntz(WATERMARK), inclusive=True)
    return incremental.upsert(snapshot, delta, ["user_id"], "ts")


@query
def upsert_small_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last two days into the stored snapshot of all days before."""
    events = _events(spark, sf_dir)
    before = latest_per_key(events.filter(F.col("ts") <= _ntz(LAST_DAYS)), ["user_id"], "ts")
    snapshot = _stored(spark, "snapshot", before)
    delta = incremental.delta_since(events, "ts", _ntz(LAST_DAYS), inclusive=True)
    newest = latest_per_key(delta, ["user_id"], "ts")
    return incremental.upsert(snapshot, newest, ["user_id"], "ts", one_row_per_key=True)


def _two_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sellers before and after: those of one region vanish, those of another move, one region is new."""
    sellers = inputs.sellers(spark, sf_dir)
    before = sellers.where(F.col("state") != NEW_STATE)
    after = sellers.where(F.col("state") != LOST_STATE).withColumn(
        "city", F.when(F.col("state") == MOVED_STATE, "ELSEWHERE").otherwise(F.col("city"))
    )
    return before, after


@query
def seller_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _two_snapshots(spark, sf_dir)
    return snapshots.snapshot_changes(_stored(spark, "sellers", before), after, ["seller_id"])


@query
def seller_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history after three snapshots, the third like the first: vanished sellers come back."""
    before, after = _two_snapshots(spark, sf_dir)
    layout = refresh.Layout(scratch_dir(spark, "history"))
    for day, snapshot in zip(SNAPSHOT_DAYS, (before, after, before)):
        history.record_snapshot(spark, layout, "sellers", snapshot, ["seller_id"], day)
    return history.read_history(spark, layout, "sellers")


# --- data quality


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.raw_tables(spark, sf_dir)
    return quality.key_report(
        {t: staged_table(t, raw.__getitem__) for t in refresh.STAGED_TABLES}
    )


@query
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report once the gate has passed it; the query fails when it does not."""
    report = _stored(spark, "dq_report", dq_report(spark, sf_dir))
    quality.gate(report)
    return report


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines by the year they were shipped in, each a load; some without a return flag."""
    return inputs.table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").cast("string").alias("load"), "l_partkey", "l_suppkey", "l_extendedprice",
        F.nullif("l_returnflag", F.lit(UNFLAGGED)).alias("l_returnflag"),
    )


@query
def profile_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of all loads from their stored profiles, and whether its estimates are as near as stated."""
    lines = _shipments(spark, sf_dir)
    by_load = _stored(spark, "profiles", profiles.load_profile(lines, F.col("load"), PROFILED))
    whole = _stored(spark, "profile", profiles.whole_profile(by_load))
    medians = {r.column_name: F.lit(r.median).cast("double") for r in whole.collect()}
    exact = lines.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("name"),
                    F.countDistinct(c).alias("values"),
                    F.avg((F.col(c).try_cast("double") < medians[c]).cast("int")).alias("below"),
                    F.avg((F.col(c).try_cast("double") <= medians[c]).cast("int")).alias("upto"),
                )
                for c in PROFILED
            ]
        ).alias("all")
    )
    off = F.abs(F.col("distinct_values") - F.col("values")) / F.col("values")
    # Rows that equal the median take up all ranks from below to upto.
    near = 2 * profiles.RANK_ERROR
    fits = (F.col("below") <= 0.5 + near) & (F.col("upto") >= 0.5 - near)
    return (
        whole.join(exact.select(F.inline("all")), F.col("name") == F.col("column_name"))
        .select(
            "column_name",
            "row_count",
            "null_count",
            (off <= 3 * profiles.DISTINCT_ERROR).alias("distinct_fits"),
            F.coalesce(fits, F.lit(True)).alias("median_fits"),
        )
    )


@query
def profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and NULLs of each load against the loads before it, from stored profiles."""
    by_load = profiles.load_profile(_shipments(spark, sf_dir), F.col("load"), PROFILED)
    report = profiles.drift_report(_stored(spark, "profiles", by_load))
    return report.where(F.col("rule") != "distinct")


@query
def dq_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed order lines of which some have a number or a price that can't be read."""
    lines = inputs.order_items(spark, sf_dir)
    dirty = lines.withColumns(
        {
            "order_item_id": F.when(F.col("order_item_id") == DIRTY_LINE, F.concat(F.lit("x"), "order_item_id"))
            .otherwise(F.col("order_item_id").cast("string")),
            "price": F.when(F.col("order_item_id") == DIRTY_PRICE, F.lit("n/a")).otherwise(F.col("price").cast("string")),
        }
    )
    path = scratch_dir(spark, "dirty_csv")
    write_csv(dirty, path)
    landed = scratch_dir(spark, "dirty_landed")
    written = write_parquet(
        read_csv(spark, path, RAW["order_items"]), landed, metrics=[bad_record_count()]
    )
    report = quality.reject_report({"order_items": read_parquet(spark, landed)}, CORRUPT)
    return report.withColumn("bad_records", F.lit(written["bad_records"]).cast("long"))


@query
def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans, repeated keys and values out of range, in staged tables of which one lost its open orders."""
    staged = {t: _staged(spark, sf_dir, t) for t in refresh.STAGED_TABLES}
    staged["orders"] = staged["orders"].filter(F.col("status") != "P")
    staged["products"] = staged["products"].unionByName(
        staged["products"].filter(F.col("category").isNull())
    )
    staged["product_metadata"] = staged["product_metadata"].withColumn("rating", F.col("rating") + 1)
    return quality.integrity_report(staged)


# --- staging and star


def _register_tables() -> None:
    def staged(name):
        return lambda spark, sf_dir: _staged(spark, sf_dir, name)

    def starred(name):
        return lambda spark, sf_dir: star_table(name, partial(_staged, spark, sf_dir))

    QUERIES.update({f"stage_{name}": staged(name) for name in refresh.STAGED_TABLES})
    QUERIES.update({name: starred(name) for name in refresh.STAR_TABLES if name != "fact_sales"})


_register_tables()


@query
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders are stored first, so that AQE can split one with very many lines."""
    return star.fact_sales(
        _staged(spark, sf_dir, "order_items"),
        _stored(spark, "orders", _staged(spark, sf_dir, "orders")),
    )


@query
def fact_sales_by_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_sales_by_seller(
        _staged(spark, sf_dir, "order_items"), _stored(spark, "orders", _staged(spark, sf_dir, "orders"))
    )


@query
def fact_line_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_line_revenue(
        _staged(spark, sf_dir, "order_items"), _stored(spark, "orders", _staged(spark, sf_dir, "orders"))
    )


@query
def fact_sales_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From lines and orders in buckets by order: the join moves no row."""
    path = scratch_dir(spark, "buckets")
    name = f"shelfmark_{path.rsplit('-', 1)[1]}"
    tables = {
        t: colocated.write_bucketed(_staged(spark, sf_dir, t), f"{name}_{t}", f"{path}/{t}", "order_id", BUCKETS)
        for t in ("order_items", "orders")
    }
    return colocated.colocated_fact(spark, tables["order_items"], tables["orders"])


@query
def stage_products_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From products and mean prices in buckets by product."""
    path = scratch_dir(spark, "buckets")
    name = f"shelfmark_{path.rsplit('-', 1)[1]}"
    raw = partial(inputs.raw_table, spark, sf_dir)
    described = one_per_key(staging.described_products(raw("products")), ["product_id"])
    prices = staging.average_prices(raw("order_items"))
    tables = [
        colocated.write_bucketed(df, f"{name}_{t}", f"{path}/{t}", "product_id", BUCKETS)
        for t, df in (("products", described), ("prices", prices))
    ]
    return colocated.colocated_products(spark, *tables)


@query
def dim_products_no_metadata_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_products(
        _staged(spark, sf_dir, "products"),
        _staged(spark, sf_dir, "inventory"),
        _staged(spark, sf_dir, "product_metadata").select("product_id"),
    )


@query
def delivery_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over deliveries that are merged: rows and a checksum of staging and star after both.

    The second brings orders that came late, orders with another date and state,
    some of them without a readable date, their lines at another price, and new
    names of customers.
    """
    root = scratch_dir(spark, "deliveries")
    raw = inputs.raw_tables(spark, sf_dir)
    orders, lines, customers = _purchase_text(raw["orders"]), raw["order_items"], raw["customers"]
    key = F.col("order_id").cast("long")
    moved, undated, late = key % 100 == MOVED, key % 100 == UNDATED, key % 50 == LATE
    later = F.date_add(F.to_date("order_purchase_timestamp"), MOVED_DAYS).cast("string")
    purchase = F.when(moved, F.concat(later, F.lit(" 00:00:00"))).when(undated, "n/a")
    changed = orders.withColumns(
        {
            "order_status": F.when(moved, "M").otherwise(F.col("order_status")),
            "order_purchase_timestamp": F.coalesce(purchase, "order_purchase_timestamp"),
        }
    )
    renamed = customers.where(F.col("customer_id").cast("long") % 100 == RENAMED)
    deliveries = (
        {"customers": customers, "products": raw["products"], "orders": orders.where(~late), "order_items": lines},
        {
            "customers": renamed.withColumn("customer_unique_id", F.concat("customer_unique_id", F.lit(" II"))),
            "orders": changed.where(moved | undated | late),
            "order_items": lines.where(moved).withColumn("price", F.col("price") + 1),
        },
    )
    layout = refresh.Layout(f"{root}/lake")
    for delivered in deliveries:
        for name, df in delivered.items():
            # All copies of a line in one file: those in the newest file of a line count.
            by = next(c for c in ("order_id", "customer_id", "product_id") if c in df.columns)
            write_csv(df.repartition(by), f"{root}/source/{name}.csv", mode="append")
        delivery.run_deliveries(
            spark, layout, f"{root}/source", raw.__getitem__, product_metadata=lambda: raw["product_metadata"]
        )
    staged, starred = delivery.staged_reader(spark, layout), refresh.read_star(spark, layout)
    return _checksums(
        {f"staging.{t}": staged(t) for t in refresh.STAGED_TABLES}
        | {f"star.{t}": starred(t) for t in refresh.STAR_TABLES}
    )


@query
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run from files and tables to the star; rows and a checksum of every table written."""
    root = scratch_dir(spark, "daily")
    raw = inputs.raw_tables(spark, sf_dir)
    raw["orders"] = _purchase_text(raw["orders"])
    for name in refresh.CSV_TABLES:
        write_csv(raw[name], f"{root}/source/{name}.csv")
    metadata = raw["product_metadata"]
    metadata.select(
        F.to_json(F.struct(F.array(F.struct(*metadata.columns)).alias("products"))).alias("value")
    ).write.text(f"{root}/source/answers")
    layout = refresh.Layout(root)
    refresh.run_daily(
        spark,
        layout,
        csv_root=f"{root}/source",
        source_table=raw.__getitem__,
        product_metadata=partial(read_payloads, spark, f"{root}/source/answers"),
    )
    starred = refresh.read_star(spark, layout)
    return _checksums(
        {f"staging.{t}": read_parquet(spark, layout.staging(t)) for t in refresh.STAGED_TABLES}
        | {f"star.{t}": starred(t) for t in refresh.STAR_TABLES}
    )


def _checksums(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and a checksum of every table."""
    return _union(
        df.agg(quality.rows_metric(), _checksum(df).alias("checksum")).select(
            F.lit(name).alias("table_name"), "row_count", "checksum"
        )
        for name, df in tables.items()
    )


def _checksum(df: DataFrame):
    """The sum, over all rows, of a number made from the row's values as text."""
    texts = [
        F.floor(F.col(f.name) * 10_000 + 0.5).cast("decimal(38,0)").cast("string")
        if isinstance(f.dataType, DoubleType)
        else F.col(f.name).cast("string")
        for f in sorted(df.schema, key=lambda f: f.name)
    ]
    row = F.md5(F.concat_ws("|", *[F.coalesce(t, F.lit("-")) for t in texts]).cast("binary"))
    return F.sum(F.conv(F.substring(row, 1, 8), 16, 10).cast("long"))
