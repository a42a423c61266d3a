"""The daily run over deliveries, at the cost of what they change.

A delivery touches some orders. Their old rows lie in the months of an index by
order (order_id, year, month), their new ones in the months of the merged orders;
only these months of orders, lines and the sales fact are read and written again.
All other folders are carried over by the manifest.

What staging holds beside the columns of its tables makes merging exact in any
order of deliveries: each row's file and delivery time, and of a line also the
copies in the newest file, which the mean price counts (``_first`` marks the one
that is staged). Lines lie in the month of their order; those without a dated
order in a folder without a month. Mean prices are kept as exact sums by product,
from which superseded lines are taken back.

Customers and products are merged by key into one folder each, and only when a
delivery brings some (products also when a price changed). The steps hand over
through published versions: the star rebuilds the months whose folders differ
between the staging it was made from and the newest, so a run that was cut off
anywhere is made up for by the next.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions.measures import exact_mean, mean_of_sums, mean_sums
from shelfmark.operators.dedup import one_per_key, order_within_keys
from shelfmark.operators.quality import KEY_RULES, gate, key_checks, reject_report
from shelfmark.plans import staging, star
from shelfmark.plans.incremental import current_snapshot
from shelfmark.plans.refresh import (
    CSV_TABLES,
    INVENTORY,
    MONTHS,
    STAGED_TABLES,
    STAR_FROM,
    STAR_LAYER,
    Layout,
    Metrics,
    land,
    load,
    raw_reader,
    staged_table,
    write_each,
)
from shelfmark.schemas import ORDER_MONTHS, STAGING
from shelfmark.sinks.files import write_parquet
from shelfmark.sources import catalog
from shelfmark.sources.catalog import NO_VALUE, Part, Version
from shelfmark.sources.files import CORRUPT, LOAD

log = logging.getLogger(__name__)

STAGING_LAYER = "staging"
FIRST, SIGN = "_first", "_sign"
LINE_KEY = ["order_id", "order_item_id"]
# Tables of the staging layer beside the staged ones.
INDEX, PRICES = "order_months", "prices"
UNDATED = f"year={NO_VALUE}/month={NO_VALUE}"
# An index of more folders is written anew as one.
INDEX_FOLDERS = 50

Months = Collection[tuple[int | None, int | None]]


def staging_path(layout: Layout) -> str:
    return f"{layout.root}/{STAGING_LAYER}"


def _named(month: tuple[int | None, int | None]) -> str:
    year, number = (NO_VALUE if v is None else v for v in month)
    return f"year={year}/month={number}"


def _months_of(df: DataFrame) -> set[tuple[int | None, int | None]]:
    """The months that rows lie in; a row per month reaches the driver."""
    return {(r.year, r.month) for r in df.select(*MONTHS).distinct().collect()}


def _month_columns(date: str) -> dict[str, Column]:
    return {"year": F.year(date), "month": F.month(date)}


@dataclass
class Staging:
    """One run's work on the staging layer: the last version, and the parts of the one to come."""

    spark: SparkSession
    layout: Layout
    last: Version
    raw: Callable[[str], DataFrame]
    coming: Version = field(init=False)
    parts: dict[str, list[Part]] = field(default_factory=dict)
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)

    def __post_init__(self):
        self.path = staging_path(self.layout)
        self.coming = self.last.next(built_from=self.last.built_from + 1)

    def work(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written aside, for steps that need it more than once; a repeated run writes it anew."""
        path = f"{self.layout.root}/work/{name}"
        write_parquet(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def old(self, table: str, like: DataFrame, months: Months | None = None) -> DataFrame:
        """The rows of the last version, of the given months if any, in the columns of ``like``."""
        names = None if months is None else {_named(m) for m in months}
        parts = self.last.of(table, names)
        by_month = MONTHS if any(p.partition for p in self.last.of(table)) else ()
        return catalog.read_parts(self.spark, self.path, parts, like.schema, by_month).select(*like.columns)

    def write(self, table: str, df: DataFrame, by: tuple[str, ...] = (), only: str = "true") -> list[Part]:
        number = self.coming.number
        rows = write_parquet(df, catalog.folder_of(self.path, table, number), partition_by=by)["row_count"]
        key = dict(KEY_RULES).get(table)
        parts = catalog.written_parts(self.spark, self.path, table, number, rows, by, key, only)
        self.metrics[table] = {"row_count": sum(p.row_count for p in parts)}
        return parts

    def whole(self, table: str, df: DataFrame) -> None:
        self.parts[table] = self.write(table, df)

    def by_month(self, table: str, df: DataFrame, months: Months, only: str = "true") -> None:
        """The given months anew; those that have no rows any more are left out, all others carried over."""
        names = {_named(m) for m in months}
        kept = [p for p in self.last.of(table) if p.partition not in names and p.path]
        self.parts[table] = kept + (self.write(table, df, MONTHS, only) if months else [])

    def carried(self, table: str) -> None:
        self.parts[table] = list(self.last.of(table))

    def published(self) -> Version:
        version = self.coming.having(p for parts in self.parts.values() for p in parts)
        catalog.publish(self.spark, self.layout.manifest, version)
        return version


def _merge_sales(run: Staging) -> DataFrame | None:
    """Orders and lines of the touched months.

    Returns the prices of the lines of touched orders, before with sign -1 and
    after with sign 1; None where the delivery touches no order.
    """
    dated = staging.dated_orders(run.raw("orders"))
    versions = staging.delivery_columns(dated)
    orders_new = run.work(one_per_key(dated, ["order_id"], newest=versions), "orders_new")
    lines_new = staging.typed_lines(run.raw("order_items"))
    touched = run.work(
        orders_new.select("order_id").unionByName(lines_new.select("order_id")).distinct(), "touched"
    )
    if touched.isEmpty():
        for table in ("orders", "order_items", INDEX):
            run.carried(table)
        return None
    mine = F.col("order_id").eqNullSafe(F.col("touched"))
    keys = touched.withColumnRenamed("order_id", "touched")

    def of_touched(df: DataFrame, how: str = "left_semi") -> DataFrame:
        return df.join(keys, mine, how)

    # Where the touched orders were.
    index = run.old(INDEX, run.spark.createDataFrame([], ORDER_MONTHS))
    located = run.work(one_per_key(of_touched(index), ["order_id"], newest=["since"]), "located")
    before = _months_of(located)

    dated_like = dated.withColumns(_month_columns("order_date"))
    orders_old = run.old("orders", dated_like, before)
    merged = one_per_key(
        of_touched(orders_old).drop(*MONTHS).unionByName(orders_new), ["order_id"], newest=versions
    ).withColumns(_month_columns("order_date"))
    orders_now = run.work(merged, "orders_now")
    after = _months_of(orders_now)
    months = before | after
    rest = of_touched(run.old("orders", dated_like, months), "left_anti")
    run.by_month("orders", rest.unionByName(orders_now), months)

    # Lines of orders that are not known, or not dated, lie outside all months.
    lines_like = lines_new.withColumn(FIRST, F.lit(True)).withColumns({c: F.lit(None).cast("int") for c in MONTHS})
    undated = (None, None)
    lines_old = run.work(of_touched(run.old("order_items", lines_like, before | {undated})), "lines_old")
    place = F.row_number().over(
        Window.partitionBy(*LINE_KEY).orderBy(*order_within_keys(lines_new, LINE_KEY, versions))
    )
    first = (place == 1) & F.col("order_item_id").isNotNull()
    rows = staging.newest_delivered(
        lines_old.drop(FIRST, *MONTHS).unionByName(lines_new), *LINE_KEY, each=lambda df: df.withColumn(FIRST, first)
    )
    of_order = orders_now.select(F.col("order_id").alias("of_order"), *MONTHS)
    lines_now = run.work(
        rows.join(of_order, F.col("order_id") == F.col("of_order"), "left")
        .select(*lines_like.columns),
        "lines_now",
    )
    line_months = _months_of(lines_old) | _months_of(lines_now)
    rest = of_touched(run.old("order_items", lines_like, line_months), "left_anti")
    run.by_month("order_items", rest.unionByName(lines_now), line_months, only=FIRST)

    moved = orders_now.select("order_id", *MONTHS, F.lit(run.coming.number).cast("long").alias("since"))
    folders = [p for p in run.last.of(INDEX) if p.path]
    if len(folders) >= INDEX_FOLDERS:
        run.whole(INDEX, one_per_key(index.unionByName(moved), ["order_id"], newest=["since"]))
    else:
        run.parts[INDEX] = folders + run.write(INDEX, moved)
    priced = ["product_id", "price"]
    return lines_now.select(*priced, F.lit(1).alias(SIGN)).unionByName(
        lines_old.select(*priced, F.lit(-1).alias(SIGN))
    )


def _merge_prices(run: Staging, changes: DataFrame | None) -> bool:
    """Bring the sums behind mean prices up to date; whether any changed."""
    if changes is None:
        run.carried(PRICES)
        return False
    sold = changes.where(F.col("product_id").isNotNull())
    delta = run.work(sold.groupBy("product_id").agg(*mean_sums("price", SIGN)), "prices_delta")
    total = run.old(PRICES, delta).unionByName(delta).groupBy("product_id")
    sums = [c for c in delta.columns if c != "product_id"]
    run.whole(PRICES, total.agg(*[F.sum(c).cast(delta.schema[c].dataType).alias(c) for c in sums]))
    return True


def _mean_prices(run: Staging) -> DataFrame:
    """The mean price of every product sold.

    Products with a price that is no whole millionth are averaged over all their
    lines: such prices can't be taken back from a sum exactly.
    """
    prices = catalog.read_parts(run.spark, run.path, run.parts[PRICES], STAGING["products"])
    means = prices.where("others = 0").select("product_id", mean_of_sums().alias("price"))
    inexact = prices.where("others > 0").select("product_id")
    if inexact.isEmpty():
        return means
    lines = catalog.read_parts(run.spark, run.path, run.parts["order_items"], STAGING["order_items"], MONTHS)
    again = lines.join(inexact, "product_id", "left_semi").groupBy("product_id").agg(exact_mean("price").alias("price"))
    return means.unionByName(again)


def _merge_keyed(run: Staging, table: str, new: DataFrame, key: str) -> DataFrame | None:
    """The old and the new rows of a table, the newest per key; None where nothing is new."""
    if new.isEmpty():
        return None
    versions = staging.delivery_columns(new)
    return one_per_key(run.old(table, new).unionByName(new), [key], newest=versions)


def stage(spark: SparkSession, layout: Layout) -> Metrics:
    """Merge what was landed since the last version into staging, and publish it as the next.

    Returns what was written, by table. A run that is cut off before it publishes
    changes nothing; the next one does all of it.
    """
    last = catalog.version_of(spark, layout.manifest, STAGING_LAYER)
    landed = raw_reader(spark, layout)

    def raw(table: str) -> DataFrame:
        if table in CSV_TABLES:
            return landed(table).where(F.col(LOAD) > last.built_from).drop(LOAD)
        if table == "inventory":
            return current_snapshot(spark, layout.snapshots, layout.control, table, **INVENTORY)
        return landed(table)

    run = Staging(spark, layout, last, raw)

    def merge_customers():
        named = staging.named_customers(raw("customers"))
        merged = _merge_keyed(run, "customers", named, "customer_id")
        run.carried("customers") if merged is None else run.whole("customers", staging.with_contact(merged))

    def merge_products_and_sales():
        repriced = _merge_prices(run, _merge_sales(run))
        described = staging.described_products(raw("products"))
        merged = _merge_keyed(run, "products", described, "product_id")
        if merged is None and not repriced:
            return run.carried("products")
        merged = run.old("products", described) if merged is None else merged
        prices = _mean_prices(run) if run.parts[PRICES] else spark.createDataFrame([], STAGING["products"])
        run.whole("products", staging.with_prices(merged, prices.select("product_id", "price")))

    def copied(table: str):
        return partial(lambda name: run.whole(name, staged_table(name, raw)), table)

    steps = {"customers": merge_customers, "sales": merge_products_and_sales}
    steps |= {t: copied(t) for t in ("sellers", "inventory", "product_metadata")}
    write_each(spark, lambda name: steps[name](), steps)
    run.published()
    return run.metrics


def staged_reader(
    spark: SparkSession, layout: Layout, version: Version | None = None, months: Collection[str] | None = None
) -> Callable[[str], DataFrame]:
    """The staged tables by name, as the full run stages them; ``months`` narrows orders and lines to folders."""
    version = version or catalog.version_of(spark, layout.manifest, STAGING_LAYER)

    def table(name: str) -> DataFrame:
        monthly = name in ("orders", "order_items")
        parts = version.of(name, months if monthly else None)
        df = catalog.read_parts(spark, staging_path(layout), parts, STAGING[name], MONTHS if monthly else ())
        if name == "order_items" and FIRST in df.columns:
            df = df.where(FIRST)
        return df.drop(FIRST, *staging.delivery_columns(df), *(MONTHS if monthly else ()))

    return table


def check(spark: SparkSession, layout: Layout, allowed_rejects: int = 0) -> None:
    """The checks of the full run. Counts come from the manifest; rejects are those not yet in the star."""
    now = catalog.version_of(spark, layout.manifest, STAGING_LAYER)
    rules = dict(KEY_RULES)
    counted = [
        (t, rules[t], sum(p.row_count for p in now.of(t)), sum(p.keyless for p in now.of(t)))
        for t in STAGED_TABLES
    ]
    report = key_checks(
        spark.createDataFrame(counted, "table_name string, key_column string, row_count long, null_count long")
    )
    done = _made_from(spark, layout).built_from
    raw = raw_reader(spark, layout)
    landed = {t: raw(t).where(F.col(LOAD) > done) for t in CSV_TABLES}
    landed["product_metadata"] = raw("product_metadata")
    gate(report.unionByName(reject_report(landed, CORRUPT, allowed_rejects)))


def _made_from(spark: SparkSession, layout: Layout) -> Version:
    """The staging that the newest star was made from."""
    starred = catalog.version_of(spark, layout.manifest, STAR_LAYER)
    return catalog.version_of(spark, layout.manifest, STAGING_LAYER, starred.built_from)


def fact_of_months(spark: SparkSession, layout: Layout, version: Version, months: Collection[str]) -> DataFrame:
    """The sales fact of some months, from their folders alone: lines lie where their orders do."""
    staged = staged_reader(spark, layout, version, months)
    return star.fact_sales(staged("order_items"), staged("orders"))


def build_star(spark: SparkSession, layout: Layout) -> Metrics:
    """Rebuild what changed in staging since the star was made, and publish the star as a whole."""
    then, now = _made_from(spark, layout), catalog.version_of(spark, layout.manifest, STAGING_LAYER)
    last = catalog.version_of(spark, layout.manifest, STAR_LAYER)
    coming = last.next(built_from=now.number)
    staged = staged_reader(spark, layout, now)
    parts: dict[str, list[Part]] = {}
    metrics: dict[str, dict[str, int]] = {}

    def write(table: str) -> None:
        make, needs = STAR_FROM[table]
        changed = {name: now.changed_since(then, name) for name in needs}
        old = [p for p in last.of(table) if p.path]
        if old and not any(changed.values()):
            parts[table] = old
            return
        by, df = (), None
        if table == "fact_sales":
            months = set().union(*changed.values())
            old = [p for p in old if p.partition not in months]
            by, df = MONTHS, fact_of_months(spark, layout, now, months)
        else:
            old, df = [], make(*map(staged, needs))
        rows = write_parquet(df, catalog.folder_of(layout.star, table, coming.number), partition_by=by)["row_count"]
        metrics[table] = {"row_count": rows}
        written = catalog.written_parts(spark, layout.star, table, coming.number, rows, by)
        parts[table] = old + [p for p in written if p.path or not old]

    write_each(spark, write, STAR_FROM)
    catalog.publish(spark, layout.manifest, coming.having(p for t in STAR_FROM for p in parts[t]))
    return metrics


def run_deliveries(
    spark: SparkSession,
    layout: Layout,
    csv_root: str,
    source_table: Callable[[str], DataFrame],
    product_metadata: Callable[[], DataFrame],
    sink: Callable[[DataFrame, str], int] | None = None,
    delivered: Column | None = None,
    allowed_rejects: int = 0,
) -> Metrics:
    """Land the files that are new, merge them into staging, check, bring the star up to date, load.

    Staging and star are then what ``run_daily`` with ``new_files_only`` makes of
    all files landed so far. Returns what was written: of tables that the
    deliveries did not touch nothing, of those kept by month the touched months.
    """
    landed = land_deliveries(spark, layout, csv_root, source_table, product_metadata, delivered)
    written = {f"raw.{table}": metrics for table, metrics in landed.items()}
    written.update(stage(spark, layout))
    check(spark, layout, allowed_rejects)
    written.update(build_star(spark, layout))
    if sink:
        load(spark, layout, sink)
    return written


def land_deliveries(
    spark: SparkSession,
    layout: Layout,
    csv_root: str,
    source_table: Callable[[str], DataFrame],
    product_metadata: Callable[[], DataFrame],
    delivered: Column | None = None,
) -> Metrics:
    """Land what is new as the load that the next staging merges."""
    last = catalog.version_of(spark, layout.manifest, STAGING_LAYER)
    return land(
        spark, layout, csv_root, source_table, product_metadata,
        new_files_only=True, delivered=delivered, load_number=last.built_from + 1,
    )
