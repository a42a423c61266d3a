"""The daily run: land, stage, check, build the star, load."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.quality import gate, key_report, reject_report
from shelfmark.plans import staging, star
from shelfmark.plans.incremental import current_snapshot, extract_increment
from shelfmark.plans.journal import Journal, NoJournal
from shelfmark.schemas import RAW, STAR
from shelfmark.sinks.files import write_parquet
from shelfmark.sources import catalog
from shelfmark.sources.catalog import Part, Version
from shelfmark.sources.control import claim_mode, landing_modes
from shelfmark.sources.files import CORRUPT, bad_record_count, read_csv
from shelfmark.streaming.landing import land_csv

log = logging.getLogger(__name__)

# The tables of each kind of source, and of the warehouse.
CSV_TABLES = ("customers", "products", "orders", "order_items")
STAGED_TABLES = (*CSV_TABLES, "sellers", "inventory", "product_metadata")
STAR_TABLES = ("dim_customers", "dim_sellers", "dim_products", "fact_sales")

# The key and the change stamp of the incremental source.
INVENTORY = {"keys": ["product_id"], "changed": "last_updated"}

# How files are landed: as the whole current extract, as deliveries that add up and
# are staged from all landed files, or as deliveries that are merged into staging.
EXTRACT, DELIVERIES, MERGED = "extract", "deliveries", "merged"

# Layers whose tables are published together.
STAR_LAYER = "star"
MONTHS = ("year", "month")

# Independent tables are written at the same time, so a small one does not leave
# the cluster idle.
TABLES_AT_ONCE = 4

Metrics = Mapping[str, Mapping[str, int]]


@dataclass(frozen=True)
class Layout:
    """Where the layers live, below one root folder."""

    root: str

    def raw(self, table: str) -> str:
        return f"{self.root}/raw/{table}"

    def deliveries(self, table: str) -> str:
        return f"{self.root}/raw_deliveries/{table}"

    def staging(self, table: str) -> str:
        return f"{self.root}/staging/{table}"

    @property
    def star(self) -> str:
        """The folder of the star; which folders below it count is said by the manifest."""
        return f"{self.root}/{STAR_LAYER}"

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"

    @property
    def snapshots(self) -> str:
        return f"{self.root}/raw/snapshots"

    @property
    def control(self) -> str:
        return f"{self.root}/control"

    @property
    def modes(self) -> str:
        return f"{self.root}/landing_modes"

    @property
    def journal(self) -> str:
        return f"{self.root}/journal"

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/landing/{table}"


def write_each(
    spark: SparkSession, write: Callable[[str], Any], tables: Iterable[str]
) -> dict[str, Any]:
    """Write independent tables side by side; the first failure is raised.

    The caller's job group and scheduler pool hold for all of them.
    """
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        task = inheritable_thread_target(spark)(write)
        running = {table: pool.submit(task, table) for table in tables}
        results = {table: job.result() for table, job in running.items()}
    for table, metrics in results.items():
        log.info("%s: %s", table, metrics)
    return results


def land(
    spark: SparkSession,
    layout: Layout,
    csv_root: str,
    source_table: Callable[[str], DataFrame],
    product_metadata: Callable[[], DataFrame],
    new_files_only: bool = False,
    delivered: Column | None = None,
    load_number: int | None = None,
    journal: Journal | NoJournal = NoJournal(),
) -> Metrics:
    """Bring all sources into the raw layer as Parquet.

    ``csv_root`` holds a file or folder per table, ``<table>.csv``. By default
    it is taken as the whole current extract. ``new_files_only`` treats it as a
    folder of deliveries: only files not landed before are read, and where
    deliveries repeat a key, staging keeps the newest; ``delivered`` orders them,
    see ``land_csv``. With a ``load_number`` the deliveries are kept apart by it,
    for ``plans.delivery``. A root keeps to the mode it began with: a change is an
    error, raised before anything is written.

    ``source_table`` gives a database table by name, such as
    ``partial(read_table, spark, connection)``: ``sellers`` is read whole,
    ``inventory`` from its last mark on. ``product_metadata`` gives the products
    of the service, such as ``partial(read_payloads, spark, path)`` over landed
    answers, or ``read_csv`` with ``multiline`` over a CSV file made from them.
    """

    def write(table):
        if table == "sellers":
            return write_parquet(source_table(table), layout.raw(table))
        if table == "inventory":
            return extract_increment(
                spark, table, source_table(table), layout.snapshots, layout.control, **INVENTORY
            )
        if table == "product_metadata":
            products = product_metadata()
            unfit = [bad_record_count()] if CORRUPT in products.columns else []
            return write_parquet(products, layout.raw(table), metrics=unfit)
        path = f"{csv_root}/{table}.csv"
        if mode != EXTRACT:
            target, done = layout.deliveries(table), layout.checkpoint(table)
            return land_csv(
                spark, path, target, done, RAW[table], delivered=delivered, load_number=load_number
            )
        return write_parquet(
            read_csv(spark, path, RAW[table]), layout.raw(table), metrics=[bad_record_count()]
        )

    mode = MERGED if load_number is not None else DELIVERIES if new_files_only else EXTRACT
    claim_mode(spark, layout.modes, CSV_TABLES, mode)

    def step(table):
        # Tables of the database and the service have no files: landed once in a run.
        reads = [f"{csv_root}/{table}.csv"] if table in CSV_TABLES else []
        return journal.once(f"land.{table}", lambda: write(table), reads)

    return write_each(spark, step, STAGED_TABLES)


def raw_paths(spark: SparkSession, layout: Layout, tables: Iterable[str]) -> list[str]:
    """The folders that hold the landed tables."""
    modes = landing_modes(spark, layout.modes)
    paths = []
    for table in tables:
        if table == "inventory":
            paths += [layout.snapshots, layout.control]
        else:
            delivered = modes.get(table) in (DELIVERIES, MERGED)
            paths.append(layout.deliveries(table) if delivered else layout.raw(table))
    return paths


def raw_reader(spark: SparkSession, layout: Layout) -> Callable[[str], DataFrame]:
    """The landed tables by name, each from where its way of landing puts it."""
    modes = landing_modes(spark, layout.modes)

    def raw(table):
        delivered = modes.get(table) in (DELIVERIES, MERGED)
        return spark.read.parquet(layout.deliveries(table) if delivered else layout.raw(table))

    return raw


# How each table is made, and from which tables of the layer before.
STAGED_FROM = {
    "customers": (staging.stage_customers, ("customers",)),
    "products": (staging.stage_products, ("products", "order_items")),
    "orders": (staging.stage_orders, ("orders",)),
    "order_items": (staging.stage_order_items, ("order_items",)),
    "sellers": (staging.stage_sellers, ("sellers",)),
    "inventory": (staging.stage_inventory, ("inventory",)),
    "product_metadata": (staging.stage_product_metadata, ("product_metadata",)),
}
STAR_FROM = {
    "dim_customers": (star.dim_customers, ("customers",)),
    "dim_sellers": (star.dim_sellers, ("sellers",)),
    "dim_products": (star.dim_products, ("products", "inventory", "product_metadata")),
    "fact_sales": (star.fact_sales, ("order_items", "orders")),
}


def staged_table(name: str, raw: Callable[[str], DataFrame]) -> DataFrame:
    """The plan of a staging table over the raw tables it needs."""
    make, needs = STAGED_FROM[name]
    return make(*map(raw, needs))


def star_table(name: str, staged: Callable[[str], DataFrame]) -> DataFrame:
    """The plan of a warehouse table over the staging tables it needs."""
    make, needs = STAR_FROM[name]
    return make(*map(staged, needs))


def stage(spark: SparkSession, layout: Layout, journal: Journal | NoJournal = NoJournal()) -> Metrics:
    undated = {"orders": "order_date", "inventory": "last_updated"}
    landed = raw_reader(spark, layout)

    def raw(table):
        if table == "inventory":
            return current_snapshot(
                spark, layout.snapshots, layout.control, table, **INVENTORY
            )
        return landed(table)

    def write(table):
        date = undated.get(table)
        metrics = [F.count_if(F.col(date).isNull()).alias("undated")] if date else []
        return write_parquet(staged_table(table, raw), layout.staging(table), metrics=metrics)

    def step(table):
        return journal.once(f"stage.{table}", lambda: write(table), raw_paths(spark, layout, STAGED_FROM[table][1]))

    return write_each(spark, step, STAGED_FROM)


def check(spark: SparkSession, layout: Layout, allowed_rejects: int = 0) -> None:
    """Raise when a staged table is empty or misses keys; nothing after this runs then.

    So do more than ``allowed_rejects`` raw lines of a table whose key could not
    be read, which staging has dropped.
    """
    staged = key_report({t: spark.read.parquet(layout.staging(t)) for t in STAGED_TABLES})
    raw = raw_reader(spark, layout)
    landed = {t: raw(t) for t in (*CSV_TABLES, "product_metadata")}
    gate(staged.unionByName(reject_report(landed, CORRUPT, allowed_rejects)))


def build_star(spark: SparkSession, layout: Layout) -> Metrics:
    """Write all star tables, then publish them together.

    Until then, and if the run is cut off, readers see the star as it was.
    """
    coming = catalog.version_of(spark, layout.manifest, STAR_LAYER).next(built_from=0)
    parts: dict[str, list[Part]] = {}

    def write(table):
        df = star_table(table, lambda name: spark.read.parquet(layout.staging(name)))
        months = MONTHS if table == "fact_sales" else ()
        path = catalog.folder_of(layout.star, table, coming.number)
        metrics = write_parquet(df, path, partition_by=months)
        rows = metrics["row_count"]
        parts[table] = catalog.written_parts(spark, layout.star, table, coming.number, rows, months)
        return metrics

    written = write_each(spark, write, STAR_FROM)
    catalog.publish(spark, layout.manifest, coming.having(p for t in STAR_FROM for p in parts[t]))
    return written


def read_star(
    spark: SparkSession, layout: Layout, version: Version | None = None
) -> Callable[[str], DataFrame]:
    """The star tables by name, all of one published version, by default the newest."""
    version = version or catalog.version_of(spark, layout.manifest, STAR_LAYER)
    if not version.number:
        raise LookupError(f"no star was published below {layout.root}")

    def table(name: str) -> DataFrame:
        months = MONTHS if name == "fact_sales" else ()
        return catalog.read_parts(spark, layout.star, version.of(name), STAR[name], months)

    return table


def load(
    spark: SparkSession,
    layout: Layout,
    sink: Callable[[DataFrame, str], int],
    journal: Journal | NoJournal = NoJournal(),
) -> Mapping[str, int]:
    """Hand every star table to ``sink``, one after the other, to spare the database.

    All are of one version, also while another run publishes the next.
    """
    version = catalog.version_of(spark, layout.manifest, STAR_LAYER)
    star_of = read_star(spark, layout, version if version.number else None)

    def step(table):
        done = journal.once(f"load.{table}", lambda: {"rows": sink(star_of(table), table)}, state=str(version.number))
        return done["rows"]

    return {t: step(t) for t in STAR_TABLES}


def run_daily(
    spark: SparkSession,
    layout: Layout,
    csv_root: str,
    source_table: Callable[[str], DataFrame],
    product_metadata: Callable[[], DataFrame],
    sink: Callable[[DataFrame, str], int] | None = None,
    new_files_only: bool = False,
    delivered: Column | None = None,
    allowed_rejects: int = 0,
    run: str | None = None,
) -> Metrics:
    """All steps in order; a failed check stops the run before the star is touched.

    With the name of a ``run``, such as the day, finished steps are noted in a journal: when a
    run that was cut off is repeated under its name, it skips the steps that are done and whose
    input has not changed since. See ``plans.journal``.

    Returns what was written: of staging and star under the tables' names, of
    the raw layer under ``raw.<table>``.
    """
    journal = Journal(spark, layout.journal, run) if run else NoJournal()
    landed = land(
        spark, layout, csv_root, source_table, product_metadata, new_files_only, delivered, journal=journal
    )
    written = {f"raw.{table}": metrics for table, metrics in landed.items()}
    written.update(stage(spark, layout, journal))
    staged = [layout.staging(t) for t in STAGED_TABLES]
    checked = [*staged, *raw_paths(spark, layout, [*CSV_TABLES, "product_metadata"])]
    journal.once("check", lambda: check(spark, layout, allowed_rejects), checked, str(allowed_rejects))
    written.update(journal.once("star", lambda: build_star(spark, layout), staged))
    if sink:
        load(spark, layout, sink, journal)
    return written
