"""Deliveries merged into staging and star, against the full run over the same files."""

import pytest

from shelfmark import cli
from shelfmark.operators.quality import DataQualityError
from shelfmark.plans import delivery, refresh
from shelfmark.plans.delivery import STAGING_LAYER, land_deliveries, stage, staged_reader
from shelfmark.plans.refresh import STAGED_TABLES, STAR_LAYER, STAR_TABLES, Layout, read_star
from shelfmark.sources import catalog
from shelfmark.sources.control import LandingModeError
from shelfmark.streaming.landing import by_file_name, land_csv
from shelfmark.schemas import RAW
from test_refresh import LINES, ORDERS, Drop, Shop

CUSTOMERS = "customer_id,customer_unique_id\n"
PRODUCTS = "product_id,product_category_name\n"


@pytest.fixture
def shop(spark, tmp_path, conf):
    conf(shuffle__partitions="2")  # a handful of rows: fewer tasks and files
    (tmp_path / "in").mkdir()
    return Shop(spark, tmp_path)


class Merged(Drop):
    """Deliveries that are merged, and the full run over them below another root."""

    def __init__(self, shop):
        super().__init__(shop)
        self.spark, self.layout = shop.spark, shop.layout
        self.full = Layout(str(shop.root / "full"))
        self.number = 0

    def name_by_order(self, name, order, text):
        """A file whose name tells its place among the deliveries."""
        folder = self.folder / f"{name}.csv"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{order}.csv").write_text(text)

    def run(self, **options):
        return delivery.run_deliveries(
            self.spark, self.layout, str(self.folder), self.shop.table, self.shop.products,
            delivered=by_file_name(), **options,
        )

    def tables(self):
        staged, star = staged_reader(self.spark, self.layout), read_star(self.spark, self.layout)
        return {t: staged(t) for t in STAGED_TABLES} | {t: star(t) for t in STAR_TABLES}

    def full_tables(self):
        args = (self.spark, self.full, str(self.folder), self.shop.table, self.shop.products)
        refresh.land(*args, new_files_only=True, delivered=by_file_name())
        refresh.stage(self.spark, self.full)
        refresh.build_star(self.spark, self.full)
        star = read_star(self.spark, self.full)
        staged = {t: self.spark.read.parquet(self.full.staging(t)) for t in STAGED_TABLES}
        return staged | {t: star(t) for t in STAR_TABLES}

    def months(self, layer, table):
        version = catalog.version_of(self.spark, self.layout.manifest, layer)
        return {p.partition: p.path for p in version.of(table)}


@pytest.fixture
def drop(shop):
    return Merged(shop)


def month(year, number):
    return f"year={year}/month={number}"


def first_delivery(drop):
    drop("customers", CUSTOMERS + "c2,u2\n")
    drop("products", PRODUCTS + "p2,\np3,books\n")
    drop(
        "orders",
        ORDERS + "o1,c1,paid,2018-01-05 10:00:00\no2,c1,paid,2018-02-05 10:00:00\no3,c2,paid,2018-03-05 10:00:00\n"
        "o4,c2,paid,\n",
    )
    drop(
        "order_items",
        LINES + "o1,1,p1,s1,10.0,1.0\no1,2,p1,s1,30.0,1.0\no1,2,p1,s1,30.0,1.0\no2,1,p2,s1,5.0,1.0\n"
        "o3,1,p1,s1,7.5,1.0\no4,1,p3,s1,8.0,1.0\no8,1,p3,s1,2.0,1.0\n",
    )


def assert_equal(drop, rows):
    ours, theirs = drop.tables(), drop.full_tables()
    for name in theirs:
        assert ours[name].columns == theirs[name].columns, name
        assert dict(ours[name].dtypes) == dict(theirs[name].dtypes), name
        assert rows(ours[name]) == rows(theirs[name]), name


def test_deliveries_end_as_the_full_run(drop, rows):
    first_delivery(drop)
    drop.run()
    assert_equal(drop, rows)

    # A moved and a re-stated order, a corrected line, a new month, an order for a line that waited, and
    # a product that was sold before it was known.
    drop("orders", ORDERS + "o2,c1,sent,2018-03-09 00:00:00\no5,c2,paid,2018-05-01 00:00:00\no8,c2,paid,2018-01-09 00:00:00\n")
    drop("order_items", LINES + "o1,2,p1,s1,31.0,1.0\no5,1,p9,s1,4.0,1.0\no5,2,p1,s1,0.25,1.0\n")
    drop.run()
    assert_equal(drop, rows)
    fact = read_star(drop.spark, drop.layout)("fact_sales")
    assert rows(fact, "order_id", "quantity", "month") == [
        ("o1", 1, 1), ("o1", 2, 1), ("o2", 1, 3), ("o3", 1, 3), ("o4", 1, None), ("o5", 1, 5), ("o5", 2, 5), ("o8", 1, 1),
    ]
    assert set(drop.months(STAR_LAYER, "fact_sales")) == {month(2018, 1), month(2018, 3), month(2018, 5), delivery.UNDATED}

    # Only customers and products; a date that is taken back; an older file that comes late.
    drop("customers", CUSTOMERS + "c1,u1b\nc9,u9\n")
    drop("products", PRODUCTS + "p9,toys\n")
    drop("orders", ORDERS + "o3,c2,paid,\n")
    drop.name_by_order("orders", "00", ORDERS + "o1,c7,late,2018-09-09 00:00:00\no7,c7,late,2018-09-09 00:00:00\n")
    drop.name_by_order("order_items", "00", LINES + "o1,1,p1,s1,99.0,1.0\no1,3,p1,s1,99.0,1.0\n")
    drop.run()
    assert_equal(drop, rows)

    # Nothing new but the tables that are always read whole.
    before = drop.months(STAGING_LAYER, "order_items")
    drop.run()
    assert drop.months(STAGING_LAYER, "order_items") == before
    assert_equal(drop, rows)


def test_lines_without_keys_and_inexact_prices(drop, rows):
    first_delivery(drop)
    drop("order_items", LINES + ",1,p1,s1,1.0,1.0\n,1,p1,s2,2.0,1.0\no1,,p1,s1,3.0,1.0\no2,2,,s1,3.0,1.0\no2,3,p2,s1,0.3333333333,1.0\n")
    drop_rejects = {"allowed_rejects": 5}
    with pytest.raises(DataQualityError, match="1 rows of order_items lack order_id"):
        drop.run(**drop_rejects)
    refresh_staged = staged_reader(drop.spark, drop.layout)
    full = drop.full_tables()
    for name in STAGED_TABLES:
        assert rows(refresh_staged(name)) == rows(full[name]), name
    # The inexact line is replaced by an exact one; the keyless ones stay in the means, a newer one takes the place.
    drop("order_items", LINES + "o2,3,p2,s1,0.5,1.0\n,1,p1,s3,4.0,1.0\no1,,p1,s1,3.5,1.0\n")
    land_deliveries(drop.spark, drop.layout, str(drop.folder), drop.shop.table, drop.shop.products, by_file_name())
    stage(drop.spark, drop.layout)
    refresh_staged = staged_reader(drop.spark, drop.layout)
    full = drop.full_tables()
    for name in STAGED_TABLES:
        assert rows(refresh_staged(name)) == rows(full[name]), name


def test_untouched_months_are_neither_read_nor_written(drop, monkeypatch):
    first_delivery(drop)
    drop.run()
    before = {(layer, t): drop.months(layer, t) for layer, t in
              ((STAGING_LAYER, "orders"), (STAGING_LAYER, "order_items"), (STAR_LAYER, "fact_sales"))}
    drop("orders", ORDERS + "o2,c1,sent,2018-03-09 00:00:00\n")
    opened = []
    real = catalog.read_parts
    monkeypatch.setattr(catalog, "read_parts", lambda s, path, parts, *a: opened.extend(parts) or real(s, path, parts, *a))
    drop.run()
    touched = {month(2018, 2), month(2018, 3), delivery.UNDATED}
    sales = {p.partition for p in opened if p.table in ("orders", "order_items") and p.path}
    assert sales <= touched
    for (layer, table), parts in before.items():
        now = drop.months(layer, table)
        assert now[month(2018, 1)] == parts[month(2018, 1)], table
        assert month(2018, 2) not in now and now[month(2018, 3)] != parts[month(2018, 3)], table
    staging_now = catalog.version_of(drop.spark, drop.layout.manifest, STAGING_LAYER)
    fact = delivery.fact_of_months(drop.spark, drop.layout, staging_now, {month(2018, 3)})
    assert fact.inputFiles() and all("year=2018/month=3" in f for f in fact.inputFiles())


def fail_at(monkeypatch, module, name, nth):
    """The nth call of a function fails, as if the run were killed there."""
    real, calls = getattr(module, name), []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == nth:
            raise KeyboardInterrupt(f"killed in {name}")
        return real(*args, **kwargs)

    monkeypatch.setattr(module, name, failing)


@pytest.mark.parametrize("where, nth", [
    ("write_parquet", 9), ("check", 1),
])
def test_a_killed_run_is_made_up_for(drop, rows, monkeypatch, where, nth):
    first_delivery(drop)
    drop.run()
    star_before = {t: rows(read_star(drop.spark, drop.layout)(t)) for t in STAR_TABLES}
    drop("orders", ORDERS + "o2,c1,sent,2018-03-09 00:00:00\n")
    drop("order_items", LINES + "o1,2,p1,s1,31.0,1.0\n")
    with monkeypatch.context() as patch:
        fail_at(patch, delivery, where, nth)
        with pytest.raises(KeyboardInterrupt):
            drop.run()
        assert star_before == {t: rows(read_star(drop.spark, drop.layout)(t)) for t in STAR_TABLES}
    drop("order_items", LINES + "o3,1,p1,s1,8.5,1.0\n")
    drop.run()
    assert_equal(drop, rows)


def test_a_failed_check_keeps_rejects_in_view(drop, rows):
    first_delivery(drop)
    drop.run()
    drop("order_items", LINES + "o1,x,p1,s1,1.0,1.0\n")
    for _ in range(2):  # also when the next run lands nothing new
        with pytest.raises(DataQualityError, match="1 rejected by key_readable on order_items.order_item_id"):
            drop.run()
    drop.run(allowed_rejects=1)
    drop.run()  # they are part of the star now
    assert_equal(drop, rows)


def test_merged_roots_keep_to_their_mode(drop):
    first_delivery(drop)
    drop.run()
    with pytest.raises(LandingModeError, match="as merged"):
        drop.land()


def test_many_index_folders_become_one(drop, rows, monkeypatch):
    monkeypatch.setattr(delivery, "INDEX_FOLDERS", 2)
    first_delivery(drop)
    for n in range(1, 4):
        drop("orders", ORDERS + f"o1,c1,paid,2018-0{n}-05 10:00:00\n")
        drop.run()
    assert len(drop.months(STAGING_LAYER, delivery.INDEX)) == 1
    version = catalog.version_of(drop.spark, drop.layout.manifest, STAGING_LAYER)
    assert 1 <= len(version.of(delivery.INDEX)) <= 2
    assert_equal(drop, rows)


def test_the_steps_as_commands(drop, shop, spark, rows, monkeypatch):
    monkeypatch.setattr(cli, "read_table", lambda spark, connection, name, split: shop.table(name))
    monkeypatch.setattr(cli, "load_table", lambda df, connection, table, n: shop.loaded.update({table: df.count()}))
    first_delivery(drop)
    for step in ("land", "stage", "check", "star", "load"):
        cli.run(spark, [step, "--merge", "--root", shop.layout.root, "--csv", str(drop.folder), "--delivery-order", "name",
                        "--answers", str(shop.root / "in" / "answers"), "--jdbc", "url=jdbc:x://db/shop"])
    assert_equal(drop, rows)
    assert shop.loaded["fact_sales"] == 5


def test_all_star_tables_change_at_once(shop, rows, monkeypatch):
    """The full run: killed between tables it leaves the star readable as it was, as a whole."""
    shop.run()
    before = {t: rows(shop.star(t)) for t in STAR_TABLES}
    shop.csv["customers"] = [("c5", "u5"), ("c1", "x")]
    shop.csv["order_items"] = [("o1", 1, "p1", "s1", 99.0, 1.0)]
    for nth in (2, 4):
        with monkeypatch.context() as patch:
            real, calls = refresh.star_table, []

            def failing(name, staged):
                calls.append(name)
                if len(calls) == nth:
                    raise RuntimeError("killed")
                return real(name, staged)

            patch.setattr(refresh, "star_table", failing)
            with pytest.raises(RuntimeError, match="killed"):
                shop.run()
        assert before == {t: rows(shop.star(t)) for t in STAR_TABLES}
    shop.run()
    assert rows(shop.star("fact_sales"), "sale_amount") == [(99.0,)]


def test_a_reader_keeps_its_version(shop, rows):
    shop.run()
    star = read_star(shop.spark, shop.layout)
    shop.csv["order_items"] = [("o1", 1, "p1", "s1", 99.0, 1.0)]
    loaded = {}

    def sink(df, name):  # the next star is published while this one is loaded
        if name == "dim_customers":
            shop.run()
        loaded[name] = df.count()
        return loaded[name]

    assert star("fact_sales").count() == 3
    refresh.load(shop.spark, shop.layout, sink)
    assert loaded["fact_sales"] == 3
    assert star("fact_sales").count() == 3 and shop.star("fact_sales").count() == 1


def test_a_star_without_sales_or_dates(shop, rows):
    with pytest.raises(LookupError, match="no star was published"):
        shop.star("fact_sales")
    shop.csv["orders"] = [("o1", "c1", "done", None)]
    shop.run()
    assert rows(shop.star("fact_sales"), "order_id", "year", "month") == [("o1", None, None)] * 2
    shop.csv["orders"] = [("o7", "c1", "done", None)]
    shop.run()
    assert shop.star("fact_sales").count() == 0
    assert dict(shop.star("fact_sales").dtypes)["year"] == "int"


def test_versions_are_found_by_number(spark, tmp_path):
    manifest = str(tmp_path / "manifest")
    assert catalog.version_of(spark, manifest, "x") == catalog.Version("x")
    parts = (catalog.Part("t", "", "t/run=1", 3), catalog.Part("u", month(1, 2), "u/run=1/year=1/month=2", 4, 1))
    first = catalog.Version("x").next(7).having(parts)
    catalog.publish(spark, manifest, first)
    assert catalog.version_of(spark, manifest, "x") == first
    second = first.next(8).having([parts[0], catalog.Part("u", month(1, 3), "u/run=2/year=1/month=3", 4)])
    catalog.publish(spark, manifest, second)
    assert catalog.version_of(spark, manifest, "x") == second
    assert catalog.version_of(spark, manifest, "x", 1) == first
    assert second.changed_since(first, "u") == {month(1, 2), month(1, 3)} and not second.changed_since(first, "t")
    with pytest.raises(LookupError):
        catalog.version_of(spark, manifest, "x", 9)
    with pytest.raises(ValueError, match="without tables"):
        catalog.publish(spark, manifest, catalog.Version("x", 3))


def test_landing_counts_all_its_batches(spark, tmp_path):
    source = tmp_path / "orders.csv"
    source.mkdir()
    for n in range(105):
        (source / f"{n}.csv").write_text(ORDERS + f"o{n},c1,paid,2018-01-05 10:00:00\n")
    counted = land_csv(
        spark, str(source), str(tmp_path / "out"), str(tmp_path / "done"), RAW["orders"], files_per_batch=1
    )
    assert counted == {"row_count": 105, "bad_records": 0}
