"""Marks, deltas, upserts and versioned snapshots (FIXTURES.md E15)."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import incremental
from shelfmark.operators.dedup import latest_per_key
from shelfmark.plans.incremental import (
    base_path,
    current_snapshot,
    delta_path,
    extract_increment,
)
from shelfmark.sources.control import Commit, append_commit, last_commit, read_control

DAY = datetime.date
STOCK = "product_id string, stock_quantity int, warehouse_location string, last_updated date"


def day(n):
    return DAY(2017, 1, n)


def stock(spark, *rows):
    return spark.createDataFrame(list(rows), STOCK)


INVENTORY = {"keys": ["product_id"], "changed": "last_updated"}


class Extract:
    """Loads of an inventory table into a folder of its own."""

    def __init__(self, spark, folder):
        self.spark, self.limits = spark, {}
        self.root, self.control = str(folder / "snap"), str(folder / "control")

    def __call__(self, table):
        return extract_increment(
            self.spark, "inventory", table, self.root, self.control, **INVENTORY, **self.limits
        )

    def current(self):
        return current_snapshot(self.spark, self.root, self.control, "inventory", **INVENTORY)


@pytest.fixture
def extract(spark, tmp_path):
    return Extract(spark, tmp_path)


@pytest.fixture(params=["merged when read", "merged when loaded"])
def rebase(request, extract):
    """Whether loads leave deltas behind or always write a new base."""
    always = request.param == "merged when loaded"
    extract.limits["rebase_share"] = 0 if always else 1e9
    return always


BROADCAST = pytest.mark.parametrize("threshold", ["10m", "-1"])


@BROADCAST
def test_upsert_equals_replacing_row_by_row(spark, rows, conf, threshold):
    conf(autoBroadcastJoinThreshold=threshold)
    draw = random.Random(7)

    def some(n):
        return [
            (f"p{draw.randrange(40)}", draw.randrange(100), f"WH{draw.randrange(5)}",
             draw.choice([None, *(day(i) for i in range(1, 9))]))
            for _ in range(n)
        ]

    for _ in range(3):
        snapshot = latest_per_key(stock(spark, *some(80)), ["product_id"], "last_updated")
        delta = stock(spark, *some(50))
        expected = {r[0]: tuple(r) for r in snapshot.collect()}
        for row in latest_per_key(delta, ["product_id"], "last_updated").collect():
            old = expected.get(row[0])
            if old is None or old[3] is None or (row[3] is not None and row[3] >= old[3]):
                expected[row[0]] = tuple(row)
        merged = incremental.upsert(snapshot, delta, ["product_id"], "last_updated")
        assert rows(merged) == rows(stock(spark, *expected.values()))


@BROADCAST
def test_older_delta_row_does_not_replace(spark, rows, conf, threshold):
    conf(autoBroadcastJoinThreshold=threshold)
    snapshot = stock(spark, ("a", 1, "W", day(5)), ("b", 1, "W", day(5)), ("c", 1, "W", None))
    delta = stock(
        spark, ("a", 2, "W", day(4)), ("b", 2, "W", day(5)), ("c", 2, "W", None),
        ("d", 2, "W", day(1)), (None, 2, "W", day(9)),
    )
    merged = incremental.upsert(snapshot, delta, ["product_id"], "last_updated")
    assert rows(merged, "product_id", "stock_quantity") == [("a", 1), ("b", 2), ("c", 2), ("d", 2)]


def test_delta_or_full(spark, rows):
    table = stock(spark, ("a", 1, "W", day(1)), ("b", 1, "W", day(3)), ("c", 1, "W", None))
    newer = incremental.delta_or_full(table, "last_updated", day(2))
    assert rows(newer, "product_id") == [("b",)]
    everything = incremental.delta_or_full(table, "last_updated", day(3))
    assert rows(everything, "product_id") == [("a",), ("b",), ("c",)]


def test_control_table(spark, tmp_path):
    path = str(tmp_path / "control")
    first = Commit("s", datetime.datetime(1900, 1, 1), 0, 0, 0, 0)
    assert last_commit(spark, path, "s") == first
    for version in (1, 2):
        stamp = datetime.datetime(2020, 1, version, 1, 2, 3)
        append_commit(spark, path, Commit("s", stamp, version, 1, 10, version))
    append_commit(spark, path, Commit("other", datetime.datetime(2021, 1, 1), 7, 7, 1, 0))
    stamp = datetime.datetime(2020, 1, 2, 1, 2, 3)
    assert last_commit(spark, path, "s") == Commit("s", stamp, 2, 1, 10, 2)
    assert incremental.watermark_of(read_control(spark, path), "s").first().watermark == stamp


def test_first_load_then_changes(spark, rows, extract, rebase):
    with pytest.raises(LookupError):
        extract.current()
    first = extract(
        stock(spark, ("a", 1, "W", day(1)), ("b", 1, "W", day(2)), (None, 1, "W", day(2)))
    )
    assert (first.version, first.base_rows) == (1, 2)
    assert first.watermark == datetime.datetime(2017, 1, 2)
    # The source now has a changed row stamped at the mark, a new one, and an
    # old one that only a full load would see.
    second = extract(
        stock(spark, ("b", 7, "W", day(2)), ("c", 3, "W", day(4)), ("z", 9, "W", day(1)))
    )
    assert (second.version, second.watermark) == (2, datetime.datetime(2017, 1, 4))
    assert (second.base, second.base_rows, second.changes) == ((2, 3, 0) if rebase else (1, 2, 2))
    assert rows(extract.current(), "product_id", "stock_quantity") == [
        ("a", 1), ("b", 7), ("c", 3),
    ]


def test_later_load_wins_at_the_same_stamp(spark, rows, extract, rebase):
    for quantity in (5, 9, 2):
        extract(stock(spark, ("a", quantity, "W", day(1)), ("b", 1, "W", day(1))))
        assert rows(extract.current(), "product_id", "stock_quantity") == [
            ("a", quantity), ("b", 1),
        ]


def test_empty_delta_changes_nothing(spark, rows, extract, rebase):
    first = extract(stock(spark, ("a", 1, "W", day(3))))
    assert extract(stock(spark)) == first
    assert rows(extract.current(), "product_id") == [("a",)]


def test_many_deltas_are_merged_into_a_new_base(spark, rows, extract):
    extract.limits = {"rebase_share": 1e9, "rebase_deltas": 2}
    bases = [extract(stock(spark, (f"p{i}", i, "W", day(i)))).base for i in range(1, 6)]
    assert bases == [1, 1, 1, 4, 4]
    assert rows(extract.current(), "product_id") == [(f"p{i}",) for i in range(1, 6)]


def test_state_does_not_follow_the_source(spark, rows, extract, rebase, tmp_path):
    """Once loaded, rows are kept apart from a source that changes or goes away."""
    path = str(tmp_path / "source")
    for load in (1, 2, 3):
        stock(spark, ("a", load, "W", day(load)), ("b", 1, "W", day(1))).write.mode(
            "overwrite"
        ).parquet(path)
        extract(spark.read.parquet(path))
    stock(spark).write.mode("overwrite").parquet(path)
    assert rows(extract.current(), "product_id", "stock_quantity") == [("a", 3), ("b", 1)]


def test_unfinished_load_is_not_read_and_is_repeated(spark, rows, extract, rebase):
    extract(stock(spark, ("a", 1, "W", day(3))))
    for path in (base_path, delta_path):
        junk = stock(spark, ("junk", 0, "W", day(9)))
        junk.write.parquet(path(extract.root, "inventory", 2))
    assert rows(extract.current(), "product_id") == [("a",)]
    extract(stock(spark, ("b", 1, "W", day(4))))
    assert rows(extract.current(), "product_id") == [("a",), ("b",)]
    assert read_control(spark, extract.control).count() == 2


def test_changes_without_a_stamp_arrive(spark, rows, extract, rebase):
    extract(stock(spark, ("a", 1, "W", day(1)), ("b", 1, "W", None), ("c", 1, "W", None)))
    same = extract(stock(spark, ("b", 1, "W", None), ("c", 1, "W", None)))
    assert same.version == 1
    extract(stock(spark, ("a", 9, "W", None), ("b", 2, "W", None), ("c", 1, "W", None), ("d", 1, "W", None)))
    assert rows(extract.current(), "product_id", "stock_quantity") == [
        ("a", 1), ("b", 2), ("c", 1), ("d", 1),
    ]


def test_increments_end_where_a_full_load_ends(spark, rows, extract, rebase):
    draw = random.Random(3)
    table = {}
    for step in range(1, 5):
        for _ in range(10):
            key = f"p{draw.randrange(25)}"
            table[key] = (key, draw.randrange(100), "W", day(step))
        extract(stock(spark, *table.values()))
    assert rows(extract.current()) == sorted(table.values())


def test_stamps_must_be_times(extract, spark):
    with pytest.raises(TypeError, match="inventory.last_updated is string"):
        extract(stock(spark, ("a", 1, "W", day(1))).withColumn("last_updated", F.lit("soon")))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_stamps_with_a_time_of_day(extract, spark, rows, kind):
    def at(*stamps):
        table = spark.createDataFrame(list(stamps), "product_id string, last_updated string")
        return table.withColumn("last_updated", F.col("last_updated").cast(kind))

    extract(at(("a", "2017-01-01 10:00:00.000001"), ("b", "2017-01-01 09:00:00")))
    commit = extract(at(("c", "2017-01-01 10:00:00.000001"), ("d", "2017-01-01 10:00:00")))
    assert commit.watermark == datetime.datetime(2017, 1, 1, 10, 0, 0, 1)
    assert rows(extract.current(), "product_id") == [("a",), ("b",), ("c",)]


def test_mark_keeps_its_clock_in_other_time_zones(spark, rows, extract):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        mark = datetime.datetime(2017, 1, 3)
        assert extract(stock(spark, ("a", 1, "W", day(3)))).watermark == mark
        assert extract(stock(spark, ("b", 1, "W", day(3)))).watermark == mark
        assert rows(extract.current(), "product_id") == [("a",), ("b",)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
