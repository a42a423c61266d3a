"""JDBC options and slices. No database is started: reading and loading are not run here."""

import datetime

import pytest
from pyspark.sql import functions as F

from shelfmark.sinks import jdbc as sink
from shelfmark.sources import jdbc as source
from shelfmark.workload import inputs

CONNECTION = {"url": "jdbc:postgresql://db/shop", "user": "u", "driver": "org.postgresql.Driver"}


class Recorder:
    """Stands in for a DataFrameReader or -Writer and notes what was set."""

    def __init__(self):
        self.set = {}

    def format(self, name):
        return self.options(format=name)

    def mode(self, name):
        return self.options(mode=name)

    def option(self, key, value):
        return self.options(**{key: value})

    def options(self, **options):
        self.set.update(options)
        return self

    def jdbc(self, url, table, **options):
        return self.options(url=url, table=table, **options)

    def save(self):
        self.saved = True


class Session:
    def __init__(self):
        self.read = Recorder()


def test_whole_table_options():
    session = Session()
    source.table_reader(session, CONNECTION, "sellers")
    assert session.read.set == {**CONNECTION, "format": "jdbc", "dbtable": "sellers", "fetchsize": 10_000}


def test_split_table_options():
    session = Session()
    split = source.Split("last_updated", datetime.date(2017, 1, 1), datetime.date(2018, 1, 1), 16)
    source.table_reader(session, CONNECTION, "inventory", split)
    assert session.read.set["partitionColumn"] == "last_updated"
    assert session.read.set["lowerBound"] == "2017-01-01"
    assert session.read.set["upperBound"] == "2018-01-01"
    assert session.read.set["numPartitions"] == "16"


def test_sliced_table_options():
    session = Session()
    source.read_slices(session, CONNECTION, "inventory", ["a < 1", "a >= 1"])
    assert session.read.set == {
        "url": CONNECTION["url"], "table": "inventory", "predicates": ["a < 1", "a >= 1"],
        "properties": {"user": "u", "driver": "org.postgresql.Driver"},
    }


def test_load_options():
    class Table:
        write = Recorder()

    sink.table_writer(Table, CONNECTION, "fact_sales", connections=4)
    assert Table.write.set == {
        **CONNECTION, "format": "jdbc", "mode": "overwrite", "dbtable": "fact_sales",
        "truncate": True, "numPartitions": 4, "batchsize": 10_000,
    }


@pytest.mark.parametrize("stored, fails", [(3, False), (4, True)])
def test_load_compares_row_counts(spark, monkeypatch, stored, fails):
    """The writer is replaced by one that only runs the plan."""

    def run_only(df, *_, **__):
        return df.write.format("noop").mode("overwrite")

    monkeypatch.setattr(sink, "table_writer", run_only)
    asked = []

    def count(_, connection, table):
        asked.append(table)
        return spark.createDataFrame([(stored,)], "stored long")

    monkeypatch.setattr(sink, "read_table", count)
    if fails:
        with pytest.raises(sink.LoadMismatch, match="sent 3 rows, found 4"):
            sink.load_table(spark.range(3), CONNECTION, "t")
    else:
        assert sink.load_table(spark.range(3), CONNECTION, "t") == 3
    assert asked == ["(SELECT COUNT(*) AS stored FROM t) counted"]


def test_read_since_filters_at_the_source(spark, sf_dir, monkeypatch, rows):
    inventory = inputs.inventory(spark, sf_dir)
    monkeypatch.setattr(source, "read_table", lambda *_: inventory)
    mark = datetime.date(2017, 1, 5)
    at_least = source.read_since(spark, CONNECTION, "inventory", "last_updated", mark)
    later = source.read_since(
        spark, CONNECTION, "inventory", "last_updated", mark, inclusive=False
    )
    assert at_least.agg(F.min("last_updated")).first()[0] == mark
    assert later.agg(F.min("last_updated")).first()[0] == datetime.date(2017, 1, 6)


@pytest.mark.parametrize("days", [1, 3, 30])
def test_slices_hold_every_row_once(spark, sf_dir, days):
    first, last = datetime.date(2017, 1, 3), datetime.date(2017, 1, 8)
    table = inputs.inventory(spark, sf_dir).withColumn(
        "last_updated", F.when(F.col("stock_quantity") != 7, F.col("last_updated"))
    )
    slices = source.date_slices("last_updated", first, last, days)
    hits = sum(F.coalesce(F.expr(s).cast("int"), F.lit(0)) for s in slices)
    assert [r.hits for r in table.select(hits.alias("hits")).distinct().collect()] == [1]
