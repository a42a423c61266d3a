"""A run that is cut off, and repeated under its name."""

import pytest
from test_refresh import Shop

from shelfmark.plans import journal, refresh
from shelfmark.plans.journal import Journal, fingerprint
from shelfmark.plans.refresh import STAR_TABLES


# The star of a run that was not cut off, made once for all tests.
IN_ONE_GO = {}


class CutOff(Exception):
    pass


@pytest.fixture
def shop(spark, tmp_path):
    (tmp_path / "in").mkdir()
    shop = Shop(spark, tmp_path)
    shop.write_sources()
    return shop


def run(shop, taken, cut=None, half=False, monkeypatch=None):
    """A run that notes the steps it takes; it is cut off after ``cut``, before its entry if ``half``."""
    whole_entry = Journal._enter

    def enter(self, step, inputs, metrics):
        taken.append(step)
        if step == cut and half:
            raise CutOff(step)
        whole_entry(self, step, inputs, metrics)
        if step == cut:
            raise CutOff(step)

    loaded = []

    def sink(df, table):
        loaded.append(table)
        return df.count()

    monkeypatch.setattr(journal.Journal, "_enter", enter)
    try:
        return refresh.run_daily(
            shop.spark, shop.layout, str(shop.root / "in"), shop.table, shop.products, sink=sink, run="monday"
        ), loaded
    finally:
        monkeypatch.setattr(journal.Journal, "_enter", whole_entry)


def contents(shop, rows):
    return {t: rows(shop.star(t)) for t in STAR_TABLES}


@pytest.mark.parametrize("cut, half", [("land.orders", True), ("stage.order_items", False), ("star", True), ("load.dim_sellers", False)])
def test_a_second_run_takes_only_what_is_needed(shop, rows, monkeypatch, cut, half):
    first, second = [], []
    with pytest.raises(CutOff):
        run(shop, first, cut, half, monkeypatch)
    written, _ = run(shop, second, monkeypatch=monkeypatch)
    done = set(first) - ({cut} if half else set())
    # What reads the output of a repeated step is taken again; nothing else is.
    assert not done & set(second)
    assert done | set(second) >= {"check", "star", *(f"load.{t}" for t in STAR_TABLES)}
    # The metrics of skipped steps are those that were noted.
    assert written["customers"]["row_count"] == 2 and written["raw.orders"]["row_count"] == 2
    whole = contents(shop, rows)
    if not IN_ONE_GO:
        refresh.run_daily(shop.spark, shop.layout, str(shop.root / "in"), shop.table, shop.products)
        IN_ONE_GO.update(contents(shop, rows))
    assert whole == IN_ONE_GO


def test_steps_with_changed_input_are_taken_again(shop, rows, monkeypatch):
    run(shop, [], monkeypatch=monkeypatch)
    again = []
    _, loaded = run(shop, again, monkeypatch=monkeypatch)
    assert again == [] and loaded == []
    shop.csv["customers"].append(("c3", "u3"))
    shop.write_sources()
    again = []
    run(shop, again, monkeypatch=monkeypatch)
    # All source files are new, so are the tables made of them; sellers and inventory have none.
    assert {"land.customers", "stage.customers", "check", "star"} <= set(again)
    assert not {"land.sellers", "stage.sellers", "land.inventory", "stage.inventory"} & set(again)
    assert len(contents(shop, rows)["dim_customers"]) == 3


def test_fingerprints_follow_the_files(spark, tmp_path):
    one = tmp_path / "one"
    spark.range(5).coalesce(1).write.parquet(str(one))
    before = fingerprint(spark, [str(one)])
    assert before == fingerprint(spark, [str(one)]) != fingerprint(spark, []) == ""
    spark.range(1).coalesce(1).write.mode("append").parquet(str(one))
    assert fingerprint(spark, [str(one)]) != before
    plan = spark.read.format("binaryFile").load(str(one)).select("path", "length")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
