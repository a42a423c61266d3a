"""Snapshot comparison with deletions, and the history that follows."""

import datetime

import pytest

from shelfmark.operators.snapshots import (
    apply_changes,
    close_and_open,
    current_rows,
    history_of,
    row_digest,
    snapshot_changes,
)
from shelfmark.plans import history
from shelfmark.plans.history import read_history, record_snapshot
from shelfmark.plans.refresh import Layout
from shelfmark.sources import catalog

SCHEMA = "id string, name string, n int"
D1, D2, D3 = (datetime.date(2024, 1, d) for d in (1, 2, 3))


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def test_inserts_updates_and_deletes(spark, rows):
    old = frame(spark, [("a", "x", 1), ("b", None, 2), ("c", "z", None), ("d", "w", 4), (None, "k", 1)])
    new = frame(spark, [("a", "x", 1), ("b", "y", 2), ("c", None, None), ("e", "v", 5), (None, "k", 2)])
    changes = snapshot_changes(old, new, ["id"])
    assert rows(changes) == [
        ("b", "y", 2, "update"), ("c", None, None, "update"), ("d", None, None, "delete"), ("e", "v", 5, "insert"),
    ]
    assert rows(apply_changes(old.where("id is not null"), changes, ["id"])) == rows(new.where("id is not null"))
    assert snapshot_changes(old, old, ["id"]).count() == 0


def test_several_keys_other_columns_and_no_rows(spark, rows):
    schema = "a string, b int, `x.y` string, tags array<string>, m map<string,int>"
    old = frame(spark, [("k", 1, "p", ["t"], {"q": 1}), ("k", 2, "p", [], None)], schema)
    new = frame(spark, [("k", 1, "p", ["t"], {"q": 2}), ("k", 2, "p", [], None), ("k", 3, None, None, None)], schema)
    assert rows(snapshot_changes(old, new, ["a", "b"]), "b", "change") == [(1, "update"), (3, "insert")]
    assert snapshot_changes(frame(spark, [], schema), frame(spark, [], schema), ["a", "b"]).count() == 0
    wider = new.selectExpr("*", "1 as more")
    assert rows(snapshot_changes(new, wider, ["a", "b"]), "b", "change") == [(1, "update"), (2, "update"), (3, "update")]
    keys_only = frame(spark, [("a",)], "id string")
    assert rows(snapshot_changes(keys_only, frame(spark, [("b",)], "id string"), ["id"])) == [("a", "delete"), ("b", "insert")]


def test_the_old_snapshot_is_joined_by_digest_only(spark, tmp_path):
    frame(spark, [("a", "x", 1)]).write.parquet(str(tmp_path / "old"))
    frame(spark, [("a", "y", 1)]).write.parquet(str(tmp_path / "new"))
    old, new = (spark.read.parquet(str(tmp_path / n)) for n in ("old", "new"))
    plan = snapshot_changes(old, new, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FullOuter") == 1 and "Python" not in plan
    left = plan[plan.index("FullOuter"):]
    assert "__old_id" in left and "__old_name" not in left


def test_a_vanished_key_is_closed_and_may_come_back(spark, rows):
    first = frame(spark, [("a", "x", 1), ("b", "y", 2)])
    state = history_of(first, ["id"], "2024-01-01")
    for snapshot, day in (([("b", "y2", 2), ("c", "z", 3)], "2024-01-02"), ([("a", "x", 1), ("b", "y2", 2)], "2024-01-03")):
        changes = snapshot_changes(current_rows(state), frame(spark, snapshot), ["id"])
        state = close_and_open(state, changes, ["id"], day)
    assert rows(state) == [
        ("a", "x", 1, D1, D2), ("a", "x", 1, D3, None), ("b", "y", 2, D1, D2), ("b", "y2", 2, D2, None),
        ("c", "z", 3, D2, D3),
    ]
    assert rows(current_rows(state)) == [("a", "x", 1), ("b", "y2", 2)]


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "lake"))


def test_the_stored_history(spark, rows, layout):
    def record(data, day):
        return record_snapshot(spark, layout, "sellers", frame(spark, data), ["id"], day)

    with pytest.raises(LookupError, match="has no history"):
        read_history(spark, layout, "sellers")
    assert record([("a", "x", 1), ("b", "y", 2), ("b", "z", 9), (None, "k", 0)], "2024-01-01") == {"insert": 2}
    assert record([("b", "y", 2)], "2024-01-02") == {"delete": 1}
    closed = {p.path for p in catalog.version_of(spark, layout.manifest, "history.sellers").of("sellers.closed")}
    assert record([("b", "y", 2)], "2024-01-02") == {}
    assert record([("b", "y3", 2), ("c", None, None)], "2024-01-03") == {"update": 1, "insert": 1}
    assert rows(read_history(spark, layout, "sellers")) == [
        ("a", "x", 1, D1, D2), ("b", "y", 2, D1, D3), ("b", "y3", 2, D3, None), ("c", None, None, D3, None),
    ]
    now = {p.path for p in catalog.version_of(spark, layout.manifest, "history.sellers").of("sellers.closed")}
    assert closed < now  # closed rows stay where they are


def test_a_run_that_dies_leaves_the_history(spark, rows, layout, monkeypatch):
    record_snapshot(spark, layout, "sellers", frame(spark, [("a", "x", 1)]), ["id"], "2024-01-01")
    before = rows(read_history(spark, layout, "sellers"))
    with monkeypatch.context() as patch:
        patch.setattr(history.catalog, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            record_snapshot(spark, layout, "sellers", frame(spark, []), ["id"], "2024-01-02")
    assert rows(read_history(spark, layout, "sellers")) == before
    record_snapshot(spark, layout, "sellers", frame(spark, []), ["id"], "2024-01-02")
    assert rows(read_history(spark, layout, "sellers")) == [("a", "x", 1, D1, D2)]


def test_null_is_not_the_text_null(spark):
    a, b = (frame(spark, [("k", v, 1)]).select(row_digest(frame(spark, []), ["id"]).alias("d")).first().d for v in (None, "null"))
    assert a != b
