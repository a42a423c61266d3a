"""The history of a source that is read whole: kept by versions, with vanished rows closed."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from shelfmark.operators.dedup import having_keys, one_per_key
from shelfmark.operators.snapshots import (
    CHANGE,
    INSERT,
    close_and_open,
    current_rows,
    history_of,
    snapshot_changes,
)
from shelfmark.plans.refresh import Layout
from shelfmark.sinks.files import write_parquet
from shelfmark.sources import catalog

HISTORY_LAYER = "history"
CLOSED, OPEN = "closed", "open"


def history_path(layout: Layout) -> str:
    return f"{layout.root}/{HISTORY_LAYER}"


def _layer(source: str) -> str:
    """Every source is published by itself, so that one does not wait for another."""
    return f"{HISTORY_LAYER}.{source}"


def read_history(spark: SparkSession, layout: Layout, source: str) -> DataFrame:
    """All rows of the source with the days they were valid from and, if closed, to."""
    version = catalog.version_of(spark, layout.manifest, _layer(source))
    if not version.number:
        raise LookupError(f"{source} has no history")
    parts = version.parts
    tables = [catalog.read_parts(spark, history_path(layout), [p], None) for p in parts]
    all_rows = tables[0]
    for table in tables[1:]:
        all_rows = all_rows.unionByName(table, allowMissingColumns=True)
    return all_rows


def record_snapshot(
    spark: SparkSession, layout: Layout, source: str, table: DataFrame, keys: Sequence[str], at: Any
) -> dict[str, int]:
    """Bring the history up to the snapshot ``table`` as of day ``at``; rows by change, none if nothing changed.

    Closed rows are never written again: a version adds a folder with those it
    closes, and replaces that of the open rows. Of rows that repeat a key one
    counts, see ``one_per_key``. The version is published as the last step.
    """
    now = one_per_key(having_keys(table, *keys), keys)
    last = catalog.version_of(spark, layout.manifest, _layer(source))
    coming = last.next(built_from=0)
    path = history_path(layout)

    def written(name: str, df: DataFrame) -> catalog.Part:
        below = f"{source}.{name}"
        rows = write_parquet(df, catalog.folder_of(path, below, coming.number))["row_count"]
        return catalog.Part(below, "", f"{below}/{catalog.RUN}={coming.number}", rows)

    if not last.number:
        first = written(OPEN, history_of(now, keys, at))
        catalog.publish(spark, layout.manifest, coming.having([first]))
        return {INSERT: first.row_count}
    open_rows = catalog.read_parts(spark, path, last.of(f"{source}.{OPEN}"), None)
    work = f"{layout.root}/work/{source}_changes"
    write_parquet(snapshot_changes(current_rows(open_rows), now, keys), work)
    changes = spark.read.parquet(work)
    counts = {r[CHANGE]: r["count"] for r in changes.groupBy(CHANGE).count().collect()}
    if counts:
        history = close_and_open(open_rows, changes, keys, at)
        closed = [] if set(counts) == {INSERT} else [written(CLOSED, history.where("valid_to is not null"))]
        parts = [*last.of(f"{source}.{CLOSED}"), *closed, written(OPEN, history.where("valid_to is null"))]
        catalog.publish(spark, layout.manifest, coming.having(parts))
    return counts
