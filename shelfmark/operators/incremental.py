"""High-water marks, deltas and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.dedup import having_keys, latest_per_key

# Fixed value: the mark of a source that was never loaded.
FIRST_WATERMARK = "1900-01-01"


def delta_since(df: DataFrame, column: str, watermark: Any, inclusive: bool = False) -> DataFrame:
    """Rows changed after the mark; a plain comparison, pushed down to the source.

    ``inclusive`` also takes rows stamped exactly at the mark again. Loads that
    upsert by key use it, so rows that share the last loaded stamp are not lost.
    """
    changed = F.col(column) >= F.lit(watermark) if inclusive else F.col(column) > F.lit(watermark)
    return df.filter(changed)


def delta_or_full(df: DataFrame, column: str, watermark: Any) -> DataFrame:
    """The delta, or the whole table when nothing is newer than the mark.

    Whether there is a delta is asked first, with a job that stops at the first
    row it finds. Either plan that follows has only what the scan can use: the
    pushed comparison, or no filter.
    """
    delta = delta_since(df, column, watermark)
    return df if delta.isEmpty() else delta


def watermark_of(control: DataFrame, source: str) -> DataFrame:
    """One row: the newest committed mark of the source, or the first mark."""
    first = F.lit(FIRST_WATERMARK).cast("timestamp_ntz")
    return (
        control.filter(F.col("source") == source)
        .agg(F.coalesce(F.max("watermark"), first).alias("watermark"))
        .select(F.lit(source).alias("source"), "watermark")
    )


def advanced_watermark(delta: DataFrame, column: str, watermark: Any) -> DataFrame:
    """One row: the newest stamp extracted, never earlier than the old mark."""
    old = F.lit(watermark).cast("timestamp_ntz")
    newest = F.max(F.col(column).cast("timestamp_ntz"))
    return delta.agg(F.greatest(newest, old).alias("watermark"))


def upsert(
    snapshot: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    version: str,
    one_row_per_key: bool = False,
) -> DataFrame:
    """The snapshot with the newest delta row of every key put in place.

    ``snapshot`` holds one row per key (an earlier upsert's result, or
    ``latest_per_key``). A delta row older than the stored one loses, one of the
    same version wins, and one without a key has nothing to replace and is left
    out. ``one_row_per_key`` says that the delta holds that already.

    Spark plans the joins: where the delta's keys are few, it broadcasts them
    and the snapshot stays where it is, else both are shuffled by key, the
    snapshot once whole and once its keys and versions. Pass a stored snapshot;
    it is read twice.
    """
    newest = having_keys(delta, *keys)
    if not one_row_per_key:
        newest = latest_per_key(newest, keys, version)
    incoming = newest.select(
        *[F.col(k).alias(f"__new_{k}") for k in keys], F.col(version).alias("__new_version")
    )
    same_key = reduce(and_, [F.col(k) == F.col(f"__new_{k}") for k in keys])
    replaced = F.col(version).isNull() | F.coalesce(
        F.col("__new_version") >= F.col(version), F.lit(False)
    )
    kept = snapshot.join(incoming, same_key & replaced, "left_anti")
    outdated = snapshot.select(*keys, version).join(incoming, same_key & ~replaced, "left_semi")
    fresh = newest.join(outdated.select(*keys), list(keys), "left_anti")
    return kept.unionByName(fresh)
