"""Comparing whole snapshots of a table, and the history that follows from it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.dedup import having_keys

INSERT, UPDATE, DELETE = "insert", "update", "delete"
CHANGE, FROM, TO = "change", "valid_from", "valid_to"
_DIGEST, _OLD = "__digest", "__old_"


def row_digest(df: DataFrame, keys: Sequence[str]) -> Column:
    """A digest of all columns but the keys; NULL is a value of its own."""
    rest = [F.col(f"`{name}`") for name in sorted(df.columns) if name not in keys]
    return F.sha2(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}), 256) if rest else F.lit("")


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What turns ``old`` into ``new``: the rows of ``new`` that are inserted or updated, and deleted keys.

    Both hold one row per key; rows without a key are left out. The columns are
    those of ``new`` and ``change``; a deleted row has its key and NULLs. Rows are
    compared by a digest of all their columns, whatever columns the old snapshot
    had: a column that is new changes every row. One full outer join, to which
    the old snapshot brings keys and digests only.
    """
    before = having_keys(old, *keys).select(
        *[F.col(k).alias(f"{_OLD}{k}") for k in keys], row_digest(old, keys).alias(f"{_OLD}{_DIGEST}")
    )
    after = having_keys(new, *keys).withColumn(_DIGEST, row_digest(new, keys))
    same_key = reduce(and_, [F.col(k) == F.col(f"{_OLD}{k}") for k in keys])
    was, now = F.col(f"{_OLD}{_DIGEST}"), F.col(_DIGEST)
    change = (
        F.when(was.isNull(), INSERT).when(now.isNull(), DELETE).when(was != now, UPDATE).alias(CHANGE)
    )
    kept = [
        F.coalesce(F.col(c), F.col(f"{_OLD}{c}")).alias(c) if c in keys else F.col(f"`{c}`") for c in new.columns
    ]
    return after.join(before, same_key, "full_outer").select(*kept, change).where(F.col(CHANGE).isNotNull())


def history_of(first: DataFrame, keys: Sequence[str], at: Any) -> DataFrame:
    """The history that begins with a first snapshot: every row is valid from ``at`` on."""
    dated = having_keys(first, *keys)
    return dated.withColumns({FROM: F.lit(at).cast("date"), TO: F.lit(None).cast("date")})


def close_and_open(history: DataFrame, changes: DataFrame, keys: Sequence[str], at: Any) -> DataFrame:
    """The history after ``changes``: open rows of changed and deleted keys end at ``at``, new ones begin.

    A key that vanished is closed, not kept as current and not forgotten; one that
    comes back begins anew. Only changed keys are joined; Spark broadcasts them
    where they are few.
    """
    day = F.lit(at).cast("date")
    ended = changes.where(F.col(CHANGE) != INSERT).select(*[F.col(k).alias(f"{_OLD}{k}") for k in keys])
    same_key = reduce(and_, [F.col(k) == F.col(f"{_OLD}{k}") for k in keys])
    gone = F.col(f"{_OLD}{keys[0]}").isNotNull()
    open_rows, closed = history.where(F.col(TO).isNull()), history.where(F.col(TO).isNotNull())
    marked = open_rows.join(ended, same_key, "left").withColumn(TO, F.when(gone, day)).select(*history.columns)
    begun = changes.where(F.col(CHANGE) != DELETE).drop(CHANGE).withColumns({FROM: day, TO: F.lit(None).cast("date")})
    return closed.unionByName(marked).unionByName(begun, allowMissingColumns=True)


def current_rows(history: DataFrame) -> DataFrame:
    """The rows that are valid now, without the columns of the history."""
    return history.where(F.col(TO).isNull()).drop(FROM, TO)


def apply_changes(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The snapshot with inserted and updated rows put in place and deleted ones taken out."""
    touched = changes.select(*[F.col(k).alias(f"{_OLD}{k}") for k in keys])
    same_key = reduce(and_, [F.col(k) == F.col(f"{_OLD}{k}") for k in keys])
    kept = snapshot.join(touched, same_key, "left_anti")
    return kept.unionByName(changes.where(F.col(CHANGE) != DELETE).drop(CHANGE), allowMissingColumns=True)
