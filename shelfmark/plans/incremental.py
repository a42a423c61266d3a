"""Incremental extract of a source: a base snapshot and the deltas loaded since."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from shelfmark.operators.dedup import having_keys, latest_per_key, one_per_key
from shelfmark.operators.incremental import upsert
from shelfmark.sinks.files import write_parquet
from shelfmark.sources.control import Commit, append_commit, last_commit

# By default the base is written anew when the deltas since hold this share of
# its rows, or when there are this many of them.
REBASE_SHARE = 0.1
REBASE_DELTAS = 50

_LOAD = "delta"
_CONTENT = "__content"


def base_path(root: str, source: str, version: int) -> str:
    return f"{root}/{source}/base={version}"


def delta_path(root: str, source: str, version: int) -> str:
    return f"{root}/{source}/{_LOAD}={version}"


def _state(
    spark: SparkSession, root: str, commit: Commit, keys: Sequence[str], changed: str
) -> DataFrame:
    """The base with the committed deltas merged into it."""
    base = spark.read.parquet(base_path(root, commit.source, commit.base))
    loads = range(commit.base + 1, commit.version + 1)
    if not loads:
        return base
    deltas = spark.read.option("basePath", f"{root}/{commit.source}").parquet(
        *[delta_path(root, commit.source, load) for load in loads]
    )
    newest = one_per_key(having_keys(deltas, *keys), keys, newest=[changed, _LOAD]).drop(_LOAD)
    return upsert(base, newest, keys, changed, one_row_per_key=True)


def _content(df: DataFrame) -> Column:
    """A digest of all columns of a row."""
    row = F.struct(*[F.col(f"`{name}`") for name in sorted(df.columns)])
    return F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)


def current_snapshot(
    spark: SparkSession, root: str, control: str, source: str, keys: Sequence[str], changed: str
) -> DataFrame:
    """One row per key as of the last commit; files of an unfinished run are never read."""
    commit = last_commit(spark, control, source)
    if commit.version == 0:
        raise LookupError(f"{source} was never loaded")
    return _state(spark, root, commit, keys, changed)


def extract_increment(
    spark: SparkSession,
    source: str,
    table: DataFrame,
    root: str,
    control: str,
    keys: Sequence[str],
    changed: str,
    rebase_share: float = REBASE_SHARE,
    rebase_deltas: int = REBASE_DELTAS,
) -> Commit:
    """Store what changed since the last mark, then commit.

    The first load is the base. Later ones are stored as deltas, so a load costs
    what changed and not what is there; readers merge them, and once they add up
    the base is written anew next to the old one. A delta is stored before
    anything is made from it: ``table`` is read once and seen in one state.

    The mark becomes the newest stamp that was loaded, and rows stamped exactly
    at the mark are read again, so rows written later with the same stamp are
    not missed. Rows without a stamp say nothing of when they changed: all are
    read by every load, and those that differ from what is stored are loaded; a
    row with a stamp is never replaced by one without. The commit is the last
    step: a run that dies before it is repeated as a whole.

    The base is written anew when the deltas hold ``rebase_share`` of its rows,
    or when there are more than ``rebase_deltas`` of them; what is read stays
    the same.
    """
    stamp_type = table.schema[changed].dataType
    if not isinstance(stamp_type, (DateType, TimestampType, TimestampNTZType)):
        raise TypeError(f"{source}.{changed} is {stamp_type.simpleString()}, not a date or time")
    last = last_commit(spark, control, source)
    version = last.version + 1
    newest = F.max(F.col(changed).cast("timestamp_ntz")).alias("newest")
    if last.version == 0:
        first = latest_per_key(having_keys(table, *keys), keys, changed)
        written = write_parquet(first, base_path(root, source, version), metrics=[newest])
        base, base_rows, changes = version, written["row_count"], 0
    else:
        mark = F.lit(last.watermark.isoformat()).cast("timestamp_ntz").cast(stamp_type)
        delta = table.filter((F.col(changed) >= mark) | F.col(changed).isNull())
        stored = _state(spark, root, last, keys, changed).filter(F.col(changed).isNull())
        known = stored.select(_content(stored).alias(_CONTENT)).distinct()
        delta = delta.withColumn(
            _CONTENT, F.when(F.col(changed).isNull(), _content(delta))
        ).join(known, _CONTENT, "left_anti").drop(_CONTENT)
        written = write_parquet(delta, delta_path(root, source, version), metrics=[newest])
        if written["row_count"] == 0:
            return last
        base, base_rows = last.base, last.base_rows
        changes = last.changes + written["row_count"]
    watermark = max(filter(None, [last.watermark, written["newest"]]))
    commit = Commit(source, watermark, version, base, base_rows, changes)
    if changes > rebase_share * base_rows or version - base > rebase_deltas:
        merged = _state(spark, root, commit, keys, changed)
        rows = write_parquet(merged, base_path(root, source, version))["row_count"]
        commit = Commit(source, watermark, version, version, rows, 0)
    append_commit(spark, control, commit)
    return commit
