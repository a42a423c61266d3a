"""The control table: what of an incremental source is current, and its mark.

One small Parquet row is appended per committed load, after the data is
written. A crash in between leaves the old row in force, so the next run
repeats the load; loads upsert by key, so repeating one changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import astuple, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.incremental import FIRST_WATERMARK
from shelfmark.schemas import CONTROL, MODES


class LandingModeError(ValueError):
    """A table is landed in another way than before."""


@dataclass(frozen=True)
class Commit:
    source: str
    watermark: datetime
    version: int
    base: int
    base_rows: int
    changes: int


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """All commits; the table is created without rows where there is none."""
    spark.createDataFrame([], CONTROL).write.mode("ignore").parquet(path)
    return spark.read.schema(CONTROL).parquet(path)


def last_commit(spark: SparkSession, path: str, source: str) -> Commit:
    """The newest commit of a source; version 0 at the first mark when there is none."""
    rows = (
        read_control(spark, path)
        .filter(F.col("source") == source)
        .orderBy(F.col("version").desc())
        .limit(1)
        .collect()
    )
    if rows:
        return Commit(*(rows[0][name] for name in CONTROL.names))
    return Commit(source, datetime.fromisoformat(FIRST_WATERMARK), 0, 0, 0, 0)


def append_commit(spark: SparkSession, path: str, commit: Commit) -> None:
    spark.createDataFrame([astuple(commit)], CONTROL).coalesce(1).write.mode("append").parquet(path)


def landing_modes(spark: SparkSession, path: str) -> dict[str, str]:
    """How each table was landed so far; one row per table."""
    spark.createDataFrame([], MODES).write.mode("ignore").parquet(path)
    return {r.table_name: r.mode for r in spark.read.schema(MODES).parquet(path).collect()}


def claim_mode(spark: SparkSession, path: str, tables: Iterable[str], mode: str) -> None:
    """Record how the tables are landed, before anything is written.

    A whole extract replaces the raw table and deliveries add to it, so rows of
    one would hide or remove rows of the other: a change of mode is an error.
    """
    tables = list(tables)
    known = landing_modes(spark, path)
    if others := [t for t in tables if known.get(t, mode) != mode]:
        was = ", ".join(f"{t} as {known[t]}" for t in others)
        raise LandingModeError(
            f"cannot land as {mode}: landed before: {was}. Use another root folder for the new mode."
        )
    if new := [(t, mode) for t in tables if t not in known]:
        spark.createDataFrame(new, MODES).coalesce(1).write.mode("append").parquet(path)
