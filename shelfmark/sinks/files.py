"""Parquet and CSV writers that report what they wrote."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation

from shelfmark.operators.quality import rows_metric
from shelfmark.sources.files import CSV_OPTIONS


def _observed(df: DataFrame, metrics: Sequence[Column]) -> tuple[DataFrame, Observation]:
    """Metrics are gathered by the tasks that write, so nothing is read a second time."""
    observation = Observation()
    return df.observe(observation, rows_metric(), *metrics), observation


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    only_touched_partitions: bool = False,
    metrics: Sequence[Column] = (),
) -> Mapping[str, Any]:
    """Write Parquet and return ``row_count`` and any further metrics.

    Partitioned output is rebalanced on its partition columns first: a small
    partition is written by one task instead of a bit of it by every task, and
    AQE splits a partition that is larger than the advisory size, so a month
    that holds a third of all rows is still written in parallel.

    ``only_touched_partitions`` keeps partitions the input has no rows for.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    observed, observation = _observed(df, metrics)
    replaced = "dynamic" if only_touched_partitions else "static"
    writer = observed.write.mode(mode).option("partitionOverwriteMode", replaced)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return observation.get


def write_csv(
    df: DataFrame, path: str, metrics: Sequence[Column] = (), mode: str = "overwrite"
) -> Mapping[str, Any]:
    """CSV with a header line in every file."""
    observed, observation = _observed(df, metrics)
    options = {k: CSV_OPTIONS[k] for k in ("header", "escape")}
    observed.write.mode(mode).options(**options).csv(path)
    return observation.get
