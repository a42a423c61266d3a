"""Bring tables whose optional columns vary to the shape a plan expects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; absent names are skipped."""
    return df.withColumnsRenamed(dict(names))


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])


def schema_drift(table: str, expected: StructType, actual: DataFrame) -> DataFrame:
    """One row per column: expected and found type, and how they compare.

    Reads only the schema of ``actual``; the row count is the number of columns.
    """
    found = {f.name: f.dataType.simpleString() for f in actual.schema}
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    rows = []
    for name in [*wanted, *(n for n in found if n not in wanted)]:
        want, have = wanted.get(name), found.get(name)
        status = (
            "missing" if have is None
            else "extra" if want is None
            else "same" if want == have
            else "changed"
        )
        rows.append((table, name, want, have, status))
    return actual.sparkSession.createDataFrame(
        rows,
        "table_name string, column_name string, expected_type string, "
        "actual_type string, status string",
    )
