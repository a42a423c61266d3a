"""The types of delivered tables, kept in versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.operators.widening import widened
from shelfmark.schemas import TYPE_VERSIONS


def type_versions(spark: SparkSession, path: str) -> DataFrame:
    """table_name, version, column_name, form: all versions, a row per column of each."""
    spark.createDataFrame([], TYPE_VERSIONS).write.mode("ignore").parquet(path)
    return spark.read.schema(TYPE_VERSIONS).parquet(path)


def forms_of(spark: SparkSession, path: str, table: str, version: int | None = None) -> tuple[int, dict[str, str]]:
    """A version of a table's types, by default the newest; version 0, without columns, if there is none."""
    rows = type_versions(spark, path).where(F.col("table_name") == table)
    if version is None:
        version = rows.agg(F.max("version")).first()[0] or 0
    found = rows.where(F.col("version") == version).collect()
    if version and not found:
        raise LookupError(f"{table} has no types of version {version}")
    return version, {r.column_name: r.form for r in sorted(found, key=lambda r: r.position)}


def widen_types(
    spark: SparkSession, path: str, table: str, counts: DataFrame, declared: StructType
) -> tuple[int, dict[str, str]]:
    """Widen a table's types to hold a delivery's cells; a new version is stored only if a type changes.

    A version is one file, which appears at once or not at all. A delivery that
    is repeated changes nothing. One run at a time may widen a table.
    """
    version, known = forms_of(spark, path, table)
    forms = widened(counts, declared, known)
    if forms == known:
        return version, known
    rows = [(table, version + 1, i, name, form) for i, (name, form) in enumerate(forms.items())]
    spark.createDataFrame(rows, TYPE_VERSIONS).coalesce(1).write.mode("append").parquet(path)
    return version + 1, forms
