"""Tables of a database reached over JDBC.

``connection`` is the mapping of Spark's JDBC options that name the database:
``url``, ``user``, ``password``, ``driver``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from typing import Any

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from shelfmark.operators.incremental import delta_since


@dataclass(frozen=True)
class Split:
    """Read a table over several connections, cut along a number or date column."""

    column: str
    lower: Any
    upper: Any
    connections: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.connections),
        }


def table_reader(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    split: Split | None = None,
    fetch_rows: int = 10_000,
) -> DataFrameReader:
    reader = spark.read.format("jdbc").options(**connection).option("dbtable", table)
    reader = reader.option("fetchsize", fetch_rows)
    return reader.options(**split.options()) if split else reader


def read_table(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    split: Split | None = None,
) -> DataFrame:
    """The whole table. Without a split it comes through one connection."""
    return table_reader(spark, connection, table, split).load()


def read_since(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    column: str,
    watermark: Any,
    split: Split | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Rows changed since the mark. Spark sends the comparison to the database."""
    return delta_since(
        read_table(spark, connection, table, split), column, watermark, inclusive=inclusive
    )


def read_slices(
    spark: SparkSession, connection: Mapping[str, str], table: str, slices: Sequence[str]
) -> DataFrame:
    """The table over one connection per slice, for keys or dates that are not spread evenly."""
    properties = {k: v for k, v in connection.items() if k != "url"}
    return spark.read.jdbc(
        connection["url"], table, predicates=list(slices), properties=properties
    )


def date_slices(column: str, first: date, last: date, days: int) -> list[str]:
    """Conditions that put every row in exactly one slice.

    The outer slices are open and rows without a date go to the first, so no
    row falls outside however far the real dates reach.
    """
    cuts = []
    cut = first + timedelta(days=days)
    while cut <= last:
        cuts.append(cut)
        cut += timedelta(days=days)
    if not cuts:
        return ["1 = 1"]
    slices = [f"{column} < date '{cuts[0]}' or {column} is null"]
    slices += [
        f"{column} >= date '{a}' and {column} < date '{b}'" for a, b in zip(cuts, cuts[1:])
    ]
    return [*slices, f"{column} >= date '{cuts[-1]}'"]
