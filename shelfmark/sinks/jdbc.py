"""Loading the star schema into a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession

from shelfmark.operators.quality import rows_metric
from shelfmark.sources.jdbc import read_table


class LoadMismatch(RuntimeError):
    """The database holds another number of rows than were sent."""


def table_writer(
    df: DataFrame,
    connection: Mapping[str, str],
    table: str,
    mode: str = "overwrite",
    connections: int = 8,
    batch_rows: int = 10_000,
) -> DataFrameWriter:
    """``truncate`` keeps the table with its grants and indexes instead of dropping it.

    ``connections`` bounds how many tasks write at once, to spare the database.
    """
    return (
        df.write.format("jdbc")
        .mode(mode)
        .options(**connection)
        .option("dbtable", table)
        .option("truncate", True)
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
    )


def stored_rows(spark: SparkSession, connection: Mapping[str, str], table: str) -> int:
    """The table's row count, counted by the database."""
    counted = f"(SELECT COUNT(*) AS stored FROM {table}) counted"
    return int(read_table(spark, connection, counted).first()[0])


def load_table(
    df: DataFrame, connection: Mapping[str, str], table: str, connections: int = 8
) -> int:
    """Replace the table's rows and return their number.

    A task whose executor is lost after its transaction was committed is run
    again and would leave its rows twice; the row count in the database is
    therefore compared with the count sent, and a difference fails the load.
    Loading again repairs it. Tables are replaced one after the other, not in
    one transaction.
    """
    observation = Observation()
    observed = df.observe(observation, rows_metric())
    table_writer(observed, connection, table, connections=connections).save()
    sent = observation.get["row_count"]
    stored = stored_rows(df.sparkSession, connection, table)
    if stored != sent:
        raise LoadMismatch(f"{table}: sent {sent} rows, found {stored}")
    return sent
