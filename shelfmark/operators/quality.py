"""Data-quality report and the gate that blocks a run."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# The key column checked in each staged table.
KEY_RULES = (
    ("customers", "customer_id"),
    ("products", "product_id"),
    ("orders", "order_id"),
    ("order_items", "order_id"),
    ("sellers", "seller_id"),
    ("inventory", "product_id"),
    ("product_metadata", "product_id"),
)


# The column without which staging drops a raw line.
RAW_KEYS = (
    ("customers", "customer_id"),
    ("products", "product_id"),
    ("orders", "order_id"),
    ("order_items", "order_item_id"),
    ("product_metadata", "id"),
)


# What refers to what, which keys are unique, and which values are possible.
REFERENCES = (
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("inventory", "product_id", "products", "product_id"),
)
UNIQUE_KEYS = (
    ("customers", ("customer_id",)),
    ("products", ("product_id",)),
    ("orders", ("order_id",)),
    ("order_items", ("order_id", "order_item_id")),
    ("sellers", ("seller_id",)),
    ("inventory", ("product_id",)),
    ("product_metadata", ("product_id",)),
)
ANY = float("inf")
RANGES = (
    ("order_items", "price", 0, ANY),
    ("order_items", "freight_value", 0, ANY),
    ("order_items", "order_item_id", 1, ANY),
    ("inventory", "stock_quantity", 0, ANY),
    ("product_metadata", "rating", 0, 5),
)


class DataQualityError(ValueError):
    """Raised once per gate with every failed check."""


def rows_metric() -> Column:
    return F.count(F.lit(1)).alias("row_count")


def nulls_metric(key: str) -> Column:
    return F.count_if(F.col(key).isNull()).alias("null_count")


def table_profile(df: DataFrame, table: str, key: str) -> DataFrame:
    """One row: row count and missing keys, from one pass over the key column."""
    return df.agg(rows_metric(), nulls_metric(key)).select(
        F.lit(table).alias("table_name"), F.lit(key).alias("key_column"), "row_count", "null_count"
    )


def profiles(
    tables: Mapping[str, DataFrame], rules: Sequence[tuple[str, str]] = KEY_RULES
) -> DataFrame:
    """One profile row per rule; the tables are aggregated in one job."""
    return reduce(
        DataFrame.unionByName, [table_profile(tables[name], name, key) for name, key in rules]
    )


def key_report(
    tables: Mapping[str, DataFrame], rules: Sequence[tuple[str, str]] = KEY_RULES
) -> DataFrame:
    """Two rows per rule, ``not_empty`` and ``key_not_null``, with metric and verdict."""
    return key_checks(profiles(tables, rules))


def key_checks(counted: DataFrame) -> DataFrame:
    """The report of ``key_report`` from profiles that are known: table_name, key_column, row_count, null_count."""
    checks = F.array(
        F.struct(
            F.lit("not_empty").alias("rule"),
            F.col("row_count").alias("metric"),
            (F.col("row_count") > 0).alias("passed"),
        ),
        F.struct(
            F.lit("key_not_null").alias("rule"),
            F.col("null_count").alias("metric"),
            (F.col("null_count") == 0).alias("passed"),
        ),
    )
    return counted.select("table_name", "key_column", F.inline(checks))


def reject_report(
    tables: Mapping[str, DataFrame],
    corrupt: str,
    allowed: int = 0,
    rules: Sequence[tuple[str, str]] = RAW_KEYS,
) -> DataFrame:
    """One row per raw table: lines whose key could not be read, which staging drops.

    ``corrupt`` is the column in which readers keep a line that did not fit. A
    table without it rejects nothing. ``allowed`` such lines pass.
    """

    def rejected(table: str, key: str) -> DataFrame:
        df = tables[table]
        lost = F.lit(False)
        if corrupt in df.columns and key in df.columns:
            lost = F.col(corrupt).isNotNull() & F.col(key).isNull()
        counted = df.agg(F.count_if(lost).alias("metric"))
        return counted.select(
            F.lit(table).alias("table_name"),
            F.lit(key).alias("key_column"),
            F.lit("key_readable").alias("rule"),
            "metric",
            (F.col("metric") <= allowed).alias("passed"),
        )

    return reduce(DataFrame.unionByName, [rejected(t, k) for t, k in rules if t in tables])


def integrity_report(
    tables: Mapping[str, DataFrame],
    references: Sequence[tuple[str, str, str, str]] = REFERENCES,
    unique: Sequence[tuple[str, tuple[str, ...]]] = UNIQUE_KEYS,
    ranges: Sequence[tuple[str, str, float, float]] = RANGES,
) -> DataFrame:
    """Orphans, repeated keys and values out of range: table_name, key_column, rule, metric, passed.

    Orphans are one anti join per reference, of the child's distinct keys with their
    counts and the parent's distinct keys, so a key that a third of all rows have is
    counted where these rows are and is one row in the join; repeated keys are one
    partial aggregate per key; all ranges of a table are counted in one pass.
    NULL keys refer to nothing, and NULL values have no range: neither counts.
    """
    reports = []
    for child, column, parent, key in references:
        rows = tables[child].select(F.col(column).alias("k")).where(F.col("k").isNotNull())
        keys = rows.groupBy("k").agg(F.count("*").alias("n"))
        known = tables[parent].select(F.col(key).alias("k")).distinct()
        lost = F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("metric")
        reports.append(_finding(keys.join(known, "k", "left_anti").agg(lost), child, column, "orphan"))
    for table, columns in unique:
        keys = tables[table].dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n"))
        surplus = keys.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("metric"))
        reports.append(_finding(surplus, table, ",".join(columns), "unique"))
    for table in dict.fromkeys(t for t, *_ in ranges):
        bounds = [(c, low, high) for t, c, low, high in ranges if t == table]
        outside = [F.count_if(~F.col(c).between(low, high)).alias(c) for c, low, high in bounds]
        counted = tables[table].agg(*outside)
        found = F.inline(F.array(*[F.struct(F.lit(c).alias("key_column"), F.col(c).alias("metric")) for c, *_ in bounds]))
        reports.append(
            counted.select(found).select(
                F.lit(table).alias("table_name"), "key_column", F.lit("range").alias("rule"), "metric",
                (F.col("metric") == 0).alias("passed"),
            )
        )
    return reduce(DataFrame.unionByName, reports)


def _finding(counted: DataFrame, table: str, column: str, rule: str) -> DataFrame:
    return counted.select(
        F.lit(table).alias("table_name"), F.lit(column).alias("key_column"), F.lit(rule).alias("rule"),
        "metric", (F.col("metric") == 0).alias("passed"),
    )


def gate(report: DataFrame) -> None:
    """Log every check, then raise once when any failed.

    Collects the report, whose size is a few rows per rule.
    """
    errors = []
    for row in report.collect():
        if row.passed:
            log.info("OK: %s %s (%s)", row.table_name, row.rule, row.metric)
        elif row.rule == "not_empty":
            errors.append(f"table {row.table_name} is empty")
        elif row.rule == "key_not_null":
            errors.append(f"{row.metric} rows of {row.table_name} lack {row.key_column}")
        else:
            errors.append(f"{row.metric} rejected by {row.rule} on {row.table_name}.{row.key_column}")
    for error in errors:
        log.error(error)
    if errors:
        raise DataQualityError(f"{len(errors)} data quality error(s): " + "; ".join(errors))
