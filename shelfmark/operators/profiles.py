"""Profiles of loads that add up, so that a table's history is known without reading it again.

Of every column of a load: exact counts of rows and NULLs, least and greatest
value, a HyperLogLog sketch of its distinct values and, for numbers, a KLL sketch
of their ranks. Sketches of loads merge into those of all loads. With the
settings here an estimate of distinct values has a standard error of 1.6 %, a
quantile is off by 1.7 % of the rows at most, in 99 of 100 cases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

HLL_BITS = 12
KLL_SIZE = 200
DISTINCT_ERROR, RANK_ERROR = 1.04 / 2 ** (HLL_BITS / 2), 0.0167
# What of a load may differ from the loads before it.
ROWS_FACTOR, NULL_SHARE, DISTINCT_FACTOR = 2.0, 0.05, 2.0


def load_profile(df: DataFrame, load: Column, columns: Sequence[str]) -> DataFrame:
    """A row per load and column, in one pass and one partial aggregate over all columns.

    ``load`` tells the loads of ``df`` apart; a literal for a single load. A load
    is a handful of rows here, however many it has.
    """

    def of(name: str) -> Column:
        value = F.col(f"`{name}`")
        number = isinstance(df.schema[name].dataType, NumericType)
        as_double = value.cast("double") if number else F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(value.isNull()).alias("null_count"),
            F.min(value).cast("string").alias("least"),
            F.max(value).cast("string").alias("greatest"),
            F.hll_sketch_agg(value.cast("string"), F.lit(HLL_BITS)).alias("values"),
            F.kll_sketch_agg_double(as_double, F.lit(KLL_SIZE)).alias("ranks"),
        )

    grouped = df.groupBy(load.cast("string").alias("load")).agg(F.array(*map(of, columns)).alias("all"))
    return grouped.select("load", F.inline("all"))


def whole_profile(profiles: DataFrame) -> DataFrame:
    """A row per column over all loads: counts, estimated distinct values, median; reads profiles only."""
    merged = profiles.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_union_agg("values").alias("values"),
        F.kll_merge_agg_double("ranks").alias("ranks"),
    )
    return merged.select(
        "column_name", "row_count", "null_count", F.hll_sketch_estimate("values").alias("distinct_values"),
        quantile("ranks", 0.5).alias("median"),
    )


def quantile(ranks: str, share: float) -> Column:
    """The value below which ``share`` of the numbers lie; NULL where there are none."""
    some = F.kll_sketch_get_n_double(ranks) > 0
    return F.when(some, F.kll_sketch_get_quantile_double(F.when(some, F.col(ranks)), F.lit(share)))


def drift_report(profiles: DataFrame) -> DataFrame:
    """load, column_name, rule, metric, passed: every load against the mean of the loads before it.

    ``rows``: rows by the mean number; ``nulls``: the share of NULLs less the share
    so far; ``distinct``: distinct values by their mean number. Loads are ordered
    by name. The first load has nothing to differ from and passes.
    """
    before = Window.partitionBy("column_name").orderBy("load").rowsBetween(Window.unboundedPreceding, -1)
    seen = profiles.withColumn("distinct_values", F.hll_sketch_estimate("values"))
    compared = seen.select(
        "load",
        "column_name",
        (F.col("row_count") / F.avg("row_count").over(before)).alias("rows"),
        (
            F.col("null_count") / F.col("row_count")
            - F.sum("null_count").over(before) / F.sum("row_count").over(before)
        ).alias("nulls"),
        (F.col("distinct_values") / F.nullif(F.avg("distinct_values").over(before), F.lit(0.0))).alias("distinct"),
    )

    def rule(name: str, low: float, high: float) -> Column:
        fine = F.coalesce(F.col(name).between(low, high), F.lit(True))
        return F.struct(F.lit(name).alias("rule"), F.col(name).alias("metric"), fine.alias("passed"))

    rules = F.array(
        rule("rows", 1 / ROWS_FACTOR, ROWS_FACTOR),
        rule("nulls", -NULL_SHARE, NULL_SHARE),
        rule("distinct", 1 / DISTINCT_FACTOR, DISTINCT_FACTOR),
    )
    return compared.select("load", "column_name", F.inline(rules))
