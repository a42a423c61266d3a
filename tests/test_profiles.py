"""Profiles that add up, against exact counts."""

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.profiles import (
    DISTINCT_ERROR,
    RANK_ERROR,
    drift_report,
    load_profile,
    whole_profile,
)


@pytest.fixture
def events(spark):
    rng = random.Random(5)
    rows = [
        (f"2024-0{1 + i % 3}", rng.choice([None, *range(5)]), f"u{rng.randrange(3000)}", rng.gauss(10, 3)) for i in range(30_000)
    ]
    return spark.createDataFrame(rows, "month string, kind int, user string, amount double")


COLUMNS = ["kind", "user", "amount"]


def test_loads_profiled_apart_add_up(spark, events, tmp_path):
    """Each load is read once, by itself; the whole comes from the stored profiles."""
    path = str(tmp_path / "profiles")
    for (month,) in events.select("month").distinct().collect():
        one = events.where(F.col("month") == month)
        load_profile(one, F.lit(month), COLUMNS).write.mode("append").parquet(path)
    whole = {r.column_name: r for r in whole_profile(spark.read.parquet(path)).collect()}
    exact = events.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in COLUMNS],
        *[F.countDistinct(c).alias(f"d_{c}") for c in COLUMNS],
    ).first()
    for c in COLUMNS:
        assert whole[c].row_count == 30_000 and whole[c].null_count == exact[f"n_{c}"]
        assert abs(whole[c].distinct_values - exact[f"d_{c}"]) <= 3 * DISTINCT_ERROR * exact[f"d_{c}"]
    below = events.where(F.col("amount") <= whole["amount"].median).count() / 30_000
    assert abs(below - 0.5) <= 2 * RANK_ERROR
    assert whole["user"].median is None


def test_one_pass_without_a_second_shuffle(events):
    plan = load_profile(events, F.col("month"), COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan.replace("LogicalRDD", "")


def test_drift_between_loads(spark, rows):
    def load(name, n, nulls, values):
        data = [(name, None if i < nulls else i % values) for i in range(n)]
        return spark.createDataFrame(data, "load string, v int")

    loads = load("1", 100, 0, 10).union(load("2", 110, 3, 10)).union(load("3", 300, 0, 10)).union(load("4", 100, 50, 10))
    report = drift_report(load_profile(loads.union(load("5", 120, 0, 60)), F.col("load"), ["v"]))
    failed = rows(report.where("not passed"), "load", "rule")
    # Of the 610 rows before the fifth load 53 are NULL: it has too few of them.
    assert failed == [("3", "rows"), ("4", "nulls"), ("5", "distinct"), ("5", "nulls")]


def test_no_rows_and_all_nulls(spark, rows):
    empty = spark.createDataFrame([], "load string, v int")
    assert load_profile(empty, F.col("load"), ["v"]).count() == 0
    assert whole_profile(load_profile(empty, F.col("load"), ["v"])).count() == 0
    nulls = spark.createDataFrame([("1", None), ("1", None)], "load string, v int")
    assert rows(whole_profile(load_profile(nulls, F.col("load"), ["v"]))) == [("v", 2, 2, 0, None)]
