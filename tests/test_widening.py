"""Types that widen over deliveries."""

import datetime
import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructType

from shelfmark.operators.widening import (
    FORMS,
    REASONS,
    cell_form,
    form_counts,
    least_above,
    typed,
    widened,
)
from shelfmark.sources.files import SOURCE_FILE, read_text_csv
from shelfmark.sources.types import forms_of, type_versions, widen_types

DECLARED = StructType().add("id", LongType()).add("day", DateType()).add("name", StringType())


def counted(spark, *rows):
    return form_counts(spark.createDataFrame(rows, "file string, id string, day string, name string, extra string"), ["file"])


@pytest.mark.parametrize(
    "cell, form",
    [
        ("1", "long"), (" -12 ", "long"), ("+3", "long"), ("9" * 19, "double"), ("1.", "double"), (".5", "double"),
        ("1e5", "double"), ("1e", "text"), ("NaN", "text"), ("1,5", "text"), ("TRUE", "boolean"), ("2020-02-29", "date"),
        ("2021-02-29", "text"), ("2020-02-29 24:00:00", "text"), ("2020-02-29T10:00:00.5", "timestamp"),
        ("20200229", "long"), ("", None), ("  ", None), (None, None), ("é", "text"), ("1\n2", "text"),
    ],
)
def test_forms_of_cells(spark, cell, form):
    assert spark.createDataFrame([(cell,)], "c string").select(cell_form(F.col("c"))).first()[0] == form


def test_least_above_is_a_join():
    for a, b, c in itertools.product(FORMS, repeat=3):
        assert least_above([a, b]) == least_above([b, a])
        assert least_above([least_above([a, b]), c]) == least_above([a, least_above([b, c])])
        assert least_above([a, a]) == a
    assert least_above(["long", "double"]) == "double" and least_above(["long", "date"]) == "text"
    assert least_above([]) is None


def test_order_of_deliveries_does_not_matter(spark, tmp_path):
    deliveries = [
        counted(spark, ("f1", "1", "2020-01-01", "a", "7"), ("f1", "n/a", None, "5", None)),
        counted(spark, ("f2", "1.5", "2020-01-01", None, "2020-01-01")),
        counted(spark, ("f3", "2", "2020-01-01 10:00:00", "b", "")),
    ]
    outcomes = set()
    for i, order in enumerate(itertools.permutations(deliveries)):
        path = str(tmp_path / f"types{i}")
        for counts in order:
            _, forms = widen_types(spark, path, "t", counts, DECLARED)
        outcomes.add(tuple(sorted(forms.items())))
    assert outcomes == {(("day", "timestamp"), ("extra", "text"), ("id", "double"), ("name", "text"))}
    together = deliveries[0].union(deliveries[1]).union(deliveries[2])
    assert tuple(sorted(widened(together, DECLARED).items())) in outcomes


def test_versions_are_kept_and_repeats_change_nothing(spark, tmp_path):
    path = str(tmp_path / "types")
    assert forms_of(spark, path, "t") == (0, {})
    first = counted(spark, ("f1", "1", "2020-01-01", "a", None))
    assert widen_types(spark, path, "t", first, DECLARED) == (1, {"id": "long", "day": "date", "name": "text"})
    assert widen_types(spark, path, "t", first, DECLARED)[0] == 1
    second = counted(spark, ("f2", "1.5", None, None, "true"))
    version, forms = widen_types(spark, path, "t", second, DECLARED)
    assert (version, forms) == (2, {"id": "double", "day": "date", "name": "text", "extra": "boolean"})
    # A delivery that is narrower again narrows nothing.
    assert widen_types(spark, path, "t", first, DECLARED)[0] == 2
    assert forms_of(spark, path, "t", 1) == (1, {"id": "long", "day": "date", "name": "text"})
    assert forms_of(spark, path, "other") == (0, {})
    assert type_versions(spark, path).count() == 7
    with pytest.raises(LookupError):
        forms_of(spark, path, "t", 9)


def test_rows_that_fit_and_rows_that_do_not(spark):
    rows = spark.createDataFrame(
        [
            ("f", "1", "2020-01-01", "x", "k"), ("f", " 2.5 ", "2020-01-01 10:00:00", None, None),
            ("g", "n/a", "2020-13-01", "y", "k"), ("g", "", None, "", "k"), ("g", "true", None, "z", None),
            ("f", "1", "2020-01-01", "x", "k"),
        ],
        "file string, id string, day string, name string, other string",
    )
    forms = {"id": "double", "day": "timestamp", "name": "text", "gone": "long"}
    fit, others = typed(rows, forms, keep=["file"])
    assert dict(fit.dtypes) == {
        "id": "double", "day": "timestamp_ntz", "name": "string", "gone": "bigint", "other": "string", "file": "string"
    }
    day = datetime.datetime(2020, 1, 1)
    assert sorted(map(repr, map(tuple, fit.collect()))) == sorted(
        map(
            repr,
            [
                (1.0, day, "x", None, "k", "f"), (2.5, day.replace(hour=10), None, None, None, "f"),
                (None, None, "", None, "k", "g"), (1.0, day, "x", None, "k", "f"),
            ],
        )
    )
    assert sorted((r["id"], tuple(r[REASONS])) for r in others.collect()) == [("n/a", ("id", "day")), ("true", ("id",))]


def test_narrow_types_quarantine_wider_cells(spark):
    rows = spark.createDataFrame([("1",), ("1.5",)], "id string")
    fit, others = typed(rows, {"id": "long"})
    assert [r["id"] for r in fit.collect()] == [1] and [r["id"] for r in others.collect()] == ["1.5"]


def test_no_rows_and_clashing_names(spark):
    empty = counted(spark).where("false")
    assert widened(empty, DECLARED) == {"id": "long", "day": "date", "name": "text"}
    odd = spark.createDataFrame([("f", "1", "x")], "`c0_long` string, `a.b` string, `cells` string")
    got = {(r.column_name, r.form, r.cells) for r in form_counts(odd, ["c0_long"]).collect()}
    assert got == {("a.b", "long", 1), ("cells", "text", 1)}


def test_counts_are_made_below_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(3000).select(F.col("id").cast("string"), F.lit("x").alias("b")).repartition(4).write.option("header", True).csv(path)
    counts = form_counts(read_text_csv(spark, path), [SOURCE_FILE])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan
    assert counts.groupBy("column_name", "form").agg(F.sum("cells").alias("n")).collect() == [
        ("id", "long", 3000), ("b", "text", 3000)
    ] or counts.agg(F.sum("cells")).first()[0] == 6000
