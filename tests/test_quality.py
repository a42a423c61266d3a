"""The quality report and the gate (FIXTURES.md E7, E14)."""

import pytest

from shelfmark.operators import quality
from shelfmark.schemas import STAGING


@pytest.fixture
def tables(spark):
    """Every table with one good row."""
    keys = dict(quality.KEY_RULES)
    return {
        name: spark.createDataFrame(
            [tuple("k" if f.name == keys[name] else None for f in schema)], schema
        )
        for name, schema in STAGING.items()
    }


def test_good_tables_pass(tables):
    report = quality.key_report(tables)
    assert report.count() == 2 * len(quality.KEY_RULES)
    quality.gate(report)


def test_gate_names_every_error_once(spark, tables, rows):
    tables["sellers"] = tables["sellers"].limit(0)
    tables["order_items"] = tables["order_items"].unionByName(
        spark.createDataFrame([(None, 1, "p", "s", 1.0, 1.0)], STAGING["order_items"])
    )
    report = quality.key_report(tables)
    failed = rows(report.filter("not passed"))
    assert failed == [
        ("order_items", "order_id", "key_not_null", 1, False),
        ("sellers", "seller_id", "not_empty", 0, False),
    ]
    with pytest.raises(quality.DataQualityError) as error:
        quality.gate(report)
    assert "2 data quality error(s)" in str(error.value)
    assert "table sellers is empty" in str(error.value)
    assert "1 rows of order_items lack order_id" in str(error.value)


def test_empty_directory_is_reported_not_an_exception(spark, tables, tmp_path):
    path = str(tmp_path / "customers")
    tables["customers"].limit(0).write.parquet(path)
    tables["customers"] = spark.read.parquet(path)
    with pytest.raises(ValueError, match="table customers is empty"):
        quality.gate(quality.key_report(tables))
