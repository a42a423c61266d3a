"""The steps as commands. The database is replaced by functions."""

import json

import pytest

from shelfmark import cli
from shelfmark.operators.quality import DataQualityError
from shelfmark.plans.refresh import STAR_TABLES
from shelfmark.sources.jdbc import Split
from test_refresh import Shop


@pytest.fixture
def shop(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    shop = Shop(spark, tmp_path)

    shop.splits = {}

    def load(df, connection, table, connections):
        shop.loaded[table] = (df.count(), connection["user"])
        shop.target = connection["url"], connections

    def read(spark, connection, name, split):
        shop.splits[name] = split
        return shop.table(name)

    monkeypatch.setattr(cli, "read_table", read)
    monkeypatch.setattr(cli, "load_table", load)
    monkeypatch.setenv("POSTGRES_USER", "ann")
    monkeypatch.delenv("POSTGRES_PASSWORD", raising=False)
    return shop


def command(shop, step):
    return [
        step, "--root", shop.layout.root, "--csv", str(shop.root / "in"),
        "--answers", str(shop.root / "in" / "answers"), "--jdbc", "url=jdbc:x://db/shop?a=b",
    ]


def test_steps_one_by_one_and_daily_end_alike(shop, spark, rows):
    shop.write_sources()
    for step in ("land", "stage", "check", "star", "load"):
        cli.run(spark, command(shop, step))
    first = {t: rows(shop.star(t)) for t in STAR_TABLES}
    assert shop.loaded == {t: (len(first[t]), "ann") for t in STAR_TABLES}
    cli.run(spark, command(shop, "daily"))
    assert first == {t: rows(shop.star(t)) for t in STAR_TABLES}


def test_failed_check_ends_the_command(shop, spark):
    shop.csv["orders"] = []
    shop.write_sources()
    for step in ("land", "stage"):
        cli.run(spark, command(shop, step))
    with pytest.raises(DataQualityError, match="table orders is empty"):
        cli.run(spark, command(shop, "check"))


def test_connection_options():
    assert cli.connection(["url=jdbc:x://db/s?a=b", "user=bob"])["url"] == "jdbc:x://db/s?a=b"
    assert cli.connection(["user=bob"])["user"] == "bob"


def test_splits_connections_and_a_warehouse_of_its_own(shop, spark):
    shop.write_sources()
    more = ["--split", "sellers:seller_id:1:900:16", "--split", "inventory:at:2020-01-01 00:00:00:2021-01-01 00:00:00:4",
            "--connections", "3", "--warehouse", "url=jdbc:x://dw/star"]
    cli.run(spark, [*command(shop, "daily"), *more])
    assert shop.splits["sellers"] == Split("seller_id", "1", "900", 16)
    assert shop.splits["inventory"] == Split("at", "2020-01-01 00:00:00", "2021-01-01 00:00:00", 4)
    assert shop.target == ("jdbc:x://dw/star", 3)
    with pytest.raises(ValueError):
        cli.splits(["sellers:id:1:2:3:4"])


@pytest.mark.parametrize(
    "argv, lacking",
    [(["land"], "--csv, --answers, --jdbc"), (["land", "--csv", "x"], "--answers, --jdbc"),
     (["load"], "--warehouse"), (["daily", "--jdbc", "url=x"], "--csv, --answers")],
)
def test_a_step_says_what_it_needs(argv, lacking, capsys):
    with pytest.raises(SystemExit):
        cli.parsed([*argv, "--root", "r"])
    assert f"needs {lacking}" in capsys.readouterr().err


def test_everything_answered_reaches_staging(shop, spark, rows):
    """A pretty-printed answer with fields nobody declared, one of them a map's worth of names."""
    shop.metadata = [{"id": 1, "brand": "Acme", "rating": "bad", "stock": 3.5, "title": "A", "box": {"w": 2}}]
    shop.write_sources()
    answer = shop.root / "in" / "answers" / "1.json"
    answer.write_text(json.dumps({"products": shop.metadata}, indent=2))
    cli.run(spark, [*command(shop, "land"), "--whole-files"])
    cli.run(spark, command(shop, "stage"))
    staged = spark.read.parquet(shop.layout.staging("product_metadata"))
    assert rows(staged, "product_id", "brand", "rating", "stock", "title", "box.w") == [("1", "Acme", None, None, "A", 2)]
    assert spark.read.parquet(shop.layout.raw("product_metadata")).where("_corrupt_record is not null").count() == 1
    cli.run(spark, command(shop, "check"))


def test_an_element_from_a_file(shop, spark):
    shop.write_sources()
    path = shop.root / "element.json"
    path.write_text(spark.createDataFrame([], "id string, brand string").schema.json())
    cli.run(spark, [*command(shop, "land"), "--element", str(path)])
    assert spark.read.parquet(shop.layout.raw("product_metadata")).columns == ["id", "brand", "_corrupt_record"]
