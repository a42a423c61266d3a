"""The steps of the daily run as commands, for ``spark-submit`` under any scheduler.

    spark-submit --packages org.postgresql:postgresql:42.7.3 job.py daily \\
        --root s3a://lake/retail --csv s3a://drop/csv --answers s3a://drop/answers \\
        --jdbc url=jdbc:postgresql://db:5432/shop --jdbc driver=org.postgresql.Driver

The steps ``land``, ``stage``, ``check``, ``star`` and ``load`` hand over through
the folders below ``--root``, so each may be its own application. A failed step
ends with an error and a non-zero exit. The database user and password are read
from ``POSTGRES_USER`` and ``POSTGRES_PASSWORD`` unless given with ``--jdbc``.

For large sources, ``--split sellers:id:1:9000000:64`` reads a table over 64
connections along a column, ``--connections`` bounds those of the load, and
``--input-gb`` sets how many shuffle partitions Spark begins with.
``--warehouse`` names another database to load into than ``--jdbc`` reads from.

With ``--merge`` the files below ``--csv`` are deliveries that are merged into
staging and star at the cost of what they change, see ``plans.delivery``. All
steps of a root are called with it or none.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
from collections.abc import Sequence
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from shelfmark.plans import delivery, refresh
from shelfmark.schemas import RAW
from shelfmark.session import build_session
from shelfmark.sinks.jdbc import load_table
from shelfmark.sources.files import read_csv
from shelfmark.sources.jdbc import Split, read_table
from shelfmark.sources.payloads import read_payloads
from shelfmark.streaming.landing import by_file_name, by_modification_time

STEPS = ("land", "stage", "check", "star", "load", "daily")
ORDERS = {"time": by_modification_time, "name": by_file_name}
# What each step needs beside the root.
NEEDED = {"land": ("csv", "answers", "jdbc"), "load": ("warehouse",)}
NEEDED["daily"] = (*NEEDED["land"], *NEEDED["load"])


def parser() -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(prog="shelfmark", description=__doc__.splitlines()[0])
    args.add_argument("step", choices=STEPS)
    args.add_argument("--root", required=True, help="folder of the layers")
    args.add_argument("--csv", help="folder with <table>.csv files or folders")
    args.add_argument("--answers", help="landed JSON answers of the product service, or a .csv")
    args.add_argument("--whole-files", action="store_true", help="an answer is a file, not a line")
    args.add_argument("--element", help="JSON file with the schema of a product, else as answered")
    args.add_argument("--new-files-only", action="store_true", help="--csv holds deliveries")
    args.add_argument("--merge", action="store_true", help="--csv holds deliveries, to be merged")
    args.add_argument("--delivery-order", choices=sorted(ORDERS), default="time")
    args.add_argument("--allow-rejects", type=int, default=0, metavar="LINES")
    args.add_argument("--jdbc", action="append", default=[], metavar="OPTION=VALUE")
    args.add_argument("--warehouse", action="append", default=[], metavar="OPTION=VALUE")
    args.add_argument("--split", action="append", default=[], metavar="TABLE:COLUMN:LOWER:UPPER:N")
    args.add_argument("--connections", type=int, default=8, help="of the load")
    args.add_argument("--input-gb", type=float, help="about what a run reads")
    return args


def parsed(argv: Sequence[str] | None) -> argparse.Namespace:
    """The arguments; what the step needs must be there."""
    known = parser()
    args = known.parse_args(argv)
    args.warehouse = args.warehouse or args.jdbc
    if missing := [f"--{name}" for name in NEEDED.get(args.step, ()) if not getattr(args, name)]:
        known.error(f"{args.step} needs {', '.join(missing)}")
    return args


def splits(given: Sequence[str]) -> dict[str, Split]:
    """The split of each table. Bounds may hold colons, as times do; table and column may not."""
    out = {}
    for text in given:
        table, column, rest = text.split(":", 2)
        bounds, connections = rest.rsplit(":", 1)
        parts = bounds.split(":")
        half = len(parts) // 2
        if len(parts) % 2:
            raise ValueError(f"{text} is not TABLE:COLUMN:LOWER:UPPER:N")
        out[table] = Split(column, ":".join(parts[:half]), ":".join(parts[half:]), int(connections))
    return out


def connection(options: Sequence[str]) -> dict[str, str]:
    given = dict(option.split("=", 1) for option in options)
    login = {"user": "POSTGRES_USER", "password": "POSTGRES_PASSWORD"}
    from_env = {key: os.environ[name] for key, name in login.items() if name in os.environ}
    return {**from_env, **given}


def run(spark: SparkSession, argv: Sequence[str]) -> None:
    args = parsed(argv)
    layout = refresh.Layout(args.root)
    database, warehouse = connection(args.jdbc), connection(args.warehouse)
    split = splits(args.split)
    if args.step in ("land", "daily"):
        if args.answers.endswith(".csv"):
            products = partial(
                read_csv, spark, args.answers, RAW["product_metadata"], multiline=True
            )
        else:
            element = None
            if args.element:
                with open(args.element) as file:
                    element = StructType.fromJson(json.load(file))
            products = partial(read_payloads, spark, args.answers, element, args.whole_files)
        land = (
            delivery.land_deliveries
            if args.merge
            else partial(refresh.land, new_files_only=args.new_files_only)
        )
        land(
            spark,
            layout,
            args.csv,
            lambda table: read_table(spark, database, table, split.get(table)),
            products,
            delivered=ORDERS[args.delivery_order](),
        )
    steps = delivery if args.merge else refresh
    if args.step in ("stage", "daily"):
        steps.stage(spark, layout)
    if args.step in ("check", "daily"):
        steps.check(spark, layout, args.allow_rejects)
    if args.step in ("star", "daily"):
        steps.build_star(spark, layout)
    if args.step in ("load", "daily"):
        refresh.load(
            spark, layout, lambda df, table: load_table(df, warehouse, table, args.connections)
        )


def main(argv: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    gigabytes = parsed(argv).input_gb
    spark = build_session(
        "shelfmark", input_bytes=None if gigabytes is None else int(gigabytes * (1 << 30))
    )
    try:
        run(spark, argv)
    finally:
        spark.stop()
