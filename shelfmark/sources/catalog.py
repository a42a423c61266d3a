"""Layers of tables in versioned folders, and the manifest that says which folders count.

A table of version n is written to ``<layer>/<table>/run=n``, by partition where
it has some, and no folder is ever written to again once it counts. Publishing
appends one file to the manifest with a row per folder of all tables of the
layer, also of the folders that an earlier version left as they are. The file
appears at once or not at all, so readers see one version of all tables: the
earlier one while a run is at work or after it was cut off, then the new one.
One run at a time may publish to a layer.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence
from dataclasses import astuple, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.schemas import MANIFEST

RUN = "run"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Part:
    """A folder of a table, by its path below the layer; no path for a table without rows.

    ``partition`` is like ``year=2018/month=1``, empty for a whole table.
    """

    table: str
    partition: str
    path: str
    row_count: int
    keyless: int = 0


@dataclass(frozen=True)
class Version:
    """All tables of a layer at one time; ``built_from`` is the version of what it was made from."""

    layer: str
    number: int = 0
    built_from: int = 0
    parts: tuple[Part, ...] = ()

    def of(self, table: str, partitions: Collection[str] | None = None) -> tuple[Part, ...]:
        return tuple(
            p for p in self.parts if p.table == table and (partitions is None or p.partition in partitions)
        )

    def next(self, built_from: int) -> Version:
        """The version to come, for now without parts."""
        return Version(self.layer, self.number + 1, built_from)

    def having(self, parts: Iterable[Part]) -> Version:
        return replace(self, parts=(*self.parts, *parts))

    def changed_since(self, other: Version, table: str) -> set[str]:
        """The partitions of a table that the two versions keep in different folders, or only one has."""
        mine = {p.partition: p.path for p in self.of(table)}
        theirs = {p.partition: p.path for p in other.of(table)}
        return {k for k in mine.keys() | theirs.keys() if mine.get(k) != theirs.get(k)}


def _versions(spark: SparkSession, manifest: str, layer: str) -> DataFrame:
    spark.createDataFrame([], MANIFEST).write.mode("ignore").parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest).filter(F.col("layer") == layer)


def version_of(spark: SparkSession, manifest: str, layer: str, number: int | None = None) -> Version:
    """A published version of the layer, by default the newest; version 0, without parts, if there is none."""
    rows = _versions(spark, manifest, layer)
    if number is None:
        number = rows.agg(F.max("version")).first()[0] or 0
    found = rows.filter(F.col("version") == number).collect()
    if not found:
        if number:
            raise LookupError(f"{layer} has no version {number}")
        return Version(layer)
    parts = (Part(r.table_name, r.partition, r.path, r.row_count, r.keyless) for r in found)
    return Version(layer, number, found[0].built_from, tuple(sorted(parts, key=astuple)))


def publish(spark: SparkSession, manifest: str, version: Version) -> None:
    """Make the version the newest, in one step."""
    rows = [
        (version.layer, version.number, version.built_from, p.table, p.partition, p.path, p.row_count, p.keyless)
        for p in version.parts
    ]
    if not rows:
        raise ValueError(f"{version.layer}: a version without tables")
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(manifest)


def folder_of(layer_path: str, table: str, number: int) -> str:
    return f"{layer_path}/{table}/{RUN}={number}"


def written_parts(
    spark: SparkSession,
    layer_path: str,
    table: str,
    number: int,
    rows: int,
    partition_by: Sequence[str] = (),
    key: str | None = None,
    only: str = "true",
) -> list[Part]:
    """The folders that were just written for a table, with counts of their rows and of those without ``key``.

    ``rows`` were written in all; ``only`` says which of them count. Partitions are told apart by the columns they
    are named after, so only the key is read.
    """
    if not rows:
        return [Part(table, "", "", 0, 0)]
    path = folder_of(layer_path, table, number)
    keyless = F.count_if(F.expr(only) & F.col(key).isNull()) if key else F.lit(0)
    counts = (
        spark.read.parquet(path)
        .groupBy(*partition_by)
        .agg(F.count_if(F.expr(only)).alias("row_count"), keyless.cast("long").alias("keyless"))
        .collect()
    )
    parts = []
    for row in counts:
        named = "/".join(f"{c}={NO_VALUE if row[c] is None else row[c]}" for c in partition_by)
        below = f"{table}/{RUN}={number}/{named}".rstrip("/")
        parts.append(Part(table, named, below, row.row_count, row.keyless))
    return parts


def read_parts(
    spark: SparkSession,
    layer_path: str,
    parts: Sequence[Part],
    schema: StructType | None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """The rows of the folders; ``schema`` is that of a table without any, None where there is always one."""
    paths = [f"{layer_path}/{p.path}" for p in parts if p.path]
    if not paths:
        if schema is None:
            raise LookupError(f"no folders below {layer_path}")
        return spark.createDataFrame([], schema)
    tables = {p.table for p in parts}
    if len(tables) > 1:
        raise ValueError(f"parts of several tables: {sorted(tables)}")
    found = spark.read.option("basePath", f"{layer_path}/{tables.pop()}").parquet(*paths).drop(RUN)
    # Partition columns without any value would be read as text.
    return found.withColumns({c: F.col(c).cast("int") for c in partition_by})
