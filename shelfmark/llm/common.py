"""Expressions and helpers that the operators share."""

from __future__ import annotations

import ctypes
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.session import scratch_dir

# A word: a run of characters other than space, tab, line feed, vertical tab,
# form feed and carriage return. ``bytes.split()`` cuts at the same ones.
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def remainder_of(key: Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo ``modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: it cuts the lineage."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_hash(df: DataFrame) -> Column:
    """A hash over all columns, to order rows that are alike in all that counts."""
    columns = [
        F.to_json(F.struct(F.col(f"`{f.name}`")))
        if isinstance(f.dataType, (T.MapType, T.VariantType))
        else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    return F.xxhash64(*columns)


def give_back_memory() -> None:
    """Hands freed memory of this Python worker back to the system.

    Workers live on and serve later stages; without this, what the largest task
    once needed stays with each of them.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
