"""One row per key, chosen deterministically."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

_RANK = "__rank"


def _sortable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_sortable(f.dataType) for f in kind)
    return not isinstance(kind, (MapType, VariantType))


def _order_of(df: DataFrame, name: str) -> Column:
    """The column, or as text what Spark cannot sort."""
    column = F.col(f"`{name}`")
    return column if _sortable(df.schema[name].dataType) else F.to_json(F.struct(column))


def order_within_keys(df: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> list[Column]:
    """The order by which ``one_per_key`` chooses: total up to fully equal rows."""
    rest = [name for name in df.columns if name not in keys and name not in newest]
    order = [F.col(name).desc_nulls_last() for name in newest]
    return order + [_order_of(df, name).asc_nulls_last() for name in rest]


def one_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """Keep one row of every key: the highest in ``newest``, then the lowest in the rest.

    The order is total up to fully equal rows, so re-run tasks keep the same
    row. Spark plans ``rank = 1`` with a group limit below the shuffle: every
    task sends at most one row per key, however many copies a hot key has.
    """
    order = order_within_keys(df, keys, newest)
    if not order:
        return df.dropDuplicates(list(keys))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Keep the newest row of every key; rows without a version lose."""
    return one_per_key(df, keys, newest=[version])


def having_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where all the named columns are present. Reaches the scan on stored columns."""
    return df.filter(reduce(and_, [F.col(name).isNotNull() for name in columns]))
