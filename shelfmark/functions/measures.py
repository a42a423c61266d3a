"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW_STOCK_BELOW = 20

MILLION = 1_000_000
# Whole numbers below this are exact as doubles; a larger one is cut at this bit.
EXACT_BELOW = float(1 << 53)
LOW_BITS = 20


def exact_mean(column: str) -> Column:
    """Mean of all values of a column that are not NULL.

    Values that are whole millionths, as money is, are summed as integers, in a
    high and a low part, so the result does not depend on the order in which
    tasks deliver their partial sums, as an average of doubles does, and stays
    as cheap. All other values, such as 1e-7, 1e300, NaN and infinities, are
    added as doubles, as ``avg`` adds them. Should the integers overflow, which
    takes a billion of the largest ones, the doubles are averaged instead.
    """
    value, whole, millionths = _millionths(column)
    high = F.try_sum(F.shiftright(millionths, LOW_BITS)).cast("decimal(38,0)")
    low = F.try_sum(millionths.bitwiseAND((1 << LOW_BITS) - 1)).cast("decimal(20,0)")
    money = _money(high, low)
    other = F.sum(F.when(whole, F.lit(None)).otherwise(value))
    overflowed = (F.count_if(whole) > 0) & (high.isNull() | low.isNull())
    total = F.coalesce(money + other, money, other)
    count = F.nullif(F.count(value), F.lit(0)).cast("double")
    return F.when(overflowed, F.avg(value)).otherwise(total / count)


def _millionths(column: str) -> tuple[Column, Column, Column]:
    """The value as double, whether it is whole millionths, and these as an integer if it is."""
    value = F.col(column).cast("double")
    scaled = F.rint(value * MILLION)
    whole = (F.abs(scaled) < EXACT_BELOW) & (scaled / MILLION == value)
    return value, whole, F.when(whole, scaled).cast("long")


def _money(high: Column, low: Column) -> Column:
    exact = (high * F.lit(1 << LOW_BITS).cast("decimal(10,0)") + low).cast("decimal(38,0)")
    return (exact / F.lit(MILLION).cast("decimal(7,0)")).cast("double")


def mean_sums(column: str, sign: str) -> list[Column]:
    """Sums that add up: ``high`` and ``low`` of whole millionths, how many these are, and how many others.

    Rows count ``sign`` times, so that a row taken back is one of sign -1. Sums of
    parts, and of changes, add up to those of the whole, exactly.
    """
    value, whole, millionths = _millionths(column)
    times = F.col(sign).cast("decimal(3,0)")
    high = F.shiftright(millionths, LOW_BITS).cast("decimal(20,0)")
    low = millionths.bitwiseAND((1 << LOW_BITS) - 1).cast("decimal(7,0)")

    def summed(amount: Column) -> Column:
        return F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(38,0)")

    return [
        summed(times * high).alias("high"),
        summed(times * low).alias("low"),
        F.coalesce(F.sum(F.when(whole, F.col(sign))), F.lit(0)).cast("long").alias("wholes"),
        F.coalesce(F.sum(F.when(~whole & value.isNotNull(), F.col(sign))), F.lit(0)).cast("long").alias("others"),
    ]


def mean_of_sums() -> Column:
    """The mean that ``exact_mean`` gives, from ``high``, ``low`` and ``wholes``; NULL without values.

    Holds where ``others`` is 0: doubles that are not whole millionths can't be
    taken back exactly, so their means are computed anew.
    """
    count = F.nullif(F.col("wholes"), F.lit(0)).cast("double")
    return _money(F.col("high"), F.col("low").cast("decimal(20,0)")) / count


def stock_status(quantity: str) -> Column:
    stock = F.col(quantity)
    return (
        F.when(stock.isNull(), "UNKNOWN")
        .when(stock == 0, "OUT_OF_STOCK")
        .when(stock < LOW_STOCK_BELOW, "LOW_STOCK")
        .otherwise("IN_STOCK")
    )


def sale_amount(quantity: str, unit_price: str) -> Column:
    """Line number times price: the star schema takes the line number as quantity."""
    return F.col(quantity) * F.col(unit_price)
