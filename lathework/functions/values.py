"""Numeric and date columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Purchase tiers, minimum amount and rate.
DISCOUNT_TIERS = [(1000.0, 0.05), (500.0, 0.02), (250.0, 0.01)]


def ratio(first: Column, second: Column) -> Column:
    """``second / first``; null when ``first`` is zero."""
    return F.try_divide(second, first)


def row_sum(columns: Iterable[Column], divisor: float = 1.0) -> Column:
    """Sum of ``columns`` over ``divisor``; an empty group is 0.0."""
    return reduce(add, columns, F.lit(0.0)) / F.lit(divisor)


def tiered(amount: Column, tiers: Sequence[tuple[float, float]] = DISCOUNT_TIERS) -> Column:
    """``amount`` times the rate of the highest tier it reaches, else 0.0."""
    out = None
    for least, rate in sorted(tiers, reverse=True):
        hit, value = amount >= least, amount * F.lit(rate)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(F.lit(0.0))


def floored_max(value: Column, floor: int = 0) -> Column:
    """Aggregate: the maximum, never below ``floor``."""
    return F.greatest(F.max(value), F.lit(floor))


def day(yyyymmdd: Column) -> Column:
    """DATE from an integer such as 20131001."""
    return F.to_date(yyyymmdd.cast("string"), "yyyyMMdd")


def clock_seconds(text: Column) -> Column:
    """Seconds since midnight of ``HH:MM:SS.mmm``."""
    parts = F.split(text, ":")
    h, m, s = (parts.getItem(i).cast("double") for i in range(3))
    return h * 3600.0 + m * 60.0 + s


def clock_millis(text: Column) -> Column:
    """Milliseconds since midnight of an unpadded ``h:m:s:ms``."""
    parts = F.split(text, ":")
    h, m, s, ms = (parts.getItem(i).cast("bigint") for i in range(4))
    return ((h * 60 + m) * 60 + s) * 1000 + ms


def clock_timestamp(text: Column, date: str) -> Column:
    """TIMESTAMP of the ``HH:MM:SS.mmm`` reading ``text`` on the day ``date``."""
    millis = F.round(clock_seconds(text) * 1000).cast("bigint")
    return F.timestamp_millis(F.unix_millis(F.lit(date).cast("timestamp")) + millis)


def tick_label(time: Column) -> Column:
    return F.date_format(time, "HH:mm")
