"""Price series: trailing averages and growth factors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lathework.functions.values import ratio

ROWS_PER_TASK = 1_000_000


def dealt_daily(rows: DataFrame, ticker: str, date: str, rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, int]:
    """``rows`` dealt by ticker and date over as many tasks as they fill, and that number.

    Nearly every row can be a group of its own, so a grouping holds a task's rows in memory; with a
    fixed number of shuffle partitions that grows with the input. ``rows`` are counted, so they should come right from a table.
    """
    tasks = max(-(-rows.count() // rows_per_task), rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(tasks, ticker, date), tasks


def trailing_average(prices: DataFrame, ticker: str, date: str, price: str, days: int = 20,
                     first=None, last=None, tasks: int | None = None) -> DataFrame:
    """(ticker, date, price, ``average``): mean price of the ``days`` previous trading days.

    The current day is left out, a shorter history averages what there is and none gives 0.0.
    A date that occurs twice keeps its larger price; that aggregation runs before the window,
    so a ticker brings at most one row per calendar date (``date`` is a DATE or a yyyymmdd
    integer) to it. The date range is cut after
    the window because its first days look back past it. ``tasks``, which ``dealt_daily`` gives beside its rows, deals the tickers to the window.
    """
    daily = prices.groupBy(ticker, date).agg(F.max(price).alias(price))
    daily = daily.repartition(tasks, ticker) if tasks else daily
    before = Window.partitionBy(ticker).orderBy(date).rowsBetween(-days, -1)
    out = daily.withColumn("average", F.coalesce(F.avg(price).over(before), F.lit(0.0)))
    if first is not None:
        out = out.where(F.col(date) >= F.lit(first))
    if last is not None:
        out = out.where(F.col(date) <= F.lit(last))
    return out


def growth(prices: DataFrame, ticker: str, date: str, price: str, periods: Sequence[tuple[str, object, object]],
           ties: Sequence[str] = ()) -> DataFrame:
    """(``period``, ticker, ``first``, ``last``, ``growth``): last over first price in each period, both ends inclusive.

    Tickers with a single row in a period are left out and a zero first price gives null.
    All periods come from one scan and one aggregation. ``ties`` order rows of the same date.
    """
    within = [F.col(date).between(F.lit(lo), F.lit(hi)) for _, lo, hi in periods]
    named = F.array_compact(F.array(*[F.when(w, F.lit(name)) for w, (name, _, _) in zip(within, periods)]))
    tagged = prices.where(reduce(or_, within)).select(ticker, price, date, *ties, F.explode(named).alias("period"))
    order = F.struct(date, *ties) if ties else F.col(date)
    ends = tagged.groupBy("period", ticker).agg(
        F.min_by(price, order).alias("first"), F.max_by(price, order).alias("last"), F.count(F.lit(1)).alias("_n")
    )
    return (
        ends.where(F.col("_n") > 1)
        .select("period", ticker, "first", "last", ratio(F.col("first"), F.col("last")).alias("growth"))
        .orderBy("period", F.desc("growth"), ticker)
    )
