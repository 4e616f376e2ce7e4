"""Connection logs: joins, filters and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.text import matches
from lathework.operators.text import ranked


def connection_log(trace: DataFrame, actions: DataFrame, key: str = "conn_id") -> DataFrame:
    """Trace rows with the action taken on their connection; repeated ids multiply."""
    return trace.join(actions, key)


def with_action(log: DataFrame, action: str, pattern: str) -> DataFrame:
    return log.where(matches(F.col(action), pattern))


def count_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def blocked_by_source(trace: DataFrame, actions: DataFrame, key: str, source: str, action: str,
                      pattern: str = "Blocked") -> DataFrame:
    """(``source``, ``n``): matching connections per source, most first.

    Only the key and the source enter the join, and repeated actions on a connection enter as
    one row with a count, so an id that is frequent on both sides is never multiplied out.
    Grouping by the action as well leaves the join its own exchange on the key, which is what
    lets an oversized key of the trace be split at run time.
    """
    hits = with_action(actions, action, pattern).groupBy(key, action).agg(F.count(F.lit(1)).alias("_times"))
    hit = trace.select(key, source).join(hits, key)
    return ranked(hit.groupBy(source).agg(F.sum("_times").alias("n")), "n", [source])


def distinct_targets(df: DataFrame, source: Column, target: Column, k: int | None = None) -> DataFrame:
    """(``source``, ``n``): distinct targets contacted by each source, most first."""
    counts = df.groupBy(source.alias("source")).agg(F.count_distinct(target).alias("n"))
    return ranked(counts, "n", ["source"], k)


def group_totals(df: DataFrame, key: Column, measure: Column, k: int | None = None) -> DataFrame:
    """(``key``, ``total``): the measure summed per key, largest first; unreadable measures are skipped."""
    sums = df.groupBy(key.alias("key")).agg(F.sum(measure.try_cast("double")).alias("total"))
    return ranked(sums, "total", ["key"], k)
