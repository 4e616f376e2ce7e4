"""The leading item of each group without sorting the rows.

``min_by`` over a struct with a string keeps a buffer of varying width, for which Spark sorts all rows. The
largest measure of a group has a fixed width and is found by hash aggregation; joined back, it
leaves only the rows that tie for it, and of these the smallest item is taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_largest(df: DataFrame, group: Sequence[str], item: str, measure: str) -> DataFrame:
    """(*``group``, ``item``, ``measure``): the item with the largest measure of each group, ties to the smaller item; null groups and measures count."""
    keys = [f"_g{i}" for i in range(len(group))]
    most = df.groupBy(*group).agg(F.max(measure).alias("_most"))
    most = most.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], "_most")
    same = F.col(measure).eqNullSafe(F.col("_most"))
    for g, k in zip(group, keys):
        same = same & F.col(g).eqNullSafe(F.col(k))
    leading = df.join(most, same).groupBy(*group, measure).agg(F.min(item).alias(item))
    return leading.select(*group, item, measure)
