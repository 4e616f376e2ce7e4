"""The last known value at the times of another table, by a union instead of a range join.

Both sides are put together and cut into slices of time. Inside a slice the last value so far is carried along in
time order; the slice's last value is handed on to the key's later slices, of which there are
at most as many as the time span has slices. So no row meets more than one other row, a key with very
many rows is as many window groups as it has slices, and nothing is paired up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lathework.plans.successor import SLICE


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, values: Sequence[str], order: Sequence[str] = (), slice_width: str = SLICE) -> DataFrame:
    """``left`` with ``values`` of the last row of ``right`` of the same ``key`` at or before its ``time``; null where there is none.

    Of rows of one time the last by ``order`` counts. Rows of ``left`` without a key or time get nulls;
    those of ``right`` are of no use. Equal rows of ``left`` stay as many as they are.
    """
    width = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval '{slice_width}'"))
    sliced = lambda df: df.withColumn("_slice", F.floor(F.unix_micros(F.col("_time").cast("timestamp")) / width))
    known = right.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(time).alias("_time"), F.lit(0).alias("_asks"), F.struct(*order, F.lit(0).alias("_")).alias("_order"), F.struct(*values).alias("_value"))
    asked = left.select(F.col(key).alias("_key"), F.col(time).alias("_time"), F.lit(1).alias("_asks"), F.struct(*left.columns).alias("_row"))
    both = sliced(known.unionByName(asked, allowMissingColumns=True))
    here = Window.partitionBy("_key", "_slice").orderBy("_time", "_asks", "_order")
    filled = both.select(
        "*", F.last("_value", ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, 0)).alias("_last"), F.lead(F.lit(1)).over(here).isNull().alias("_ends"))
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = filled.where("_ends AND _key IS NOT NULL AND _slice IS NOT NULL").select("_key", "_slice", F.last("_last", ignorenulls=True).over(before).alias("_earlier"))
    met = filled.where("_asks = 1").join(ends, ["_key", "_slice"], "left")
    value = F.when(F.col("_key").isNotNull() & F.col("_time").isNotNull(), F.coalesce("_last", "_earlier"))
    return met.select("_row", value.alias("_value")).select("_row.*", *[F.col("_value").getField(v).alias(v) for v in values])
