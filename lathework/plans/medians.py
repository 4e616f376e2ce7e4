"""Exact grouped median of 32-bit integers from a histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HALF = 65536


def grouped_median(histogram: DataFrame, key: str, value: str, count: str, out: str = "median") -> DataFrame:
    """``key`` and the median of ``value`` weighted by ``count``; an even group takes the
    truncated mean of its two middle values.

    Ranks are located in two steps, first among the upper 16 bits and then among the lower
    16, so no window group holds more than 65536 rows whatever the size of the key.
    """
    hist = (
        histogram.groupBy(key, F.floor(F.col(value) / F.lit(HALF)).alias("_hi"), F.col(value).alias("_v"))
        .agg(F.sum(count).alias("_n"))
    )
    blocks = hist.groupBy(key, "_hi").agg(F.sum("_n").alias("_block"))
    upto = Window.partitionBy(key).orderBy("_hi")
    whole = Window.partitionBy(key)
    blocks = (
        blocks.withColumn("_before", F.sum("_block").over(upto) - F.col("_block"))
        .withColumn("_total", F.sum("_block").over(whole))
        .withColumn("_rank", F.explode(F.array(F.expr("(_total - 1) div 2"), F.expr("_total div 2"))))
        .where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_block")))
        .groupBy(key, "_hi")
        .agg(F.min("_before").alias("_before"), F.collect_list("_rank").alias("_ranks"))
    )
    inner = Window.partitionBy(key, "_hi").orderBy("_v")
    return (
        hist.join(blocks, [key, "_hi"])
        .withColumn("_end", F.col("_before") + F.sum("_n").over(inner))
        .withColumn("_rank", F.explode("_ranks"))
        .where((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_n")))
        .groupBy(key)
        .agg((F.expr("cast(sum(_v) as bigint) div 2")).alias(out))
    )
