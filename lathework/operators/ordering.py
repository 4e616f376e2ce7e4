"""Line numbers and range-partitioned sorting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathework.session import ensure_checkpoint_folder

ROW_BITS = 33  # monotonically_increasing_id: partition number above, row in partition below


def file_place() -> list[Column]:
    """``_file`` and ``_block`` of a row: its file's path and where its split begins, which only scans of files have."""
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]


def _placed(df: DataFrame) -> DataFrame:
    """``df`` with ``_file`` and ``_block``; the partition number stands in where rows come from no file."""
    if "_file" in df.columns:
        return df
    try:
        return df.select("*", *file_place())
    except AnalysisException:
        return df.select("*", F.lit("").alias("_file"), F.spark_partition_id().cast("bigint").alias("_block"))


def number_lines(df: DataFrame, order: Sequence[str] | None = None, out: str = "num") -> DataFrame:
    """Number the rows 1..n in input order, or by ``order`` when given.

    Input order is by file path, then place in the file. The scan packs splits of files into
    partitions as it likes, but rows of a split stay together and in order, so a row's number is the
    count of rows in earlier splits and its place in its own. The first pass counts rows per split,
    a second adds the offsets; the rows themselves are never shuffled. ``df`` must be a plain
    scan with narrow steps, whose partitions come out the same in both passes; it may bring
    ``file_place`` itself. With ``order`` the sorted rows are checkpointed first, which pins them.
    """
    if order is not None:
        ensure_checkpoint_folder(df.sparkSession)
        df = df.orderBy(*order).checkpoint()
    placed = _placed(df)
    split = F.xxhash64("_file").alias("_split")
    tagged = placed.select("*", split, F.monotonically_increasing_id().alias("_id"))
    counts = (
        placed.select("_file", "_block", F.monotonically_increasing_id().alias("_id"))
        .groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_begin"))
    )
    # one row per input split: a list as short as the scan's own split list
    earlier = F.sum("_n").over(Window.orderBy("_file", "_block")) - F.col("_n")
    offsets = counts.select(split, "_block", (earlier - F.col("_begin") + 1).alias("_offset"))
    numbered = tagged.join(F.broadcast(offsets), ["_split", "_block"])
    return numbered.withColumn(out, F.col("_offset") + F.col("_id")).select(out, *[c for c in df.columns if c not in ("_file", "_block")])


def range_sorted(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Total order over partitions: ranges of ``keys``, each sorted on its own."""
    ranged = df.repartitionByRange(*keys) if partitions is None else df.repartitionByRange(partitions, *keys)
    return ranged.sortWithinPartitions(*keys)
