"""Stateless and counting jobs over streams of lines and purchases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lathework.functions.values import tiered
from lathework.operators.ordering import file_place, number_lines


def discount_lines(purchases: DataFrame) -> DataFrame:
    """``line``: transaction, joined name, amount and tiered discount; for a stream or a table alike."""
    amount = F.col("amount")
    return purchases.select(F.concat_ws(
        ", ", "transaction_id", F.concat("first", "last"), amount.cast("string"), tiered(amount).cast("string")
    ).alias("line"))


def running_tally(lines: DataFrame, chosen: Sequence[str], text: str = "value") -> DataFrame:
    """(``word``, ``n``) so far for the chosen blank-separated tokens; the state is one row per chosen word."""
    tokens = lines.select(F.explode(F.split(F.col(text), " ")).alias("word"))
    return tokens.where(F.col("word").isin(*chosen)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def with_zeros(tally: DataFrame, chosen: Sequence[str]) -> DataFrame:
    """The tally as read out, with a zero for every chosen word that has not occurred."""
    words = tally.sparkSession.range(1).select(F.explode(F.array(*[F.lit(w) for w in dict.fromkeys(chosen)])).alias("word"))
    return words.join(tally, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


def latest_tally(spark: SparkSession, path: str) -> DataFrame:
    """(``word``, ``n``) after the last batch of ``number_stream`` with ``tallied`` words; a row per word and batch is read at most."""
    every = spark.read.schema("word string, n bigint, batch bigint").parquet(f"{path.rstrip('/')}_tally")
    return every.groupBy("word").agg(F.max_by("n", "batch").alias("n"))


def tally_lines(tally: DataFrame) -> DataFrame:
    return tally.select(F.concat_ws(": ", "word", F.col("n").cast("string")).alias("line"))


def number_stream(lines: DataFrame, path: str, checkpoint: str, available_now: bool = True, tallied: Sequence[str] = (), text: str = "value") -> StreamingQuery:
    """Lines numbered through all batches, written to ``path``/batch=<id>.

    A batch continues after the running total that the batch before it left in
    ``path``_totals, one row. It rewrites only its own folders, so a batch that is
    repeated after a failure gives the same rows.

    With ``tallied`` words the same pass has a second output: ``path``_tally/batch=<id> holds the
    tally of all batches so far, one row per word (``latest_tally`` reads it). It is counted from the numbered rows as written, so the
    source is read once.
    """
    totals, tallies = f"{path.rstrip('/')}_totals", f"{path.rstrip('/')}_tally"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = 0
        if batch_id:
            done = spark.read.schema("total bigint").parquet(f"{totals}/batch={batch_id - 1}").first()[0]
        number_lines(batch).withColumn("num", F.col("num") + F.lit(done)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        written = spark.read.parquet(f"{path}/batch={batch_id}")
        total = written.agg(F.coalesce(F.max("num"), F.lit(done)).cast("bigint").alias("total"))
        total.write.mode("overwrite").parquet(f"{totals}/batch={batch_id}")
        if tallied:
            tally = running_tally(written, tallied, text)
            if batch_id:
                tally = tally.union(spark.read.schema("word string, n bigint").parquet(f"{tallies}/batch={batch_id - 1}"))
            tally.groupBy("word").agg(F.sum("n").alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{tallies}/batch={batch_id}")

    # a batch no longer knows its files, so every row brings its place along
    writer = lines.select("*", *file_place()).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
