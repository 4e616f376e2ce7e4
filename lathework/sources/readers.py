"""Readers for the text-based inputs the jobs take."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Paths = str | Sequence[str]

TRACE = ["time", "conn_id", "src_ip", "gt", "dst_ip", "protocol", "data"]
ACTIONS = ["conn_id", "action"]
PRICES = T.StructType([
    T.StructField("ticker", T.StringType()), T.StructField("date", T.IntegerType()), T.StructField("open", T.DoubleType()),
])
POSTS = T.StructType([
    T.StructField("post_type", T.IntegerType()), T.StructField("id", T.LongType()),
    T.StructField("accepted", T.LongType()), T.StructField("parent_id", T.LongType()),
    T.StructField("score", T.IntegerType()), T.StructField("tag", T.StringType()),
])
REGISTRATIONS = T.StructType([
    T.StructField(n, T.StringType()) for n in ("entering_time", "child", "parent_name", "child_name", "phone")
])
MOVES = T.StructType([T.StructField(n, T.StringType()) for n in ("ts", "sensor_id", "child", "from_room", "to_room")])
PURCHASES = T.StructType([
    T.StructField("transaction_id", T.StringType()), T.StructField("first", T.StringType()),
    T.StructField("last", T.StringType()), T.StructField("amount", T.DoubleType()),
])

# The markers around an article line's title and text, and the lengths cut from its ends.
TITLE_START, TITLE_END, TEXT_END_LENGTH = 14, "</title><text>", 16


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """``value``, one row per line of all ``paths``."""
    return spark.read.text(_paths(paths))


def records(spark: SparkSession, paths: Paths, names: Sequence[str], separator: str = r"\s+",
            types: Mapping[str, str] | None = None) -> DataFrame:
    """Fields of each line split on a regex; a missing field or a failed cast is null."""
    types = types or {}
    parts = F.split(F.trim("value"), separator)
    return lines(spark, paths).where(F.trim("value") != "").select(
        *[F.get(parts, F.lit(i)).try_cast(types.get(n, "string")).alias(n) for i, n in enumerate(names)]
    )


def delimited(spark: SparkSession, paths: Paths, schema: T.StructType | str, separator: str = ",", header: bool = False) -> DataFrame:
    """Delimited rows of a known schema; empty fields are null and missing trailing ones too."""
    return spark.read.csv(_paths(paths), schema=schema, sep=separator, header=header, enforceSchema=True)


def edges(spark: SparkSession, paths: Paths) -> DataFrame:
    """(``src``, ``dst``) from whitespace-separated pairs."""
    pairs = records(spark, paths, ["src", "dst"], types={"src": "bigint", "dst": "bigint"})
    return pairs.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def trace(spark: SparkSession, paths: Paths) -> DataFrame:
    return records(spark, paths, TRACE, r"\s", {"conn_id": "bigint"}).drop("gt")


def actions(spark: SparkSession, paths: Paths) -> DataFrame:
    return records(spark, paths, ACTIONS, r"\s", {"conn_id": "bigint"})


def header_typed(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """Column names and rows of a CSV whose header gives the schema: first column text, all others numbers."""
    header = spark.read.text(path).first()[0]
    names = header.split(",")
    schema = T.StructType([
        T.StructField(n, T.StringType() if i == 0 else T.DoubleType()) for i, n in enumerate(names)
    ])
    return names, spark.read.csv(path, schema=schema, header=True, quote="")


def posts(spark: SparkSession, paths: Paths) -> DataFrame:
    return delimited(spark, paths, POSTS)


def articles(spark: SparkSession, paths: Paths) -> DataFrame:
    """(``title``, ``text``) from lines that hold one tagged article each."""
    cut = F.instr("value", TITLE_END)
    text_from = cut + len(TITLE_END)
    return lines(spark, paths).where(cut > 0).select(
        F.substring("value", F.lit(TITLE_START + 1), cut - 1 - TITLE_START).alias("title"),
        F.substring("value", text_from, F.length("value") - TEXT_END_LENGTH - text_from + 1).alias("text"),
    )


def json_records(spark: SparkSession, paths: Paths) -> DataFrame:
    """``raw``: the text of each pretty-printed record.

    A record ends at a line that starts with a closing brace, so the files split there and
    large ones are read in parallel, unlike a whole-file multi-line read. The array brackets
    and commas around records are dropped.
    """
    pieces = spark.read.text(_paths(paths), lineSep="\n}")
    body = F.regexp_extract(F.regexp_replace("value", "\r", ""), r"(?s)(?:^|\n)(\{.*)$", 1)
    return pieces.select(body.alias("body")).where(F.col("body") != "").select(F.concat("body", F.lit("\n}")).alias("raw"))


def stream_delimited(spark: SparkSession, folder: str, schema: T.StructType, header: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """New CSV files of ``folder`` as a stream."""
    reader = spark.readStream.schema(schema).option("header", header)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder)


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def stream_table(spark: SparkSession, folder: str, name: str, bytes_per_batch: int = 2**30) -> DataFrame:
    """The parquet files of one table, a file or a folder of them, as a stream; a batch takes about ``bytes_per_batch``.

    The last letter is a pattern because a stream takes a lone file only by a pattern.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema  # fails when there is none
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_batch).parquet(f"{folder}/{name}.parque[t]")
