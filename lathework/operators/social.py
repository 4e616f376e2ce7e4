"""Summaries of nested message records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathework.functions.values import floored_max
from lathework.plans.leaders import with_largest

MESSAGE = T.StructType([
    T.StructField("user", T.StructType([
        T.StructField("screen_name", T.StringType()),
        T.StructField("followers_count", T.LongType()),
    ])),
    T.StructField("entities", T.StructType([
        T.StructField("hashtags", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))),
    ])),
])


CORRUPT = "_corrupt_record"


def _parsed(df: DataFrame, raw: str, schema: T.StructType) -> DataFrame:
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.select(F.from_json(F.col(raw), marked, options).alias("_record")).select("_record.*")


def parse_json(df: DataFrame, raw: str, schema: T.StructType = MESSAGE, required: str | None = None, counted: Observation | str | None = None) -> DataFrame:
    """Fields of ``schema`` from the JSON text ``raw``; malformed records, and those without ``required``, are skipped.

    ``counted`` is given the numbers of well-formed (``kept``) and malformed (``rejected``) records by
    the job that parses them: an Observation in a batch, a name in the progress of a stream.
    """
    every = _parsed(df, raw, schema)
    if counted is not None:
        bad = F.col(CORRUPT).isNotNull()
        every = every.observe(counted, F.count_if(~bad).alias("kept"), F.count_if(bad).alias("rejected"))
    well = every.where(F.col(CORRUPT).isNull())
    return (well if required is None else well.where(F.col(required).isNotNull())).drop(CORRUPT)


def json_counts(df: DataFrame, raw: str, schema: T.StructType = MESSAGE) -> DataFrame:
    """One row, ``kept`` and ``rejected``: records ``parse_json`` keeps and malformed ones it skips."""
    bad = F.col(CORRUPT).isNotNull()
    return _parsed(df, raw, schema).agg(F.count_if(~bad).alias("kept"), F.count_if(bad).alias("rejected"))


def hashtags() -> Column:
    """Distinct tag texts of one message."""
    return F.array_distinct(F.col("entities.hashtags.text"))


def tag_counts(df: DataFrame, tags: Column) -> DataFrame:
    """(``tag``, ``n``): messages that carry the tag; ``tags`` holds distinct values per message."""
    return df.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def user_max(df: DataFrame, user: Column, value: Column) -> DataFrame:
    """(``user``, ``value``): the user's largest value, at least 0."""
    return df.groupBy(user.alias("user")).agg(floored_max(value).alias("value"))


def user_top_tag(df: DataFrame, user: Column, tags: Column) -> DataFrame:
    """(``user``, ``messages``, ``tag``, ``tag_n``): message count and most used tag, null without tags.

    A null marker per message rides along with its tags, so one aggregation counts both; figures of
    fixed width then stay in hash aggregation, and only the leading tags are compared as text.
    """
    marked = df.select(
        user.alias("user"),
        F.explode(F.concat(F.array(F.lit(None).cast("string")), F.coalesce(tags, F.array().cast("array<string>")))).alias("tag"),
    )
    counts = marked.groupBy("user", "tag").agg(F.count(F.lit(1)).alias("n"))
    tag = F.col("tag")
    counts = counts.withColumn("tag_n", F.when(tag.isNotNull(), F.col("n")))
    messages = counts.groupBy(F.col("user").alias("_user")).agg(F.sum(F.when(tag.isNull(), F.col("n"))).alias("messages"))
    best = with_largest(counts, ["user"], "tag", "tag_n")
    return best.join(messages, F.col("user").eqNullSafe(F.col("_user"))).select("user", "messages", "tag", "tag_n")
