"""Word and bigram statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.text import neighbours, plain_words, words
from lathework.plans.leaders import with_largest


def word_count(df: DataFrame, text: str = "value", keep_empty: bool = False) -> DataFrame:
    """(``word``, ``n``) over all rows of ``text``."""
    return (
        df.select(F.explode(words(F.col(text), keep_empty)).alias("word"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )


def ranked(df: DataFrame, measure: str, ties: Sequence[str], k: int | None = None) -> DataFrame:
    """``df`` by ``measure`` descending, ties by ``ties`` ascending; the first ``k`` rows when given."""
    ordered = df.orderBy(F.desc(measure), *ties)
    return ordered if k is None else ordered.limit(k)


def bigram_count(df: DataFrame, text: str = "value") -> DataFrame:
    """(``first``, ``second``, ``n``); pairs never cross a line break.

    The tokens are a column of their own before they are paired: a generator evaluates its
    argument anew for every use of it.
    """
    lines = df.select(F.explode(F.split(F.col(text), "\n")).alias("line"))
    tokens = lines.select(plain_words(F.col("line")).alias("tokens"))
    pairs = tokens.select(F.inline(neighbours(F.col("tokens"))))
    return pairs.groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))


def top_by_group(df: DataFrame, group: str | Column, item: str, count: str = "n") -> DataFrame:
    """The ``item`` with the largest ``count`` in each ``group``, ties to the smaller item."""
    column = F.col(group) if isinstance(group, str) else group
    named = df.select(column, item, count)
    return with_largest(named, [named.columns[0]], item, count)


def top_bigram_by_initial(df: DataFrame, text: str = "value") -> DataFrame:
    """(``initial``, ``bigram``, ``n``): the most frequent bigram for each first character."""
    counts = bigram_count(df, text).select(F.concat_ws(" ", "first", "second").alias("bigram"), "n")
    return top_by_group(counts, F.substring("bigram", 1, 1).alias("initial"), "bigram")


def word_tally(df: DataFrame, text: str, chosen: Sequence[str]) -> DataFrame:
    """(``word``, ``n``): occurrences of each chosen blank-separated token, zeros kept."""
    tokens = F.split(F.col(text), " ")
    sums = [
        F.coalesce(F.sum(F.size(tokens) - F.size(F.array_remove(tokens, w))), F.lit(0)).cast("bigint").alias(f"_{i}")
        for i, w in enumerate(chosen)
    ]
    rows = [F.struct(F.lit(w).alias("word"), F.col(f"_{i}").alias("n")) for i, w in enumerate(chosen)]
    return df.agg(*sums).select(F.inline(F.array(*rows)))
