"""Group leaders and mention rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.text import mentioned
from lathework.operators.text import ranked
from lathework.plans.leaders import with_largest

# The programming languages that are ranked and clustered, in index order.
LANGUAGES = [
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
]


def group_leader(df: DataFrame, group: str, item: str, measure: str) -> DataFrame:
    """(``group``, ``n``, ``item``, ``measure``): row count and the item with the largest measure, most rows first."""
    sizes = df.groupBy(F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("n"))
    leaders = with_largest(df.select(group, item, measure), [group], item, measure)
    return ranked(leaders.join(sizes, F.col(group).eqNullSafe(F.col("_group"))).select(group, "n", item, measure), "n", [group])


def mentions(docs: DataFrame, text: str, terms: Sequence[str] = LANGUAGES, keep: Sequence[str] = ()) -> DataFrame:
    """One row per (document, mentioned term), with the columns ``keep``."""
    return docs.select(*keep, F.explode(mentioned(F.col(text), terms)).alias("term"))


def mention_count(docs: DataFrame, text: str, term: str) -> DataFrame:
    """One row, ``n``: documents that mention ``term``."""
    return docs.where(F.array_contains(F.split(F.col(text), " "), term)).agg(F.count(F.lit(1)).alias("n"))


def rank_terms(docs: DataFrame, text: str, terms: Sequence[str] = LANGUAGES, zeros: bool = True) -> DataFrame:
    """(``term``, ``n``): documents per term in one pass, most first; ``zeros`` keeps unmentioned terms."""
    counts = mentions(docs, text, terms).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    if zeros:
        blank = docs.sparkSession.range(1).select(F.explode(F.array(*[F.lit(t) for t in terms])).alias("term"), F.lit(0).cast("bigint").alias("n"))
        counts = counts.unionByName(blank).groupBy("term").agg(F.sum("n").alias("n"))
    return ranked(counts, "n", ["term"])


def inverted_index(docs: DataFrame, doc_id: str, text: str, terms: Sequence[str] = LANGUAGES, ids_per_block: int = 65_536) -> DataFrame:
    """(``term``, ``block``, ``ids``): sorted document ids of each term, in blocks of the id range.

    A frequent term spans many blocks and a block holds each id once, so no list outgrows
    ``ids_per_block`` and no task gathers a whole term.
    """
    block = F.floor(F.col(doc_id) / F.lit(ids_per_block)).alias("block")
    return mentions(docs, text, terms, [F.col(doc_id).alias("id"), block]).groupBy("term", "block").agg(
        F.sort_array(F.collect_set("id")).alias("ids")
    )


def rank_index(index: DataFrame) -> DataFrame:
    """(``term``, ``n``) from an inverted index, most first."""
    return ranked(index.groupBy("term").agg(F.sum(F.size("ids")).alias("n")), "n", ["term"])
