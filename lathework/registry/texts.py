"""Word, bigram, tag and mention statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.functions.text import words
from lathework.operators import ordering, ranking, social, text
from lathework.registry.tables import table

TERMS = ["the", "and", "la", "der", "el", "und", "les", "tion", "of", "zzz-unseen"]
TALLIED = ["the", "and"]
IDS_PER_BLOCK = 256


def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return text.word_count(table(spark, folder, "documents"), "text")


def word_count_keep_empty(spark: SparkSession, folder: str) -> DataFrame:
    return text.word_count(table(spark, folder, "documents"), "text", keep_empty=True)


def word_count_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return text.ranked(word_count(spark, folder), "n", ["word"])


def word_count_top10(spark: SparkSession, folder: str) -> DataFrame:
    return text.ranked(word_count(spark, folder), "n", ["word"], k=10)


def top_bigram_by_initial(spark: SparkSession, folder: str) -> DataFrame:
    return text.top_bigram_by_initial(table(spark, folder, "documents"), "text").orderBy("initial")


def bigram_count(spark: SparkSession, folder: str) -> DataFrame:
    return text.bigram_count(table(spark, folder, "documents"), "text")


def word_tally(spark: SparkSession, folder: str) -> DataFrame:
    return text.word_tally(table(spark, folder, "documents"), "text", TALLIED)


def line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    numbered = ordering.number_lines(table(spark, folder, "documents").select("doc_id", "text"))
    line = F.concat_ws(" ", F.col("num").cast("string"), "text")
    return numbered.select("num", "doc_id", F.md5(line).alias("line_md5"))


def line_numbers_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.number_lines(table(spark, folder, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"])


def _tags():
    return F.array_distinct(words(F.col("text")))


def tag_counts(spark: SparkSession, folder: str) -> DataFrame:
    return text.ranked(social.tag_counts(table(spark, folder, "conversations"), _tags()), "n", ["tag"])


def user_top_tag(spark: SparkSession, folder: str) -> DataFrame:
    who = F.concat_ws("/", "role", (F.col("conv_id") % 50).cast("string"))
    return social.user_top_tag(table(spark, folder, "conversations"), who, _tags())


def lang_rank(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.rank_terms(table(spark, folder, "documents"), "text", TERMS)


def lang_occurrences(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.mention_count(table(spark, folder, "documents"), "text", "the")


def lang_index(spark: SparkSession, folder: str) -> DataFrame:
    index = ranking.inverted_index(table(spark, folder, "documents"), "doc_id", "text", TERMS, IDS_PER_BLOCK)
    return index.select("term", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


def lang_index_rank(spark: SparkSession, folder: str) -> DataFrame:
    index = ranking.inverted_index(table(spark, folder, "documents"), "doc_id", "text", TERMS, IDS_PER_BLOCK)
    return ranking.rank_index(index)


QUERIES = {f.__name__: f for f in (
    word_count, word_count_keep_empty, word_count_sorted, word_count_top10, top_bigram_by_initial, bigram_count, word_tally,
    line_numbers, line_numbers_by_key, tag_counts, user_top_tag, lang_rank, lang_occurrences, lang_index, lang_index_rank,
)}

_WORDS = r"""
    SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents)
    WHERE word <> '' GROUP BY word"""
_BIGRAMS = r"""
    SELECT t[i] AS first, t[i + 1] AS second, count(*) AS n FROM (
        SELECT t, unnest(range(1, len(t))) AS i FROM (
            SELECT list_filter(list_transform(regexp_split_to_array(line, '[.!?\s]+'), lambda w: regexp_replace(lower(w), '[^a-z0-9]', '', 'g')), lambda w: w <> '') AS t
            FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)))
    GROUP BY ALL"""
_MENTIONS = "WITH m AS (SELECT doc_id, term FROM documents, (SELECT unnest([" + ", ".join(f"'{t}'" for t in TERMS) + """]) AS term)
    WHERE list_contains(string_split(text, ' '), term))"""

ORACLE = {
    "word_count": _WORDS,
    "word_count_keep_empty": r"""
        SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents) GROUP BY word""",
    "word_count_sorted": _WORDS,
    "word_count_top10": _WORDS + " ORDER BY n DESC, word LIMIT 10",
    "bigram_count": _BIGRAMS,
    "top_bigram_by_initial": f"""
        SELECT initial, arg_min(bigram, (-n, bigram)) AS bigram, max(n) AS n FROM (
            SELECT first || ' ' || second AS bigram, substr(first, 1, 1) AS initial, n FROM ({_BIGRAMS})) GROUP BY initial""",
    "word_tally": "SELECT word, count(*) FILTER (WHERE token = word) AS n FROM (SELECT unnest(string_split(text, ' ')) AS token FROM documents), "
                  "(VALUES " + ", ".join(f"('{w}')" for w in TALLIED) + ") AS chosen(word) GROUP BY word",
    "line_numbers": """
        SELECT num, doc_id, md5(num || ' ' || text) AS line_md5
        FROM (SELECT row_number() OVER (ORDER BY doc_id) AS num, doc_id, text FROM documents)""",
    "line_numbers_by_key": "SELECT row_number() OVER (ORDER BY o_custkey, o_orderkey) AS num, o_custkey, o_orderkey FROM orders",
    "tag_counts": r"""
        SELECT tag, count(*) AS n FROM (
            SELECT unnest(list_distinct(regexp_split_to_array(text, '\s+'))) AS tag FROM conversations) WHERE tag <> '' GROUP BY tag""",
    "user_top_tag": r"""
        WITH m AS (SELECT role || '/' || (conv_id % 50) AS user, text FROM conversations),
             t AS (SELECT user, tag, count(*) AS n FROM (
                     SELECT user, unnest(list_distinct(regexp_split_to_array(text, '\s+'))) AS tag FROM m) WHERE tag <> '' GROUP BY ALL),
             b AS (SELECT user, arg_min(tag, (-n, tag)) AS tag, max(n) AS tag_n FROM t GROUP BY user)
        SELECT user, count(*) AS messages, any_value(b.tag) AS tag, any_value(b.tag_n) AS tag_n FROM m LEFT JOIN b USING (user) GROUP BY user""",
    "lang_rank": _MENTIONS + "SELECT t.term, count(m.doc_id) AS n FROM (SELECT unnest([" + ", ".join(f"'{t}'" for t in TERMS) + "]) AS term) t LEFT JOIN m USING (term) GROUP BY t.term",
    "lang_occurrences": "SELECT count(*) AS n FROM documents WHERE list_contains(string_split(text, ' '), 'the')",
    "lang_index": _MENTIONS + f"SELECT term, doc_id // {IDS_PER_BLOCK} AS block, string_agg(doc_id, ',' ORDER BY doc_id) AS ids FROM m GROUP BY ALL",
    "lang_index_rank": _MENTIONS + "SELECT term, count(*) AS n FROM m GROUP BY term",
}
