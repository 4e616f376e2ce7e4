from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.llm import language
from lathework.registry.tables import table


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    net = language.fit_on(docs)
    return language.predicted(docs.select("doc_id", "text"), net).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {"op8_language": op8_language}
ORACLE: dict[str, str] = {}
