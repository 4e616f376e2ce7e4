from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.llm import html
from lathework.registry.tables import table


def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    texts = html.extracted(pages.select("page_id", "url", "html"), html.learn(pages))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


QUERIES = {"op3_main_text": op3_main_text}
ORACLE: dict[str, str] = {}
