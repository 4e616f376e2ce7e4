from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.llm import toxicity
from lathework.registry.tables import table


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit_on(docs, table(spark, folder, "labels"))
    narrow = toxicity.scored(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score")
    return narrow.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


QUERIES = {"op5_toxicity": op5_toxicity}
ORACLE: dict[str, str] = {}
