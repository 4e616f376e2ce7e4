from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.llm import pii
from lathework.registry.tables import table


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    candidates, classifier = pii.found(table(spark, folder, "documents"))
    counts = [F.col(f"n_{k}") for k in pii.BASE_KINDS]
    return pii.with_spans(candidates, classifier).select(
        "doc_id", *counts, F.sha2(F.array_join("base", ","), 256).alias("base_sha256"), F.array_join("spans", ",").alias("spans"))


QUERIES = {"op6_pii": op6_pii}
ORACLE: dict[str, str] = {}
