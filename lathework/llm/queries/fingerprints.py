from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lathework.llm.fingerprints import edited_fingerprints
from lathework.registry.tables import table


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(table(spark, folder, "documents"))


QUERIES = {"op4_fingerprints": op4_fingerprints}
ORACLE: dict[str, str] = {}
