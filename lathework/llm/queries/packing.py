from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lathework.llm.packing import packed_documents
from lathework.registry.tables import table


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(table(spark, folder, "documents"))


QUERIES = {"op2_packing": op2_packing}
ORACLE: dict[str, str] = {}
