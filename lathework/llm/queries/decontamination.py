from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lathework.llm.decontamination import contaminated
from lathework.registry.tables import table


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {"op7_decontamination": op7_decontamination}
ORACLE: dict[str, str] = {}
