from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lathework.llm import warc
from lathework.registry.tables import table


def op1_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.response_records(table(spark, folder, "pages"))
    return warc.derivatives(records, keep=["page_id"]).drop("record")


QUERIES = {"op1_warc_derivatives": op1_warc_derivatives}
ORACLE: dict[str, str] = {}
