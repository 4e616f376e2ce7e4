from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.llm.sharding import document_shards
from lathework.registry.tables import table


def op9_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    return document_shards(table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op9_hilbert_shards": op9_hilbert_shards}
ORACLE: dict[str, str] = {}
