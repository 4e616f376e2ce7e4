from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lathework.llm.whitening import whitened
from lathework.registry.tables import table


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened(table(spark, folder, "embeddings"))


QUERIES = {"op12_whitening": op12_whitening}
ORACLE: dict[str, str] = {}  # an iteration; tests/llm/test_whitening.py holds it against numpy's eigenvectors
