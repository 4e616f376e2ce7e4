from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.llm.exact_dedup import deduplicated
from lathework.registry.tables import table


def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """One half of the hash space of doc_id stands for the history, the other for the load that is checked against it; all rows are returned."""
    rows = deduplicated(table(spark, folder, "documents"), F.xxhash64("doc_id") < 0)
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES = {"op11_exact_dedup": op11_exact_dedup}

ORACLE = {
    "op11_exact_dedup": """
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256 FROM documents),
          g AS (
            SELECT doc_id, text_sha256, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
}
