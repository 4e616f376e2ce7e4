from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.llm.negatives import mined
from lathework.registry.tables import table


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").select("vec_id", label.alias("label"), "embedding", (F.col("vec_id") % 100 == 0).alias("anchor"))
    return mined(rows)


QUERIES = {"op13_hard_negatives": op13_hard_negatives}

ORACLE = {
    "op13_hard_negatives": """
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
          s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
            FROM e a JOIN e b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
          p AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
          n AS (
            SELECT p.anchor_id, p.positive_id, p.positive_score, s.other AS negative_id, s.score AS negative_score
            FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM n WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) QUALIFY row_number() OVER w <= 5""",
}
