from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lathework.llm.near_duplicates import near_duplicates
from lathework.registry.tables import table


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


QUERIES = {"op10_near_duplicates": op10_near_duplicates}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE = {
    "op10_near_duplicates": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
          s AS (
            SELECT DISTINCT doc_id, unnest(CASE len(ws) WHEN 0 THEN [] WHEN 1 THEN ws
                ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh FROM w),
          n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
          l AS (
            SELECT c.a, c.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL) c
            JOIN n na ON na.doc_id = c.a JOIN n nb ON nb.doc_id = c.b WHERE 100 * shared >= 80 * (na.n + nb.n - shared)),
          e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
          r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y),
          c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
        SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)""",
}
