"""Graph measures on the customer-to-order graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.operators import graph
from lathework.registry.tables import table


def edges(spark: SparkSession, folder: str) -> DataFrame:
    """o_custkey -> o_orderkey modulo the number of customers."""
    customers = table(spark, folder, "customer").agg(F.count(F.lit(1)).alias("n")).scalar()
    return table(spark, folder, "orders").select(F.col("o_custkey").alias("src"), (F.col("o_orderkey") % customers).alias("dst"))


def significance(spark: SparkSession, folder: str) -> DataFrame:
    return graph.significance(edges(spark, folder)).orderBy(F.desc("n"), "vertex")


def triplets(spark: SparkSession, folder: str) -> DataFrame:
    return graph.triplets(edges(spark, folder))


def triangles(spark: SparkSession, folder: str) -> DataFrame:
    return graph.triangles(edges(spark, folder))


def clustering(spark: SparkSession, folder: str) -> DataFrame:
    return graph.clustering(edges(spark, folder))


def cycles3(spark: SparkSession, folder: str) -> DataFrame:
    return graph.cycles3(edges(spark, folder))


def cycles3_total(spark: SparkSession, folder: str) -> DataFrame:
    return graph.cycles3_total(edges(spark, folder))


QUERIES = {f.__name__: f for f in (significance, triplets, triangles, clustering, cycles3, cycles3_total)}

_E = """WITH e AS (
    SELECT DISTINCT src, dst FROM (
        SELECT o_custkey AS src, o_orderkey % (SELECT count(*) FROM customer) AS dst FROM orders) WHERE src <> dst),
  u AS (SELECT DISTINCT least(src, dst) AS u, greatest(src, dst) AS v FROM e),
  d AS (SELECT x, count(*) AS k FROM (SELECT u AS x FROM u UNION ALL SELECT v FROM u) GROUP BY x),
  t AS (SELECT p.u AS a, p.v AS b, q.v AS c FROM u p JOIN u q ON p.v = q.u JOIN u r ON r.u = p.u AND r.v = q.v),
  c3 AS (SELECT p.src AS vertex, count(*) AS n FROM e p JOIN e q ON p.dst = q.src JOIN e r ON q.dst = r.src AND r.dst = p.src
         WHERE p.src < p.dst AND p.src < q.dst GROUP BY p.src)
"""

ORACLE = {
    "significance": _E + """
        SELECT vertex, count(*) AS n FROM (
            SELECT src AS x, dst AS vertex FROM e
            UNION SELECT p.src, q.dst FROM e p JOIN e q ON p.dst = q.src WHERE p.src <> q.dst) GROUP BY vertex""",
    "triplets": _E + "SELECT CAST(sum(k * (k - 1) // 2) AS BIGINT) AS triplets FROM d",
    "triangles": _E + "SELECT a, b, c FROM t",
    "clustering": _E + """
        SELECT s.triplets, c.triangles, 3.0::DOUBLE * c.triangles / s.triplets AS coefficient
        FROM (SELECT CAST(sum(k * (k - 1) // 2) AS BIGINT) AS triplets FROM d) s, (SELECT count(*) AS triangles FROM t) c""",
    "cycles3": _E + "SELECT vertex, n FROM c3",
    "cycles3_total": _E + "SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n FROM c3",
}
