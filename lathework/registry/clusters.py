"""Post scores and k-means: orders are questions, their line items the answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lathework.operators import kmeans as km
from lathework.operators import posts as po
from lathework.registry.tables import table
from lathework.session import scratch_folder

TAGS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FIXED_CENTRES = [(i * po.SPREAD, 100 * j + 50) for i in range(len(TAGS)) for j in range(9)]


def _posts(spark: SparkSession, folder: str) -> DataFrame:
    questions = table(spark, folder, "orders").select(
        F.lit(po.QUESTION).alias("post_type"), F.col("o_orderkey").alias("id"), F.lit(None).cast("bigint").alias("parent_id"),
        F.lit(0).cast("bigint").alias("score"), F.col("o_orderpriority").alias("tag"))
    answers = table(spark, folder, "lineitem").select(
        F.lit(po.ANSWER).alias("post_type"), F.lit(None).cast("bigint").alias("id"), F.col("l_orderkey").alias("parent_id"),
        F.floor(F.col("l_extendedprice") / 100).alias("score"), F.lit(None).cast("string").alias("tag"))
    return questions.unionByName(answers)


def _points(spark: SparkSession, folder: str) -> DataFrame:
    return po.score_points(po.best_answers(_posts(spark, folder)), TAGS)


def _seeds(spark: SparkSession, folder: str) -> DataFrame:
    return km.seeds(_points(spark, folder), km.KERNELS, len(TAGS), po.SPREAD)


def post_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _points(spark, folder)


def post_points_counted(spark: SparkSession, folder: str) -> DataFrame:
    """Posts whose tag is in the list and those that are dropped, counted by the job that drops them."""
    counted = Observation()
    po.score_points(po.best_answers(_posts(spark, folder)), TAGS[:-2], counted=counted).write.format("noop").mode("overwrite").save()
    found = counted.get
    return spark.range(1).select(*[F.lit(found[c]).cast("bigint").alias(c) for c in ("kept", "dropped")])


def kmeans_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return _seeds(spark, folder)


def kmeans_step(spark: SparkSession, folder: str) -> DataFrame:
    return km.step(km.histogram(_points(spark, folder)), FIXED_CENTRES)


def _fitted(spark: SparkSession, folder: str):
    """The points are written once; the histogram and the seeds read them from there."""
    out = scratch_folder(spark)
    points = _points(spark, folder)
    points.write.parquet(out)
    points = spark.read.schema(points.schema).parquet(out)
    hist = km.histogram(points)
    drawn = km.seeds(points, km.KERNELS, len(TAGS), po.SPREAD)
    return hist, *km.fit(hist, km.starting_centres(drawn, km.KERNELS))


def kmeans(spark: SparkSession, folder: str) -> DataFrame:
    hist, centres, _ = _fitted(spark, folder)
    return km.centres_frame(hist, centres)


def kmeans_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """How many rounds the fit took and whether it converged."""
    hist, _, taken = _fitted(spark, folder)
    return hist.sparkSession.range(1).select(F.lit(taken).alias("rounds"), F.lit(taken < km.MAX_ITERATIONS).alias("converged"))


def kmeans_seeds_global(spark: SparkSession, folder: str) -> DataFrame:
    """Seeds of a narrow spread, drawn from all points alike."""
    return km.seeds(_points(spark, folder), km.KERNELS, len(TAGS), km.GLOBAL_SAMPLE_BELOW - 1)


def cluster_report(spark: SparkSession, folder: str) -> DataFrame:
    hist, centres, _ = _fitted(spark, folder)
    return km.cluster_report(hist, centres, po.SPREAD, TAGS)


QUERIES = {f.__name__: f for f in (post_scores, post_points_counted, kmeans_seeds, kmeans_seeds_global, kmeans_step, kmeans, kmeans_rounds, cluster_report)}

_POINTS = """pts AS (
    SELECT o_orderkey AS id, CAST((list_position([""" + ", ".join(f"'{t}'" for t in TAGS) + f"""], o_orderpriority) - 1) * {po.SPREAD} AS BIGINT) AS x,
           CAST(greatest(best, 0) AS BIGINT) AS y
    FROM orders JOIN (SELECT l_orderkey, max(floor(l_extendedprice / 100)) AS best FROM lineitem GROUP BY l_orderkey) a ON l_orderkey = o_orderkey),
  hist AS (SELECT x, y, count(*) AS n FROM pts GROUP BY ALL),
  drawn AS (SELECT x, y, row_number() OVER (PARTITION BY x ORDER BY md5('42:' || id), id) AS nth FROM pts)
"""
_NEAREST = "arg_min(c.idx, ((h.x - c.x) * (h.x - c.x) + (h.y - c.y) * (h.y - c.y), c.idx))"
_LOOP = "WITH RECURSIVE " + _POINTS + f""",
  seeds AS (SELECT CAST(row_number() OVER (ORDER BY x, nth) - 1 AS INTEGER) AS idx, x, y FROM drawn WHERE nth <= {km.KERNELS // len(TAGS)}),
  loop AS (
    SELECT 0 AS it, idx, x, y, CAST(1e18 AS DOUBLE) AS shift FROM seeds
    UNION ALL
    SELECT it, idx, nx, ny, sum(CAST((nx - ox) * (nx - ox) + (ny - oy) * (ny - oy) AS DOUBLE)) OVER () AS shift FROM (
        SELECT l.it + 1 AS it, l.idx, l.x AS ox, l.y AS oy,
               CAST(coalesce(m.x, l.x) AS BIGINT) AS nx, CAST(coalesce(m.y, l.y) AS BIGINT) AS ny
        FROM loop l LEFT JOIN (
            SELECT idx, sum(x * n) // sum(n) AS x, sum(y * n) // sum(n) AS y FROM (
                SELECT {_NEAREST} AS idx, h.x, h.y, any_value(h.n) AS n FROM hist h CROSS JOIN loop c GROUP BY h.x, h.y)
            GROUP BY idx) m ON m.idx = l.idx
        WHERE l.shift >= {km.ETA} AND l.it < {km.MAX_ITERATIONS})),
  centres AS (SELECT idx, x, y FROM loop WHERE it = (SELECT max(it) FROM loop))
"""

ORACLE = {
    "post_scores": "WITH " + _POINTS + "SELECT id, x, y FROM pts",
    "post_points_counted": f"""
        SELECT count(*) FILTER (WHERE tag IN ({", ".join(f"'{t}'" for t in TAGS[:-2])})) AS kept, count(*) FILTER (WHERE tag IS NULL OR tag NOT IN ({", ".join(f"'{t}'" for t in TAGS[:-2])})) AS dropped
        FROM (SELECT o_orderpriority AS tag FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))""",
    "kmeans_seeds": "WITH " + _POINTS + f"SELECT x, y FROM drawn WHERE nth <= {km.KERNELS // len(TAGS)}",
    "kmeans_step": "WITH " + _POINTS + ", c(idx, x, y) AS (VALUES " + ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(FIXED_CENTRES)) + f""")
        SELECT CAST(idx AS INTEGER) AS idx, CAST(sum(x * n) // sum(n) AS BIGINT) AS x, CAST(sum(y * n) // sum(n) AS BIGINT) AS y, CAST(sum(n) AS BIGINT) AS n FROM (
            SELECT {_NEAREST} AS idx, h.x, h.y, any_value(h.n) AS n FROM hist h CROSS JOIN c GROUP BY h.x, h.y) GROUP BY idx""",
    "kmeans_seeds_global": "WITH " + _POINTS + f"SELECT x, y FROM pts ORDER BY md5('42:' || id), id LIMIT {km.KERNELS}",
    "kmeans_rounds": _LOOP + f"SELECT CAST(max(it) AS INTEGER) AS rounds, max(it) < {km.MAX_ITERATIONS} AS converged FROM loop",
    "kmeans": _LOOP + "SELECT idx, x, y FROM centres",
    "cluster_report": _LOOP + f"""
        , placed AS (SELECT {_NEAREST} AS idx, h.x, h.y, any_value(h.n) AS n FROM hist h CROSS JOIN centres c GROUP BY h.x, h.y),
          rows_ AS (SELECT idx, x, y FROM placed, range(n)),
          lab AS (SELECT idx, x, sum(n) AS n FROM placed GROUP BY ALL),
          top AS (SELECT idx, arg_min(x, (-n, x)) AS x, max(n) AS most, sum(n) AS size FROM lab GROUP BY idx),
          ranked AS (SELECT idx, y, row_number() OVER (PARTITION BY idx ORDER BY y) - 1 AS r, count(*) OVER (PARTITION BY idx) AS k FROM rows_),
          med AS (SELECT idx, CAST(sum(y) FILTER (WHERE r = (k - 1) // 2) + sum(y) FILTER (WHERE r = k // 2) AS BIGINT) // 2 AS median FROM ranked GROUP BY idx)
        SELECT top.idx, [""" + ", ".join(f"'{t}'" for t in TAGS) + f"""][top.x // {po.SPREAD} + 1] AS label,
               most * 100.0::DOUBLE / size AS percent, CAST(size AS BIGINT) AS size, median
        FROM top JOIN med USING (idx)""",
}
