"""Measures of a directed graph given as an edge list ``src``, ``dst``.

Self-loops and repeated edges are dropped before anything is counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.plans.skew import ROWS_PER_TASK, heavy_keys, salted_join
from lathework.session import ensure_checkpoint_folder

SIDE = 5_000  # edges on a side of a cell when a middle vertex is cut into a grid


def simple_edges(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct()


def undirected(edges: DataFrame) -> DataFrame:
    """(``u``, ``v``, ``up``, ``down``) with u < v: one row per linked pair and the directions present."""
    forward = F.col("src") < F.col("dst")
    return (
        edges.where(F.col("src") != F.col("dst"))
        .groupBy(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"))
        .agg(F.max(forward).alias("up"), F.max(~forward).alias("down"))
    )


def degrees(pairs: DataFrame) -> DataFrame:
    """(``vertex``, ``degree``) of the undirected graph."""
    return (
        pairs.select(F.explode(F.array("u", "v")).alias("vertex"))
        .groupBy("vertex").agg(F.count(F.lit(1)).alias("degree"))
    )


def triplets(edges: DataFrame) -> DataFrame:
    """One row, ``triplets``: paths of two links in the undirected graph, open or closed."""
    return degrees(undirected(edges)).agg(F.coalesce(F.sum(F.expr("degree * (degree - 1) div 2")), F.lit(0)).alias("triplets"))


def oriented(edges: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(``a``, ``b``, their degrees, ``out``, ``back``): each link from its lower to its higher end by (degree, id).

    Under this order no vertex keeps more than sqrt(2 x links) outgoing links, so pairs of
    links that leave one vertex stay bounded even at a hub. ``out`` and ``back`` tell which
    directed edges exist. Degrees are attached by a salted join because a hub's own links
    all share its key. The links serve three sides of the triangle search and are
    checkpointed so that they are built once.
    """
    ensure_checkpoint_folder(edges.sparkSession)
    pairs = undirected(edges)
    degree = degrees(pairs)
    hubs = heavy_keys(degree, ["vertex"], rows_per_task, F.col("degree"))
    for end in ("u", "v"):
        named = degree.select(F.col("vertex").alias(end), F.col("degree").alias(f"{end}_degree"))
        pairs = salted_join(pairs, named, [end], hubs.withColumnRenamed("vertex", end))
    upward = F.struct("u_degree", "u") < F.struct("v_degree", "v")
    return pairs.select(*[
        F.when(upward, F.col(low)).otherwise(F.col(high)).alias(name)
        for name, low, high in (
            ("a", "u", "v"), ("b", "v", "u"), ("a_degree", "u_degree", "v_degree"), ("b_degree", "v_degree", "u_degree"),
            ("out", "up", "down"), ("back", "down", "up"),
        )
    ]).checkpoint()


def _closed(links: DataFrame) -> DataFrame:
    """Every triangle once, at the lowest vertex of the orientation, with the directions of its links."""
    near = links.select("a", "b", "b_degree", F.col("out").alias("ab"), F.col("back").alias("ba"))
    far = links.select("a", F.col("b").alias("c"), F.col("b_degree").alias("c_degree"), F.col("out").alias("ac"), F.col("back").alias("ca"))
    closing = links.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("out").alias("bc"), F.col("back").alias("cb"))
    wedges = near.join(far, "a").where(F.struct("b_degree", "b") < F.struct("c_degree", "c"))
    return wedges.drop("b_degree", "c_degree").join(closing, ["b", "c"])


def triangles(edges: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(``a``, ``b``, ``c``) with a < b < c: each triangle of the undirected graph once."""
    corners = F.sort_array(F.array("a", "b", "c"))
    return _closed(oriented(edges, rows_per_task)).select(*[corners.getItem(i).alias(n) for i, n in enumerate("abc")])


def clustering(edges: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row, ``triplets``, ``triangles`` and ``coefficient`` = 3 x triangles / triplets, null without triplets.

    Each link is an arm of degree - 1 triplets at either end, and a triplet has two arms.
    """
    links = oriented(edges, rows_per_task)
    arms = F.coalesce(F.sum(F.col("a_degree") + F.col("b_degree") - 2), F.lit(0))
    closed = _closed(links).agg(F.count(F.lit(1)).alias("triangles"))
    return (
        links.agg(arms.alias("_arms"))
        .select(F.expr("_arms div 2").alias("triplets"), closed.scalar().alias("triangles"))
        .withColumn("coefficient", F.try_divide(F.lit(3.0) * F.col("triangles"), F.col("triplets").cast("double")))
    )


def cycles3(edges: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(``vertex``, ``n``): directed cycles of three edges, each counted at its smallest vertex.

    A cycle is a triangle whose links all run the same way round, so the bounded triangle
    search serves here too and no hub's in- and out-edges are paired.
    """
    way = lambda *flags: F.when(F.col(flags[0]) & F.col(flags[1]) & F.col(flags[2]), 1).otherwise(0)
    both = way("ab", "bc", "ca") + way("ac", "cb", "ba")
    return (
        _closed(oriented(edges, rows_per_task))
        .select(F.least("a", "b", "c").alias("vertex"), both.cast("bigint").alias("n"))
        .where(F.col("n") > 0)
        .groupBy("vertex").agg(F.sum("n").alias("n"))
    )


def cycles3_total(edges: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row, ``n``: all directed cycles of three edges."""
    return cycles3(edges, rows_per_task).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def significance(edges: DataFrame, side: int = SIDE, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(``vertex``, ``n``): distinct other vertices that reach the vertex in one or two steps; none means no row.

    Reaching pairs are built through the middle vertex. A middle vertex is cut into a grid: its
    incoming edges into ceil(in / side) rows and its outgoing ones into ceil(out / side) columns.
    An edge goes to every cell of its row or column, so a cell joins at most about side x side
    pairs whatever the vertex, and every pair meets in one cell. Pairs are made distinct
    as they are built and again after the exchange.
    """
    ensure_checkpoint_folder(edges.sparkSession)
    e = simple_edges(edges).checkpoint()  # read for the degrees and by both ends of the path join
    ends = e.select(F.inline(F.array(
        F.struct(F.col("src").alias("m"), F.lit(0).alias("i"), F.lit(1).alias("o")),
        F.struct(F.col("dst").alias("m"), F.lit(1).alias("i"), F.lit(0).alias("o")),
    ))).groupBy("m").agg(F.sum("i").alias("i"), F.sum("o").alias("o"))
    parts = lambda n: F.greatest(F.ceil(F.col(n) / F.lit(side)), F.lit(1)).cast("int")
    grid = ends.where("i > 0 AND o > 0").select("m", parts("i").alias("_rows_of"), parts("o").alias("_columns_of"))
    heavy = heavy_keys(ends, ["m"], rows_per_task, F.col("i") + F.col("o"))

    def dealt(frame: DataFrame, end: str, own: str, other: str, own_part: str, other_part: str) -> DataFrame:
        placed = salted_join(frame, grid, ["m"], heavy).withColumn(own_part, F.pmod(F.xxhash64(end), F.col(own)).cast("int"))
        return placed.withColumn(other_part, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop(own, other)

    first = e.select(F.col("src").alias("x"), F.col("dst").alias("m"))
    second = e.select(F.col("src").alias("m"), F.col("dst").alias("vertex"))
    two = (
        dealt(first, "x", "_rows_of", "_columns_of", "_row", "_column")
        .join(dealt(second, "vertex", "_columns_of", "_rows_of", "_column", "_row"), ["m", "_row", "_column"])
        .where(F.col("x") != F.col("vertex")).select("x", "vertex")
    )
    reach = first.withColumnRenamed("m", "vertex").unionByName(two)
    return reach.distinct().groupBy("vertex").agg(F.count(F.lit(1)).alias("n"))
