"""k-means over integer points (``x``, ``y``), means truncated to integers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathework.operators.ranking import LANGUAGES
from lathework.plans.medians import grouped_median
from lathework.session import ensure_checkpoint_folder

KERNELS, ETA, MAX_ITERATIONS = 45, 20.0, 120
GLOBAL_SAMPLE_BELOW = 500
ROWS_PER_TASK = 50_000

Centre = tuple[int, int]


def histogram(points: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(``x``, ``y``, ``n``): equal points as one weighted row, which every later step works on.

    It is checkpointed: each round reads it again, and a lost executor must not bring back
    the scan and the join behind it. Its own size sets its partitions, so that a round over a small one is one task
    without an exchange and a large one is spread.
    """
    ensure_checkpoint_folder(points.sparkSession)
    hist = points.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    tasks = max(1, -(-hist.count() // rows_per_task))
    now = hist.rdd.getNumPartitions()
    return hist.coalesce(tasks) if tasks <= now else hist.repartition(tasks, "x", "y")


def seeds(points: DataFrame, kernels: int, labels: int, spread: int, seed: int = 42) -> DataFrame:
    """(``x``, ``y``) of ``kernels`` starting centres in (``x``, draw) order.

    A wide spread draws the same number from every label, a narrow one (below 500) draws
    from all points alike. Points are drawn by the smallest hash of seed and id, so a run
    repeats; the rank limit is applied before the shuffle and keeps a few rows per label and task.
    """
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.col("id")))
    drawn = points.withColumn("_draw", draw)
    if spread < GLOBAL_SAMPLE_BELOW:
        return drawn.orderBy("_draw", "id").limit(kernels).orderBy("x", "_draw").select("x", "y")
    if kernels % labels:
        raise ValueError("kernels must be a multiple of the number of labels")
    nth = F.row_number().over(Window.partitionBy("x").orderBy("_draw", "id"))
    return (
        drawn.withColumn("_nth", nth).where(F.col("_nth") <= kernels // labels)
        .orderBy("x", "_nth").select("x", "y")
    )


def starting_centres(drawn: DataFrame, kernels: int) -> list[Centre]:
    """The drawn seeds, one row per kernel, on the driver."""
    centres = [(r.x, r.y) for r in drawn.collect()]
    if len(centres) != kernels:
        raise ValueError(f"{len(centres)} seeds drawn for {kernels} kernels")
    return centres


def nearest(x: str, y: str, centres: Sequence[Centre]) -> Column:
    """Index of the centre closest to the columns ``x`` and ``y``, the lowest on ties.

    The centres fold into one array constant, so every round runs the same generated code;
    they are written as SQL text because building hundreds of Column objects per round costs
    more than the round itself. The result is declared never null, which keeps a join on it
    from testing the whole expression against null on every input row.
    """
    table = ", ".join(f"struct({i} AS i, {int(cx)}L AS x, {int(cy)}L AS y)" for i, (cx, cy) in enumerate(centres))
    dx, dy = f"cast({x} - c.x AS double)", f"cast({y} - c.y AS double)"
    return F.expr(f"coalesce(array_min(transform(array({table}), c -> struct({dx} * {dx} + {dy} * {dy} AS d, c.i AS i))).i, -1)")


def step(hist: DataFrame, centres: Sequence[Centre]) -> DataFrame:
    """(``idx``, ``x``, ``y``, ``n``): the new mean and size of every cluster that has points."""
    return (
        hist.withColumn("idx", nearest("x", "y", centres))
        .groupBy("idx").agg(
            F.expr("sum(x * n) div sum(n)").alias("x"), F.expr("sum(y * n) div sum(n)").alias("y"), F.sum("n").alias("n")
        )
    )


def fit(hist: DataFrame, centres: Sequence[Centre], eta: float = ETA, max_iterations: int = MAX_ITERATIONS) -> tuple[list[Centre], int]:
    """Centres after convergence and the iterations taken.

    As many iterations as ``max_iterations`` mean that it did not converge.
    Each round is one job over the histogram; only the centres (one row per kernel) come to
    the driver. A cluster without points keeps its centre.
    """
    centres, taken = list(centres), 0
    while taken < max_iterations:
        taken += 1
        moved = list(centres)
        for row in step(hist, centres).collect():
            moved[row.idx] = (row.x, row.y)
        shift = sum(float(a - c) ** 2 + float(b - d) ** 2 for (a, b), (c, d) in zip(centres, moved))
        centres = moved
        if shift < eta:
            break
    return centres, taken


def centres_frame(hist: DataFrame, centres: Sequence[Centre]) -> DataFrame:
    rows = [(i, int(x), int(y)) for i, (x, y) in enumerate(centres)]
    return hist.sparkSession.createDataFrame(rows, "idx int, x bigint, y bigint")


def cluster_report(hist: DataFrame, centres: Sequence[Centre], spread: int, labels: Sequence[str] = LANGUAGES) -> DataFrame:
    """(``idx``, ``label``, ``percent``, ``size``, ``median``): dominant label, its share and the median score, by median."""
    placed = hist.withColumn("idx", nearest("x", "y", centres))
    per_label = placed.groupBy("idx", "x").agg(F.sum("n").alias("n"))
    top = per_label.groupBy("idx").agg(
        F.min_by("x", F.struct(-F.col("n"), F.col("x"))).alias("x"), F.max("n").alias("most"), F.sum("n").alias("size")
    )
    names = F.array(*[F.lit(t) for t in labels])
    return (
        top.join(grouped_median(placed, "idx", "y", "n"), "idx")
        .select(
            "idx", F.get(names, F.expr(f"x div {spread}").cast("int")).alias("label"),
            (F.col("most") * F.lit(100.0) / F.col("size")).alias("percent"), "size", "median",
        )
        .orderBy("median", "idx")
    )
