"""Questions with the score of their best answer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lathework.functions.values import floored_max
from lathework.operators.ranking import LANGUAGES

SPREAD = 50_000
QUESTION, ANSWER = 1, 2


def best_answers(posts: DataFrame) -> DataFrame:
    """(``id``, ``tag``, ``score``): answered questions with their highest answer score, at least 0.

    Answers collapse to one row per question before the join, so a question with very many
    answers costs no more than any other.
    """
    questions = posts.where(F.col("post_type") == QUESTION).select("id", "tag")
    best = (
        posts.where(F.col("post_type") == ANSWER)
        .groupBy(F.col("parent_id").alias("id")).agg(floored_max(F.col("score")).alias("score"))
    )
    return questions.join(best, "id")


def score_points(scored: DataFrame, tags: Sequence[str] = LANGUAGES, spread: int = SPREAD, strict: bool = False, counted: Observation | str | None = None) -> DataFrame:
    """(``id``, ``x``, ``y``): tag index times ``spread`` and score. Unknown tags are dropped, or fail when ``strict``.

    ``counted`` is given the numbers of posts with a known tag (``kept``) and without (``dropped``) by the
    job that drops them: an Observation in a batch, a name in the progress of a stream.
    """
    index = F.array_position(F.array(*[F.lit(t) for t in tags]), F.col("tag"))
    points = scored.select("id", (F.nullif(index, F.lit(0)) - 1).alias("at"), F.col("score").cast("bigint").alias("y"))
    if counted is not None:
        points = points.observe(counted, F.count_if(F.col("at").isNotNull()).alias("kept"), F.count_if(F.col("at").isNull()).alias("dropped"))
    if strict:
        known = F.when(F.col("at").isNull(), F.raise_error(F.lit("tag is not in the list"))).otherwise(F.col("at"))
        points = points.withColumn("at", known)
    return points.where(F.col("at").isNotNull()).select("id", (F.col("at") * F.lit(spread)).alias("x"), "y")
