"""Time-use style profiles: groups of columns summed per row, averaged by derived categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.functions.values import row_sum

# Activity code prefixes of each group, first match wins.
ACTIVITY_PREFIXES = {
    "primary_needs": ["t01", "t03", "t11", "t1801", "t1803"],
    "work": ["t05", "t1805"],
    "other": ["t02", "t04", "t06", "t07", "t08", "t09", "t10", "t12", "t13", "t14", "t15", "t16", "t18"],
}
KEYS = ["working", "sex", "age"]


def group_columns(columns: Sequence[str], prefixes: Mapping[str, Sequence[str]] = ACTIVITY_PREFIXES) -> dict[str, list[str]]:
    """Column names per group by name prefix; earlier groups win and unmatched names are left out."""
    grouped: dict[str, list[str]] = {name: [] for name in prefixes}
    for column in columns:
        home = next((name for name, starts in prefixes.items() if column.startswith(tuple(starts))), None)
        if home is not None:
            grouped[home].append(column)
    return grouped


def working_status(telfs: Column) -> Column:
    return F.when((telfs >= 1) & (telfs < 3), "working").otherwise("not working")


def sex(tesex: Column) -> Column:
    return F.when(tesex == 1, "male").otherwise("female")


def age_band(teage: Column) -> Column:
    return F.when(teage.between(15, 22), "young").when(teage.between(23, 55), "active").otherwise("elder")


def summary(df: DataFrame, groups: Mapping[str, Sequence[str]], telfs: Column, tesex: Column, teage: Column,
            divisor: float = 60.0) -> DataFrame:
    """One row per respondent in the labour force (``telfs`` up to 4): three labels and the group sums."""
    return df.where(telfs <= 4).select(
        working_status(telfs).alias("working"), sex(tesex).alias("sex"), age_band(teage).alias("age"),
        *[row_sum([F.col(c) for c in columns], divisor).alias(name) for name, columns in groups.items()],
    )


def profile(summarised: DataFrame) -> DataFrame:
    """Mean of each measure by working status, sex and age, to one decimal."""
    measures = [c for c in summarised.columns if c not in KEYS]
    return summarised.groupBy(*KEYS).agg(*[F.round(F.avg(m), 1).alias(m) for m in measures]).orderBy(*KEYS)


def profile_sql(spark: SparkSession, summarised: DataFrame) -> DataFrame:
    """``profile`` in SQL text over a named relation."""
    return spark.sql(
        """
        SELECT working, sex, age,
               round(avg(primary_needs), 1) AS primary_needs,
               round(avg(work), 1) AS work,
               round(avg(other), 1) AS other
        FROM {summarised}
        GROUP BY working, sex, age
        ORDER BY working, sex, age
        """,
        summarised=summarised,
    )
