"""The physical plans the operators are meant to get."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from lathework import registry
from lathework.operators import kmeans, netlog
from lathework.registry.tables import table

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_an_oversized_key_is_split_at_run_time(spark):
    trace = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 8).otherwise(F.col("id") % 50_000).alias("conn_id"), (F.col("id") % 100).alias("src"))
    actions = spark.range(0, 100_000, 1, 8).select((F.col("id") % 50_000).alias("conn_id"), F.lit("Blocked").alias("action"))
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    with settings(spark, low):
        df = netlog.blocked_by_source(trace, actions, "conn_id", "src", "action")
        assert sum(r.n for r in df.collect()) == 2 * 400_000
        assert "SortMergeJoin(skew=true)" in plan(df)


def test_scans_read_only_what_is_used(spark):
    text = plan(registry.QUERIES["blocked_by_source"](spark, FOLDER))
    assert "FileScan parquet [l_orderkey" in text and "l_extendedprice" not in text and "o_totalprice" not in text


def test_top_k_never_sorts_everything(spark):
    for name in ("word_count_top10", "top_distinct_targets", "top_group_sum"):
        assert "TakeOrderedAndProject" in plan(registry.QUERIES[name](spark, FOLDER))


def test_seeds_are_limited_before_the_shuffle(spark):
    points = table(spark, FOLDER, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 2).alias("x"), F.col("o_custkey").alias("y"))
    text = plan(kmeans.seeds(points, 6, 2, 50_000))
    assert text.count("WindowGroupLimit") == 2


def test_numbering_lines_moves_no_rows(spark):
    text = plan(registry.QUERIES["line_numbers"](spark, FOLDER))
    rows_side = text.split("BroadcastExchange")[0]
    assert "Exchange" not in rows_side and "BroadcastHashJoin" in rows_side


def test_registered_plans_have_no_nested_loops(spark):
    for name, query in registry.QUERIES.items():
        if name.startswith(("stream_", "kmeans", "cluster_")):
            continue
        text = plan(query(spark, FOLDER))
        assert "NestedLoop" not in text and "CartesianProduct" not in text, name


def test_a_literal_pattern_reaches_the_scan(spark):
    text = plan(registry.QUERIES["blocked_by_source"](spark, FOLDER))
    assert "EqualTo(o_orderstatus,F)" in text


@pytest.mark.parametrize("most_keys", [1, 3, 100_000])
def test_a_callers_own_aggregate(spark, most_keys):
    """Partial states are bounded by keys per task, and any zero, seq and comb give the fold of each group."""
    from pyspark.sql import types as T

    from lathework.plans.folds import folded

    rows_ = [(None if k == 7 else k, float(v) if v % 11 else None) for k in range(8) for v in range(0, 40, k + 1)] * 2
    df = spark.createDataFrame(rows_, "k int, v double").repartition(4)
    out = T.StructType([T.StructField("n", T.LongType()), T.StructField("odd", T.ArrayType(T.DoubleType()))])
    got = folded(df, ["k"], ["v"], zero=lambda: (0, frozenset()), seq=lambda s, v: (s[0] + 1, s[1] ^ {v} if v is not None else s[1]),
                 comb=lambda a, b: (a[0] + b[0], a[1] ^ b[1]), done=lambda s: (s[0], sorted(s[1])), out=out, most_keys=most_keys)
    want = {}
    for k, v in rows_:
        n, odd = want.get(k, (0, frozenset()))
        want[k] = (n + 1, odd ^ {v} if v is not None else odd)
    assert {r.k: (r.n, r.odd) for r in got.collect()} == {k: (n, sorted(odd)) for k, (n, odd) in want.items()}
    whole = folded(df, [], ["v"], zero=int, seq=lambda s, v: s + 1, comb=int.__add__, done=lambda s: (s,), out=T.StructType([T.StructField("n", T.LongType())]))
    assert [r.n for r in whole.collect()] == [len(rows_)]
    assert folded(df.limit(0), ["k"], ["v"], int, lambda s, v: s, int.__add__, lambda s: (s,), T.StructType([T.StructField("n", T.LongType())])).count() == 0


@pytest.mark.parametrize("width", ["1 second", "1 minute", "1 day"])
def test_asof_join(spark, width):
    import random
    from datetime import datetime, timedelta

    from lathework.plans.asof import asof_join

    chance, begin = random.Random(5), datetime(2024, 1, 1)
    moment = lambda: begin + timedelta(seconds=chance.randrange(400))
    known = [(chance.choice("abc") if i % 3 else "hot", moment(), i, None if i % 17 == 0 else f"v{i}") for i in range(120)] + [(None, moment(), 0, "x"), ("a", None, 0, "x")]
    asked = [(i, chance.choice(["a", "b", "c", "hot", "none"]), moment()) for i in range(80)] + [(80, None, moment()), (81, "a", None)] + [(0, "a", begin)] * 2
    left = spark.createDataFrame(asked, "id int, k string, t timestamp").repartition(3)
    right = spark.createDataFrame(known, "k string, t timestamp, seq int, v string").repartition(3)
    got = asof_join(left, right, "k", "t", ["v", "seq"], ["seq"], width)
    assert got.columns == ["id", "k", "t", "v", "seq"]

    def last(k, t):
        before = [r for r in known if k is not None and t is not None and r[0] == k and r[1] is not None and r[1] <= t]
        return (lambda r: (r[3], r[2]))(max(before, key=lambda r: (r[1], r[2]))) if before else (None, None)

    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(((i, k, t, *last(k, t)) for i, k, t in asked), key=repr)
    assert asof_join(left, right.limit(0), "k", "t", ["v"]).where("v IS NULL").count() == len(asked) and asof_join(left.limit(0), right, "k", "t", ["v"]).count() == 0


def test_leaders_without_a_sort(spark):
    from lathework.plans.leaders import with_largest

    df = spark.createDataFrame([("g", "b", 2), ("g", "a", 2), ("g", "c", 1), (None, "z", 5), ("n", "q", None), ("n", "p", None)], "g string, item string, n int")
    got = with_largest(df, ["g"], "item", "n")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == [("g", "a", 2), ("n", "p", None), (None, "z", 5)]
    plan = got.groupBy("g").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" not in plan


def test_sql_functions_unfold_into_the_plan(spark):
    from lathework.functions.sql import register_functions, register_trailing_average

    register_functions(spark)
    assert tuple(spark.sql("SELECT ratio(2D, 5D), ratio(0D, 1D), tiered(999.5D), tiered(1000D), tiered(10D)").first()) == (2.5, None, 999.5 * 0.02, 50.0, 0.0)
    spark.sql("SELECT * FROM VALUES ('a', DATE '2024-01-01', 1D), ('a', DATE '2024-01-02', 3D), ('a', DATE '2024-01-02', 2D), ('a', DATE '2024-01-03', 9D) AS t(k, d, p)").createOrReplaceTempView("prices_of_test")
    register_trailing_average(spark, "trailing_of_test", "prices_of_test", "k", "d", "p", 2)
    got = spark.sql("SELECT date, average FROM trailing_of_test(DATE '2024-01-02', DATE '2024-01-03') ORDER BY date")
    assert [r.average for r in got.collect()] == [1.0, 2.0]
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
