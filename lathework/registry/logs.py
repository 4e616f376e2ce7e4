"""Joins, rankings, profiles and price series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathework.functions.sql import register_functions, register_trailing_average
from lathework.functions.text import before_last, field, matches
from lathework.functions.values import tiered
from lathework.operators import netlog, ordering, ranking, social, stocks, survey
from lathework.operators.text import ranked
from lathework.plans.folds import folded
from lathework.registry.tables import table

PROFILE_PREFIXES = {"primary_needs": ["l_quant", "l_ext"], "work": ["l_tax"], "other": ["l_disc", "l_line"]}
PERIODS = [("early", "1995-01-01", "1997-12-31"), ("late", "1998-06-01", "2001-12-31")]


def blocked_by_source(spark: SparkSession, folder: str) -> DataFrame:
    trace = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("conn_id"), F.col("l_suppkey").alias("source"))
    actions = table(spark, folder, "orders").select(F.col("o_orderkey").alias("conn_id"), F.col("o_orderstatus").alias("action"))
    return netlog.blocked_by_source(trace, actions, "conn_id", "source", "action", "F")


def blocked_log(spark: SparkSession, folder: str) -> DataFrame:
    trace = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("conn_id"), F.col("l_shipdate").alias("time"), F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"))
    actions = table(spark, folder, "orders").select(F.col("o_orderkey").alias("conn_id"), F.col("o_orderstatus").alias("action"))
    log = netlog.with_action(netlog.connection_log(trace, actions), "action", "F")
    return log.select("conn_id", F.date_format("time", "yyyy-MM-dd").alias("day"), "src", "dst", "action")


def top_distinct_targets(spark: SparkSession, folder: str) -> DataFrame:
    trace = table(spark, folder, "lineitem").where(matches(F.col("l_returnflag"), "R"))
    return netlog.distinct_targets(trace, F.col("l_suppkey"), F.col("l_partkey"), k=10)


def top_group_sum(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(F.concat_ws("  ", "p_name", F.col("p_retailprice").cast("string")).alias("line"))
    line = F.regexp_replace("line", r"\s+", ",")
    out = netlog.group_totals(parts, field(line, ",", 1), field(line, ",", 2), k=10)
    return out.select("key", F.round("total", 2).alias("total"))


def host_before_last_delim(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select(before_last(F.col("url"), ".").alias("prefix"))
    return netlog.count_by(pages.where(F.col("prefix").isNotNull()), "prefix")


def json_field_max(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", F.from_json("props", "k bigint").alias("p"))
    return social.user_max(events.where(F.col("p.k").isNotNull()), F.col("user_id"), F.col("p.k"))


def _profile_input(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    numeric = [f.name for f in lineitem.schema if f.dataType.simpleString() in ("double", "int")]
    return survey.summary(
        lineitem, survey.group_columns(numeric, PROFILE_PREFIXES), telfs=F.col("l_linenumber"),
        tesex=F.when(F.col("l_linestatus") == "F", 1).otherwise(2), teage=F.col("l_quantity"))


def grouped_profile(spark: SparkSession, folder: str) -> DataFrame:
    return survey.profile(_profile_input(spark, folder))


def grouped_profile_sql(spark: SparkSession, folder: str) -> DataFrame:
    return survey.profile_sql(spark, _profile_input(spark, folder))


def group_argmax(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.group_leader(table(spark, folder, "part"), "p_brand", "p_partkey", "p_retailprice")


def moving_average(spark: SparkSession, folder: str) -> DataFrame:
    lines, tasks = stocks.dealt_daily(table(spark, folder, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice"), "l_suppkey", "l_shipdate")
    daily = lines.groupBy("l_suppkey", "l_shipdate").agg(F.avg("l_extendedprice").alias("price"))
    out = stocks.trailing_average(daily, "l_suppkey", "l_shipdate", "price", 20, tasks=tasks)
    return out.select("l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), F.round("average", 6).alias("average"))


def sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Trailing averages and ratios called from SQL text."""
    register_functions(spark)
    view = "lathework_prices"
    table(spark, folder, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("day"), "l_extendedprice").createOrReplaceTempView(view)
    register_trailing_average(spark, "lathework_trailing", view, "l_suppkey", "day", "l_extendedprice", 20)
    return spark.sql("""
        SELECT ticker AS l_suppkey, date_format(date, 'yyyy-MM-dd') AS day, price, round(average, 6) AS average, round(ratio(average, price), 6) AS growth, tiered(price) AS discount
        FROM lathework_trailing(DATE '1995-01-01', DATE '1996-12-31')""")


def two_largest_prices(spark: SparkSession, folder: str) -> DataFrame:
    """The two largest different prices of each customer's orders, by a caller's own zero, seq and comb."""
    both = lambda a, b: tuple(sorted({*a, *b}, reverse=True)[:2])
    return folded(
        table(spark, folder, "orders"), ["o_custkey"], ["o_totalprice"], zero=tuple, seq=lambda state, price: both(state, (price,)), comb=both,
        done=lambda state: (*state, None, None)[:2], out=T.StructType([T.StructField("largest", T.DoubleType()), T.StructField("second", T.DoubleType())]))


def growth(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    periods = [(n, *(F.lit(d).cast("date") for d in (lo, hi))) for n, lo, hi in PERIODS]
    return stocks.growth(orders, "o_custkey", "day", "o_totalprice", periods, ties=["o_orderkey"])


def tiered_discount(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").withColumn("discount", tiered(F.col("c_acctbal")))
    line = F.concat(F.col("c_custkey").cast("string"), F.lit(", "), "c_mktsegment", "c_name", F.lit(", "), F.col("c_acctbal").cast("string"))
    return customer.select("c_custkey", "discount", line.alias("line"))


def range_sort(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ordering.range_sorted(rows, ["l_extendedprice", "l_orderkey", "l_linenumber"])


def customer_ranking(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return ranked(netlog.count_by(orders, "o_custkey"), "n", ["o_custkey"])


QUERIES = {f.__name__: f for f in (
    blocked_by_source, blocked_log, top_distinct_targets, top_group_sum, host_before_last_delim, json_field_max,
    grouped_profile, grouped_profile_sql, group_argmax, moving_average, growth, sql_functions, two_largest_prices, tiered_discount, range_sort, customer_ranking,
)}

_PROFILE = """
SELECT CASE WHEN l_linenumber >= 1 AND l_linenumber < 3 THEN 'working' ELSE 'not working' END AS working,
       CASE WHEN l_linestatus = 'F' THEN 'male' ELSE 'female' END AS sex,
       CASE WHEN l_quantity BETWEEN 15 AND 22 THEN 'young' WHEN l_quantity BETWEEN 23 AND 55 THEN 'active' ELSE 'elder' END AS age,
       round(avg((l_quantity + l_extendedprice) / 60.0), 1) AS primary_needs,
       round(avg(l_tax / 60.0), 1) AS work,
       round(avg((l_linenumber + l_discount) / 60.0), 1) AS other
FROM lineitem WHERE l_linenumber <= 4 GROUP BY ALL
"""

ORACLE = {
    "blocked_by_source": """
        SELECT l_suppkey AS source, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_orderstatus = 'F' GROUP BY l_suppkey""",
    "blocked_log": """
        SELECT l_orderkey AS conn_id, strftime(l_shipdate, '%Y-%m-%d') AS day, l_suppkey AS src, l_partkey AS dst, o_orderstatus AS action
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'""",
    "top_distinct_targets": """
        SELECT l_suppkey AS source, count(DISTINCT l_partkey) AS n FROM lineitem WHERE l_returnflag = 'R'
        GROUP BY l_suppkey ORDER BY n DESC, source LIMIT 10""",
    "top_group_sum": """
        SELECT split_part(p_name, ' ', 2) AS key, round(sum(p_retailprice), 2) AS total FROM part
        GROUP BY 1 ORDER BY sum(p_retailprice) DESC, key LIMIT 10""",
    "host_before_last_delim": r"""
        SELECT regexp_extract(url, '^(.*)\.[^.]*$', 1) AS prefix, count(*) AS n FROM pages WHERE contains(url, '.') GROUP BY 1""",
    "json_field_max": """
        SELECT user_id AS user, greatest(max(CAST(json_extract_string(props, '$.k') AS BIGINT)), 0) AS value
        FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY user_id""",
    "grouped_profile": _PROFILE,
    "grouped_profile_sql": _PROFILE,
    "group_argmax": """
        SELECT p_brand, count(*) AS n, arg_min(p_partkey, (-p_retailprice, p_partkey)) AS p_partkey, max(p_retailprice) AS p_retailprice
        FROM part GROUP BY p_brand""",
    "moving_average": """
        WITH d AS (SELECT l_suppkey, l_shipdate, avg(l_extendedprice) AS price FROM lineitem GROUP BY ALL)
        SELECT l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS day,
               round(coalesce(avg(price) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 0.0), 6) AS average
        FROM d""",
    "growth": "WITH p(period, lo, hi) AS (VALUES " + ", ".join(f"('{n}', DATE '{lo}', DATE '{hi}')" for n, lo, hi in PERIODS) + """)
        SELECT period, o_custkey,
               arg_min(o_totalprice, (CAST(o_orderdate AS DATE), o_orderkey)) AS first,
               arg_max(o_totalprice, (CAST(o_orderdate AS DATE), o_orderkey)) AS last,
               arg_max(o_totalprice, (CAST(o_orderdate AS DATE), o_orderkey))
                 / nullif(arg_min(o_totalprice, (CAST(o_orderdate AS DATE), o_orderkey)), 0) AS growth
        FROM orders JOIN p ON CAST(o_orderdate AS DATE) BETWEEN lo AND hi
        GROUP BY period, o_custkey HAVING count(*) > 1""",
    "sql_functions": """
        WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, max(l_extendedprice) AS price FROM lineitem GROUP BY ALL),
          a AS (SELECT *, coalesce(avg(price) OVER (PARTITION BY l_suppkey ORDER BY day ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 0.0) AS average FROM d)
        SELECT l_suppkey, strftime(day, '%Y-%m-%d') AS day, price, round(average, 6) AS average, round(price / nullif(average, 0), 6) AS growth,
               CASE WHEN price >= 1000 THEN price * CAST(0.05 AS DOUBLE) WHEN price >= 500 THEN price * CAST(0.02 AS DOUBLE)
                    WHEN price >= 250 THEN price * CAST(0.01 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS discount
        FROM a WHERE day BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'""",
    "two_largest_prices": """
        SELECT o_custkey, max(o_totalprice) FILTER (WHERE k = 1) AS largest, max(o_totalprice) FILTER (WHERE k = 2) AS second FROM (
            SELECT o_custkey, o_totalprice, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS k FROM orders) GROUP BY o_custkey""",
    "tiered_discount": """
        SELECT c_custkey,
               CASE WHEN c_acctbal >= 1000 THEN c_acctbal * CAST(0.05 AS DOUBLE) WHEN c_acctbal >= 500 THEN c_acctbal * CAST(0.02 AS DOUBLE)
                    WHEN c_acctbal >= 250 THEN c_acctbal * CAST(0.01 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS discount,
               c_custkey || ', ' || c_mktsegment || c_name || ', ' || c_acctbal AS line
        FROM customer""",
    "range_sort": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem",
    "customer_ranking": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey",
}
