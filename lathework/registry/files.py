"""Round trips of whole driver tables through files below the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lathework import sinks, sources
from lathework.functions.text import phone_shaped, words
from lathework.functions.values import clock_millis, clock_seconds
from lathework.operators import presence, social, stocks
from lathework.registry.tables import table
from lathework.session import scratch_folder
from lathework.streaming import lines as sl

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
SPAN = ("1995-01-01", "1996-12-31")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(*[c.split(" ")[0] for c in ORDERS.split(", ")])


def tabbed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Tab-separated rows written and read without a header."""
    out = scratch_folder(spark)
    sinks.write_delimited(_orders(spark, folder), out)
    return sources.delimited(spark, out, ORDERS, separator="\t")


def headed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Comma-separated rows whose header line is dropped."""
    out = scratch_folder(spark)
    _orders(spark, folder).write.csv(out, header=True)
    return sources.delimited(spark, out, ORDERS, header=True)


def header_types(spark: SparkSession, folder: str) -> DataFrame:
    """A schema taken from the header: the first column text, the others numbers."""
    out = scratch_folder(spark)
    table(spark, folder, "part").select("p_brand", "p_partkey", "p_size", "p_retailprice").write.csv(out, header=True)
    return sources.header_typed(spark, out)[1]


def post_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Posts with empty fields and an absent last one."""
    out = scratch_folder(spark)
    question = F.col("o_orderkey") % 3 == 0
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    line = F.concat_ws(
        ",", F.when(question, "1").otherwise("2"), F.col("o_orderkey").cast("string"), F.lit(""), text(F.when(~question, F.col("o_custkey"))),
        F.col("o_totalprice").cast("int").cast("string"), F.when(question, F.col("o_orderstatus")))
    sinks.write_lines(table(spark, folder, "orders").select(line.alias("value")), out)
    return sources.posts(spark, out)


def lines_of_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of two folders, counted."""
    out = scratch_folder(spark)
    docs = table(spark, folder, "documents")
    for i in range(2):
        sinks.write_lines(docs.where(F.col("doc_id") % 2 == i).select("text"), f"{out}/{i}")
    return sources.lines(spark, [f"{out}/0", f"{out}/1"]).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def article_lines(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_folder(spark)
    body = F.regexp_replace("text", "\n", " ")
    line = F.concat(F.lit("<page> <title>"), F.concat(F.lit("doc "), F.col("doc_id").cast("string")), F.lit("</title><text>"), body, F.lit("</text>  </page>"))
    sinks.write_lines(table(spark, folder, "documents").select(line.alias("value")), out)
    return sources.articles(spark, out).select("title", F.md5("text").alias("text_md5"))


def edge_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs separated by runs of blanks, some lines empty or no numbers."""
    out = scratch_folder(spark)
    line = F.when(F.col("l_linenumber") == 7, "").when(F.col("l_linenumber") == 6, "no edge").otherwise(
        F.concat(F.lit(" "), F.col("l_orderkey").cast("string"), F.lit(" \t "), F.col("l_partkey").cast("string")))
    sinks.write_lines(table(spark, folder, "lineitem").select(line.alias("value")), out)
    return sources.edges(spark, out).groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.sum("dst").alias("total"))


def split_output(spark: SparkSession, folder: str) -> DataFrame:
    """One computation written to two places."""
    out = scratch_folder(spark)
    done = F.col("o_orderstatus") == "F"
    sinks.write_split(_orders(spark, folder), [(done, f"{out}/done"), (~done, f"{out}/open")])
    part = lambda name: spark.read.schema(ORDERS).parquet(f"{out}/{name}").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "*")
    return part("done").union(part("open"))


def single_file_report(spark: SparkSession, folder: str) -> DataFrame:
    """A small report as one delimited file, read back with the number of its files."""
    out = scratch_folder(spark)
    report = _orders(spark, folder).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    sinks.write_delimited(report, out, single_file=True)
    read = sources.delimited(spark, out, "o_orderpriority string, n bigint", "\t")
    return read.withColumn("files", F.lit(len(read.inputFiles())))


def table_overwritten(spark: SparkSession, folder: str) -> DataFrame:
    """A second write takes the first one's place."""
    out = scratch_folder(spark)
    sinks.write_table(_orders(spark, folder), out)
    sinks.write_table(_orders(spark, folder).where(F.col("o_orderstatus") == "O"), out, overwrite=True)
    return spark.read.schema(ORDERS).parquet(out)


def csv_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Discounts of a stream of CSV files, appended as text lines."""
    out = scratch_folder(spark)
    purchases = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string"), "c_mktsegment", "c_name", F.round("c_acctbal"))
    purchases.write.csv(f"{out}/in", header=True)
    stream = sources.stream_delimited(spark, f"{out}/in", sources.readers.PURCHASES, header=True)
    sinks.stream_to_lines(sl.discount_lines(stream), f"{out}/lines", f"{out}/progress", available_now=True).awaitTermination()
    return spark.read.text(f"{out}/lines").select(F.col("value").alias("line"))


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as pretty-printed records read back; every tenth conversation is cut off."""
    out = scratch_folder(spark)
    tags = F.transform(words(F.col("text")), lambda w: F.struct(F.regexp_replace(w, "[^A-Za-z]", "").alias("text")))
    record = F.struct(
        F.struct(F.col("role").alias("screen_name"), F.col("conv_id").alias("followers_count")).alias("user"),
        F.struct(tags.alias("hashtags")).alias("entities"))
    whole = F.to_json(record, {"pretty": "true"})
    cut = F.lit("{\n  \"user\" : {\n    \"screen_name\" : \"cut\",")
    sinks.write_lines(table(spark, folder, "conversations").select(F.when(F.col("conv_id") % 10 == 0, F.concat(cut, F.lit("\n}"))).otherwise(whole).alias("value")), out)
    return sources.json_records(spark, out)


def message_counts(spark: SparkSession, folder: str) -> DataFrame:
    return social.json_counts(_messages(spark, folder), "raw")


def message_tags(spark: SparkSession, folder: str) -> DataFrame:
    return social.tag_counts(social.parse_json(_messages(spark, folder), "raw"), social.hashtags())


def message_tags_counted(spark: SparkSession, folder: str) -> DataFrame:
    """Tags with the numbers of records that the same job has read and rejected."""
    counted, out = Observation(), scratch_folder(spark)
    social.tag_counts(social.parse_json(_messages(spark, folder), "raw", counted=counted), social.hashtags()).write.parquet(out)
    found = counted.get
    return spark.read.parquet(out).select("tag", "n", *[F.lit(found[c]).cast("bigint").alias(c) for c in ("kept", "rejected")])


def stream_split_output(spark: SparkSession, folder: str) -> DataFrame:
    """One pass over a stream written to two places."""
    out = scratch_folder(spark)
    done = F.col("o_orderstatus") == "F"
    orders = sources.stream_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    sinks.stream_split(orders, [(done, f"{out}/done"), (~done, f"{out}/open")], f"{out}/all", f"{out}/progress", available_now=True).awaitTermination()
    part = lambda name: spark.read.schema(orders.schema).parquet(f"{out}/{name}").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "*")
    return part("done").union(part("open"))


def message_users(spark: SparkSession, folder: str) -> DataFrame:
    parsed = social.parse_json(_messages(spark, folder), "raw")
    return social.user_max(parsed, F.col("user.screen_name"), F.col("user.followers_count"))


def merged_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Registrations and moves as one event list."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    reg = table(spark, folder, "customer").select(start.alias("ts"), F.col("c_custkey").alias("child"), F.col("c_name").alias("phone"))
    moves = table(spark, folder, "events").select("ts", F.col("user_id").alias("child"), F.lit("x").alias("from_room"), F.col("event_type").alias("to_room"))
    return presence.merged_events(reg, moves)


def _clock(time: Column, pattern: str) -> Column:
    return F.date_format(time, pattern)


def clock_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Times of day as text and back, in both notations."""
    ts = F.col("ts")
    plain = F.concat_ws(":", F.hour(ts), F.minute(ts), F.second(ts), _clock(ts, "SSS").cast("int"))
    return table(spark, folder, "events").select(
        "event_id", F.round(clock_seconds(_clock(ts, "HH:mm:ss.SSS")) * 1000).cast("bigint").alias("from_padded"), clock_millis(plain).alias("from_plain"))


def report_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a report under a title line for every status."""
    return presence.as_report_lines(table(spark, folder, "orders"), "orders", "o_orderstatus", ["o_orderkey", "o_orderpriority"])


def empty_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with a leading blank have an empty first token when these are kept."""
    line = F.concat(F.when(F.col("turn") % 2 == 0, "  ").otherwise(""), F.col("role"), F.lit(" "), F.col("turn").cast("string"))
    tokens = table(spark, folder, "conversations").select(F.explode(words(line, keep_empty=True)).alias("word"))
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def phone_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of four shapes, one of them right."""
    key = F.col("c_custkey")
    pad = lambda n: F.lpad((key % 10**n).cast("string"), n, "0")
    phone = F.element_at(F.array(
        F.concat_ws("-", pad(3), pad(3), pad(4)), F.concat_ws("-", pad(2), pad(4), pad(4)), F.concat(pad(3), F.lit("-"), pad(7)), pad(10)), (key % 4 + 1).cast("int"))
    return table(spark, folder, "customer").select("c_custkey", phone_shaped(phone).alias("shaped"))


def moving_average_range(spark: SparkSession, folder: str) -> DataFrame:
    """Trailing averages of two years; their first days look back past the range."""
    lines, tasks = stocks.dealt_daily(table(spark, folder, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("day"), "l_quantity"), "l_suppkey", "day")
    daily = lines.groupBy("l_suppkey", "day").agg(F.max("l_quantity").alias("price"))
    first, last = (F.to_date(F.lit(d)) for d in SPAN)
    out = stocks.trailing_average(daily, "l_suppkey", "day", "price", 20, first, last, tasks)
    return out.select("l_suppkey", F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("average", 6).alias("average"))


QUERIES = {f.__name__: f for f in (
    tabbed_rows, headed_rows, header_types, post_rows, lines_of_folders, article_lines, edge_lines, split_output, table_overwritten,
    message_tags_counted, stream_split_output, single_file_report,
    csv_stream, message_counts, message_tags, message_users, merged_sources, clock_readings, report_lines, empty_tokens, phone_shapes,
    moving_average_range,
)}

_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
_LINE = """CASE WHEN amount >= 1000 THEN amount * CAST(0.05 AS DOUBLE) WHEN amount >= 500 THEN amount * CAST(0.02 AS DOUBLE)
           WHEN amount >= 250 THEN amount * CAST(0.01 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"""

ORACLE = {
    "tabbed_rows": f"SELECT {_COLUMNS} FROM orders",
    "headed_rows": f"SELECT {_COLUMNS} FROM orders",
    "header_types": "SELECT p_brand, CAST(p_partkey AS DOUBLE) AS p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part",
    "post_rows": """
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS post_type, o_orderkey AS id, CAST(NULL AS BIGINT) AS accepted,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS parent_id, CAST(trunc(o_totalprice) AS INTEGER) AS score,
               CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS tag FROM orders""",
    "lines_of_folders": "SELECT value, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents) GROUP BY value",
    "article_lines": "SELECT 'doc ' || doc_id AS title, md5(replace(text, chr(10), ' ')) AS text_md5 FROM documents",
    "edge_lines": "SELECT l_orderkey AS src, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS total FROM lineitem WHERE l_linenumber < 6 GROUP BY 1",
    "split_output": """
        SELECT CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS part, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL""",
    "single_file_report": "SELECT o_orderpriority, count(*) AS n, 1 AS files FROM orders GROUP BY o_orderpriority",
    "table_overwritten": f"SELECT {_COLUMNS} FROM orders WHERE o_orderstatus = 'O'",
    "csv_stream": f"""
        SELECT c_custkey || ', ' || c_mktsegment || c_name || ', ' || amount || ', ' || {_LINE} AS line
        FROM (SELECT *, round(c_acctbal) AS amount FROM customer)""",
    "message_counts": "SELECT count(*) FILTER (WHERE conv_id % 10 <> 0) AS kept, count(*) FILTER (WHERE conv_id % 10 = 0) AS rejected FROM conversations",
    "message_tags": """
        SELECT tag, count(*) AS n FROM (
          SELECT DISTINCT conv_id, turn, regexp_replace(tag, '[^A-Za-z]', '', 'g') AS tag FROM (
            SELECT conv_id, turn, unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS tag
            FROM conversations WHERE conv_id % 10 <> 0)) GROUP BY tag""",
    "message_tags_counted": """
        SELECT tag, count(*) AS n, (SELECT count(*) FROM conversations WHERE conv_id % 10 <> 0) AS kept, (SELECT count(*) FROM conversations WHERE conv_id % 10 = 0) AS rejected FROM (
          SELECT DISTINCT conv_id, turn, regexp_replace(tag, '[^A-Za-z]', '', 'g') AS tag FROM (
            SELECT conv_id, turn, unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS tag
            FROM conversations WHERE conv_id % 10 <> 0)) GROUP BY tag""",
    "stream_split_output": """
        SELECT CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS part, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL""",
    "message_users": 'SELECT role AS "user", greatest(max(conv_id), 0) AS value FROM conversations WHERE conv_id % 10 <> 0 GROUP BY role',
    "merged_sources": """
        SELECT CAST('2024-01-01' AS TIMESTAMP) AS ts, c_custkey AS child, '1000' AS room, c_name AS phone, 1 AS seq FROM customer
        UNION ALL SELECT ts, user_id, event_type, NULL, 0 FROM events""",
    "clock_readings": """
        SELECT event_id, ms AS from_padded, ms AS from_plain FROM (
          SELECT event_id, CAST((hour(ts) * 60 + minute(ts)) * 60000 + millisecond(ts) AS BIGINT) AS ms FROM events)""",
    "report_lines": """
        SELECT o_orderstatus AS stamp, 1 AS line_no, o_orderkey || ', ' || o_orderpriority AS line FROM orders
        UNION ALL SELECT DISTINCT o_orderstatus, 0, '========= ' || o_orderstatus || ' orders =========' FROM orders""",
    "empty_tokens": """
        SELECT word, count(*) AS n FROM (
          SELECT unnest([role, CAST(turn AS VARCHAR)]) AS word FROM conversations
          UNION ALL SELECT '' FROM conversations WHERE turn % 2 = 0) GROUP BY word""",
    "phone_shapes": "SELECT c_custkey, c_custkey % 4 = 0 AS shaped FROM customer",
    "moving_average_range": f"""
        WITH daily AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, max(l_quantity) AS price FROM lineitem GROUP BY ALL),
          a AS (SELECT l_suppkey, d, coalesce(avg(price) OVER (PARTITION BY l_suppkey ORDER BY d ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 0) AS average FROM daily)
        SELECT l_suppkey, strftime(d, '%Y-%m-%d') AS day, round(average, 6) AS average FROM a WHERE d BETWEEN DATE '{SPAN[0]}' AND DATE '{SPAN[1]}'""",
}
