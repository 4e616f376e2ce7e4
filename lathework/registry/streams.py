"""The streaming forms, drained over a whole table and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework import sinks, sources
from lathework.registry import presence as batch
from lathework.registry import texts
from lathework.registry.tables import table
from lathework.session import scratch_folder
from lathework.streaming import counts, marks, registered, restated
from lathework.streaming import lines as sl
from lathework.streaming import presence as sp


ORIGIN_US = 1704067200 * 1_000_000  # batch.ORIGIN


def _drain(stream: DataFrame) -> DataFrame:
    """The rows of a stream that has run over the whole table."""
    spark = stream.sparkSession
    folder = scratch_folder(spark)
    sinks.stream_to_table(stream, f"{folder}/rows", f"{folder}/progress", available_now=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def _events_table(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def _delay(spark: SparkSession, folder: str) -> str:
    return marks.delay_of(_events_table(spark, folder))


def _last(spark: SparkSession, folder: str) -> int | None:
    return _events_table(spark, folder).agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()[0]


def _to_its_end(spark: SparkSession, make, until_us: int, delay: str, opens_us: int | None = None) -> DataFrame:
    """All rows of the stream ``make(folder of marks)``, which runs over what there is, then over a mark that moves the watermark past ``until_us``.

    An opening mark stands in the folder before the start.
    """
    folder = scratch_folder(spark)
    marks.put_marks(spark, f"{folder}/marks", [] if opens_us is None else [opens_us])
    stream = make(f"{folder}/marks")
    for last in (False, True):
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(last).lower())  # the mark's batch tells what the first run owes
        if last:
            marks.put_marks(spark, f"{folder}/marks", [until_us + 1_000 + sp.micros(delay)])
        sinks.stream_to_table(stream, f"{folder}/rows", f"{folder}/progress", available_now=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def _bucket_end(us: int, width: str) -> int:
    return ORIGIN_US + (max(us - ORIGIN_US, 0) // sp.micros(width) + 1) * sp.micros(width)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return sources.stream_table(spark, folder, "events").select(
        "ts", F.col("user_id").alias("child"), F.col("event_type").alias("room"), F.col("event_id").alias("seq"))


def _time(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name)


def _child():
    return F.col("child").cast("bigint").alias("child")


def _alerts(spark: SparkSession, folder: str, limit: str, room: str | None) -> DataFrame:
    last, delay = _last(spark, folder), _delay(spark, folder)
    if last is None:
        return spark.createDataFrame([], "child bigint, due_ts timestamp_ntz, start_ts timestamp_ntz, room string, phone string")
    due = _to_its_end(spark, lambda at: sp.due_stays(_events(spark, folder), limit, room, batch.EXIT_ROOM, delay, at), last, delay)
    due = due.where(F.unix_micros("due_ts") <= last)  # watermarks count whole milliseconds
    return sp.with_phones(due, batch._registrations(spark, folder)).select(_child(), _time("due_ts"), _time("start_ts"), "room", "phone")


def stream_missing_alert(spark: SparkSession, folder: str) -> DataFrame:
    return _alerts(spark, folder, batch.MISSING_LIMIT, None)


def stream_unsafe_alert(spark: SparkSession, folder: str) -> DataFrame:
    return _alerts(spark, folder, batch.UNSAFE_LIMIT, batch.UNSAFE_ROOM).drop("room")


def stream_location_log(spark: SparkSession, folder: str) -> DataFrame:
    last, delay = _last(spark, folder), _delay(spark, folder)
    if last is None:
        return spark.createDataFrame([], "tick timestamp_ntz, child bigint, start_ts timestamp_ntz, room string")
    closing = sp.Ticks(ORIGIN_US, sp.micros(batch.EVERY), batch.EXIT_ROOM).closing(last)
    log = _to_its_end(spark, lambda at: sp.location_log(_events(spark, folder), ORIGIN_US, batch.EVERY, batch.EXIT_ROOM, delay, at), closing, delay)
    return log.select(_time("tick"), _child(), _time("start_ts"), "room")


def _counted(spark: SparkSession, folder: str, make, kind: str) -> DataFrame:
    """Counts that the stream itself makes, up to the bucket of the last event."""
    last, delay = _last(spark, folder), _delay(spark, folder)
    if last is None:
        return spark.createDataFrame([], kind)
    return _to_its_end(spark, lambda at: make(_events(spark, folder), at, delay=delay), _bucket_end(last, batch.WIDTH), delay, ORIGIN_US)


def stream_room_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = _counted(spark, folder, lambda events, at, delay: counts.children_per_room(
        events, at, batch.ROOMS, ORIGIN_US, batch.WIDTH, batch.EXIT_ROOM, delay), "bucket timestamp, room string, n bigint")
    return rows.select(_time("bucket"), "room", "n")


def stream_child_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = _counted(spark, folder, lambda events, at, delay: counts.rooms_per_child(
        events, at, ORIGIN_US, batch.WIDTH, batch.EXIT_ROOM, delay), "bucket timestamp, child string, n bigint")
    return rows.select(_time("bucket"), _child(), "n")


def stream_unsafe_alert_repeat(spark: SparkSession, folder: str) -> DataFrame:
    last, delay = _last(spark, folder), _delay(spark, folder)
    if last is None:
        return spark.createDataFrame([], "now timestamp_ntz, child bigint, start_ts timestamp_ntz, room string")
    packed = _to_its_end(spark, lambda at: restated.repeated_alerts(
        _events(spark, folder), at, batch.UNSAFE_LIMIT, batch.EVERY, batch.UNSAFE_ROOM, batch.EXIT_ROOM, delay, packed=True), _bucket_end(last, batch.EVERY), delay)
    # Dealt by number and time: files of packed rows are small, what comes out of them is not.
    tasks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = packed.repartitionByRange(tasks, F.element_at("times", 1), F.element_at("pieces", 1)["child"])
    return restated.told(dealt, "bigint", "timestamp_ntz")


def stream_registered_alert(spark: SparkSession, folder: str) -> DataFrame:
    """Registrations (``customer``) and moves (``events``) as two streams: alerts with the phone known when they are due."""
    key = F.col("c_custkey")
    pad = lambda size: F.lpad((key % 10**size).cast("string"), size, "0")
    phone = F.when(key % 5 != 0, F.concat_ws("-", F.lit("239"), pad(3), pad(4)))
    told = lambda customers: customers.select(
        F.timestamp_seconds(F.expr(batch.REGISTERED)).alias("ts"), (key % 150).alias("child"), (key + F.lit(2**40)).alias("seq"), phone.alias("phone"), *[c for c in customers.columns if c == "_metadata"])
    table_of = lambda name: table(spark, folder, name)
    customers = table_of("customer").select("*", "_metadata").withColumn("ts", F.timestamp_seconds(F.expr(batch.REGISTERED)))
    delays = marks.delay_of(customers), _delay(spark, folder)
    last = max((x for x in (customers.agg(F.max(F.unix_micros("ts"))).first()[0], _last(spark, folder)) if x is not None), default=None)
    if last is None:
        return spark.createDataFrame([], "child bigint, due_ts timestamp_ntz, start_ts timestamp_ntz, room string, phone string")
    longest = max(delays, key=sp.micros)
    rows = _to_its_end(spark, lambda at: registered.registered_alerts(
        registered.merged_streams(told(sources.stream_table(spark, folder, "customer")), _events(spark, folder), at, *delays), batch.MISSING_LIMIT, None, batch.EXIT_ROOM), last, longest)
    return rows.where(F.unix_micros("due_ts") <= last).select(_child(), _time("due_ts"), _time("start_ts"), "room", "phone")


def stream_discount(spark: SparkSession, folder: str) -> DataFrame:
    purchases = sources.stream_table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("transaction_id"), F.col("c_mktsegment").alias("first"), F.col("c_name").alias("last"),
        F.round("c_acctbal").alias("amount"))
    return _drain(sl.discount_lines(purchases))


def stream_word_tally(spark: SparkSession, folder: str) -> DataFrame:
    tally = sl.running_tally(sources.stream_table(spark, folder, "documents"), texts.TALLIED, "text")
    folder = scratch_folder(spark)
    name = "tally_" + folder[-32:]
    # the memory sink holds one row per chosen word
    writer = tally.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", f"{folder}/progress")
    writer.trigger(availableNow=True).start().awaitTermination()
    return sl.with_zeros(spark.table(name), texts.TALLIED)


def stream_line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_folder(spark)
    lines = sources.stream_table(spark, folder, "documents").select("doc_id", "text")
    sl.number_stream(lines, f"{out}/rows", f"{out}/progress").awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("num", "doc_id")


def stream_numbered_tally(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered texts and the tally of chosen words from one pass: the tally beside the highest number."""
    out = scratch_folder(spark)
    lines = sources.stream_table(spark, folder, "documents").select("doc_id", "text")
    sl.number_stream(lines, f"{out}/rows", f"{out}/progress", tallied=texts.TALLIED, text="text").awaitTermination()
    highest = spark.read.parquet(f"{out}/rows").agg(F.max("num").alias("lines"))
    return sl.with_zeros(sl.latest_tally(spark, f"{out}/rows"), texts.TALLIED).select("word", "n", highest.scalar().alias("lines"))


QUERIES = {f.__name__: f for f in (
    stream_missing_alert, stream_unsafe_alert, stream_location_log, stream_room_stats, stream_child_stats,
    stream_unsafe_alert_repeat, stream_registered_alert,
    stream_discount, stream_word_tally, stream_line_numbers, stream_numbered_tally,
)}

ORACLE = {
    "stream_missing_alert": batch.ORACLE["missing_alert"],
    "stream_unsafe_alert": batch.ORACLE["unsafe_alert"],
    "stream_location_log": batch.ORACLE["location_log"],
    "stream_room_stats": batch.ORACLE["room_stats"],
    "stream_child_stats": batch.ORACLE["child_stats"],
    "stream_unsafe_alert_repeat": batch.ORACLE["unsafe_alert_repeat"],
    "stream_registered_alert": f"""
        WITH told AS (
            SELECT c_custkey % 150 AS child, CAST(make_timestamp(1000000 * ({batch.REGISTERED})) AS TIMESTAMP) AS ts, '1000' AS room, 1099511627776 + c_custkey AS seq,
                   CASE WHEN c_custkey % 5 <> 0 THEN '239-' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS phone FROM customer),
          every AS (SELECT * FROM told UNION ALL SELECT user_id, ts, event_type, event_id, NULL FROM events),
          led AS (
            SELECT child, room, ts AS start_ts, lead(ts) OVER w AS end_ts, last_value(phone IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS phone
            FROM every WINDOW w AS (PARTITION BY child ORDER BY ts, seq))
        SELECT child, start_ts + INTERVAL '{batch.MISSING_LIMIT}' AS due_ts, start_ts, room, phone FROM led
        WHERE room <> '{batch.EXIT_ROOM}' AND (end_ts > start_ts + INTERVAL '{batch.MISSING_LIMIT}'
              OR (end_ts IS NULL AND start_ts + INTERVAL '{batch.MISSING_LIMIT}' <= (SELECT max(ts) FROM every)))""",
    "stream_discount": """
        SELECT c_custkey || ', ' || c_mktsegment || c_name || ', ' || amount || ', ' ||
               CASE WHEN amount >= 1000 THEN amount * CAST(0.05 AS DOUBLE) WHEN amount >= 500 THEN amount * CAST(0.02 AS DOUBLE)
                    WHEN amount >= 250 THEN amount * CAST(0.01 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS line
        FROM (SELECT *, round(c_acctbal) AS amount FROM customer)""",
    "stream_word_tally": texts.ORACLE["word_tally"],
    "stream_numbered_tally": "SELECT word, n, (SELECT count(*) FROM documents) AS lines FROM (" + texts.ORACLE["word_tally"] + ")",
    "stream_line_numbers": "SELECT row_number() OVER (ORDER BY doc_id) AS num, doc_id FROM documents",
}
