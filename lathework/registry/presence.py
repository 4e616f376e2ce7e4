"""Presence jobs: child = user_id, room = event_type, exit = purchase, customers as registrations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.operators import presence
from lathework.plans.asof import asof_join
from lathework.registry.tables import table

ROOMS = ["click", "error", "signup", "view", "never-seen"]
EXIT_ROOM, UNSAFE_ROOM = "purchase", "error"
ORIGIN, EVERY, WIDTH = "2024-01-01 00:00:00", "6 hours", "1 day"
MISSING_LIMIT, UNSAFE_LIMIT = "12 hours", "6 hours"


#: Seconds at which the driver's customers register, spread over the month of the events.
REGISTERED = "1704067200 + (c_custkey * 7919) % 2592000"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", "ts", F.col("user_id").alias("child"), F.col("event_type").alias("room"))


def _registrations(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    pad = lambda size: F.lpad((key % 10**size).cast("string"), size, "0")
    return table(spark, folder, "customer").select(key.alias("child"), F.concat_ws("-", F.lit("239"), pad(3), pad(4)).alias("phone"))


def _parts(spark: SparkSession, folder: str):
    events = _events(spark, folder)
    return events, presence.stays(events, ["event_id"], EXIT_ROOM), presence.last_event(events)


def stays(spark: SparkSession, folder: str) -> DataFrame:
    return _parts(spark, folder)[1]


def location_log(spark: SparkSession, folder: str) -> DataFrame:
    _, stay, last = _parts(spark, folder)
    return presence.location_log(stay, last, ORIGIN, EVERY)


def missing_alert(spark: SparkSession, folder: str) -> DataFrame:
    _, stay, last = _parts(spark, folder)
    return presence.missing_alerts(stay, last, _registrations(spark, folder), MISSING_LIMIT)


def unsafe_alert(spark: SparkSession, folder: str) -> DataFrame:
    _, stay, last = _parts(spark, folder)
    return presence.unsafe_alerts(stay, last, _registrations(spark, folder), UNSAFE_ROOM, UNSAFE_LIMIT)


def room_stats(spark: SparkSession, folder: str) -> DataFrame:
    _, stay, last = _parts(spark, folder)
    return presence.room_stats(stay, last, ROOMS, ORIGIN, WIDTH)


def child_stats(spark: SparkSession, folder: str) -> DataFrame:
    _, stay, last = _parts(spark, folder)
    return presence.child_stats(stay, last, ORIGIN, WIDTH)


def unsafe_alert_repeat(spark: SparkSession, folder: str) -> DataFrame:
    events, stay, last = _parts(spark, folder)
    bucket = 6 * 3600 * 1_000_000
    return presence.repeated_alerts(events, stay, last, UNSAFE_LIMIT, bucket, UNSAFE_ROOM)


def unsafe_alert_counts(spark: SparkSession, folder: str) -> DataFrame:
    events, stay, last = _parts(spark, folder)
    counts = presence.repeat_counts(events, stay, last, UNSAFE_LIMIT, 6 * 3600 * 1_000_000, UNSAFE_ROOM)
    return counts.select("child", "start_ts", "room", "due_ts", "n")


def room_at_registration(spark: SparkSession, folder: str) -> DataFrame:
    """The room a child was in when a customer registered: the last event at or before an arbitrary time of another table."""
    asked = table(spark, folder, "customer").select(
        "c_custkey", (F.col("c_custkey") % 150).alias("child"), F.timestamp_seconds(F.expr(REGISTERED)).cast("timestamp_ntz").alias("ts"))
    known = table(spark, folder, "events").select(F.col("user_id").alias("child"), "ts", F.col("event_type").alias("room"), F.col("ts").alias("since"), "event_id")
    return asof_join(asked, known, "child", "ts", ["room", "since"], ["event_id"], "1 day")


QUERIES = {f.__name__: f for f in (room_at_registration, stays, location_log, missing_alert, unsafe_alert, unsafe_alert_repeat, unsafe_alert_counts, room_stats, child_stats)}

_STAYS = f"""WITH ev AS (
    SELECT user_id AS child, event_type AS room, ts AS start_ts,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_ts FROM events),
  s AS (SELECT * FROM ev WHERE room <> '{EXIT_ROOM}'),
  last AS (SELECT max(ts) AS last_ts FROM events),
  reg AS (SELECT c_custkey AS child, '239-' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone FROM customer)
"""


def _due(limit: str) -> str:
    return (f"s.start_ts + INTERVAL '{limit}' AS due_ts FROM s LEFT JOIN reg USING (child) "
            f"WHERE (s.end_ts > s.start_ts + INTERVAL '{limit}' OR (s.end_ts IS NULL AND s.start_ts + INTERVAL '{limit}' <= (SELECT last_ts FROM last)))")


_GRID = f"""
  , grid AS (SELECT CAST(TIMESTAMP '{ORIGIN}' + k * INTERVAL '{WIDTH}' AS TIMESTAMP) AS bucket, k
             FROM (SELECT unnest(range(0, 1 + CAST(floor(epoch(last_ts - TIMESTAMP '{ORIGIN}') / epoch(INTERVAL '{WIDTH}')) AS BIGINT))) AS k FROM last)),
  c AS (SELECT bucket, room, child FROM grid JOIN s
        ON s.start_ts < bucket + INTERVAL '{WIDTH}' AND (s.end_ts IS NULL OR s.end_ts > bucket OR s.start_ts >= bucket))
"""

ORACLE = {
    "room_at_registration": f"""
        SELECT c_custkey, a.child, a.ts, event_type AS room, e.ts AS since
        FROM (SELECT c_custkey, c_custkey % 150 AS child, CAST(make_timestamp(1000000 * ({REGISTERED})) AS TIMESTAMP) AS ts FROM customer) a
        ASOF LEFT JOIN events e ON a.child = e.user_id AND a.ts >= e.ts""",
    "stays": _STAYS + "SELECT child, room, start_ts, end_ts FROM s",
    "location_log": _STAYS + f"""
        , ticks AS (SELECT CAST(TIMESTAMP '{ORIGIN}' + k * INTERVAL '{EVERY}' AS TIMESTAMP) AS tick
                    FROM (SELECT unnest(range(0, 2 + CAST(floor(epoch(last_ts - TIMESTAMP '{ORIGIN}') / epoch(INTERVAL '{EVERY}')) AS BIGINT))) AS k FROM last))
        SELECT tick, child, start_ts, room FROM ticks JOIN s ON start_ts < tick AND (end_ts IS NULL OR tick <= end_ts)""",
    "missing_alert": _STAYS + "SELECT s.child, s.start_ts, s.room, reg.phone, " + _due(MISSING_LIMIT),
    "unsafe_alert": _STAYS + "SELECT s.child, s.start_ts, reg.phone, " + _due(UNSAFE_LIMIT) + f" AND s.room = '{UNSAFE_ROOM}'",
    "unsafe_alert_repeat": _STAYS + f"""
        SELECT e.ts AS now, s.child, s.start_ts, s.room FROM events e JOIN s
        ON e.ts >= s.start_ts + INTERVAL '{UNSAFE_LIMIT}' AND (s.end_ts IS NULL OR e.ts < s.end_ts) WHERE s.room = '{UNSAFE_ROOM}'""",
    "unsafe_alert_counts": _STAYS + f"""
        SELECT s.child, s.start_ts, s.room, s.start_ts + INTERVAL '{UNSAFE_LIMIT}' AS due_ts, count(e.ts) AS n FROM s LEFT JOIN events e
        ON e.ts >= s.start_ts + INTERVAL '{UNSAFE_LIMIT}' AND (s.end_ts IS NULL OR e.ts < s.end_ts)
        WHERE s.room = '{UNSAFE_ROOM}' AND (s.end_ts > s.start_ts + INTERVAL '{UNSAFE_LIMIT}'
              OR (s.end_ts IS NULL AND s.start_ts + INTERVAL '{UNSAFE_LIMIT}' <= (SELECT last_ts FROM last)))
        GROUP BY ALL""",
    "room_stats": _STAYS + _GRID + ", rooms AS (SELECT unnest([" + ", ".join(f"'{r}'" for r in ROOMS) + """]) AS room)
        SELECT g.bucket, r.room, count(DISTINCT c.child) AS n
        FROM grid g CROSS JOIN rooms r LEFT JOIN c ON c.bucket = g.bucket AND c.room = r.room GROUP BY ALL""",
    "child_stats": _STAYS + _GRID + "SELECT bucket, child, count(DISTINCT room) AS n FROM c GROUP BY ALL",
}
