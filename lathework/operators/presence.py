"""Presence of children in rooms: stays, location reports, alerts and occupancy.

A stay lasts from one event of a child up to the child's next event. An exit event opens no
stay; the last stay of a child that never exits is open (``end_ts`` null) and counts until
the last event of all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathework.functions.text import phone_shaped
from lathework.plans.intervals import points_in_intervals
from lathework.plans.skew import ROWS_PER_TASK
from lathework.plans.successor import SLICE, with_next_time

# The entrance every registration leads into, the exit and the guarded room.
ENTRANCE, EXIT, UNSAFE = "1000", "E", "26"


def merged_events(registrations: DataFrame, moves: DataFrame, entrance: str = ENTRANCE) -> DataFrame:
    """(``ts``, ``child``, ``room``, ``phone``, ``seq``) of both sources; at equal times a sensor move comes first."""
    entered = registrations.select("ts", "child", F.lit(entrance).alias("room"), "phone", F.lit(1).alias("seq"))
    moved = moves.select("ts", "child", F.col("to_room").alias("room"), F.lit(None).cast("string").alias("phone"), F.lit(0).alias("seq"))
    return entered.unionByName(moved)


def stays(events: DataFrame, order: Sequence[str] = (), exit_room: str = EXIT,
          slice_width: str = SLICE, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(``child``, ``room``, ``start_ts``, ``end_ts``) from events (``ts``, ``child``, ``room``); copies of an event count once."""
    led = with_next_time(events.select("child", "ts", "room", *order), "child", "ts", list(order), "end_ts",
                         slice_width, rows_per_task)
    return led.where(F.col("room") != exit_room).select("child", "room", F.col("ts").alias("start_ts"), "end_ts")


def last_event(events: DataFrame) -> DataFrame:
    """One row, ``last_ts``."""
    return events.agg(F.max("ts").alias("last_ts"))


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def _span(width: str) -> Column:
    return F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval '{width}'"))


def _grid_time(index: Column, origin: str, width: str, like: str) -> Column:
    at = F.timestamp_micros(_micros(F.lit(origin)) + index * _span(width))
    return at.cast(like)


def _time_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _cell(time: Column, origin: str, width: str) -> Column:
    """Index of the grid cell that holds ``time``; everything before the origin is in cell 0."""
    return F.greatest(F.floor((_micros(time) - _micros(F.lit(origin))) / _span(width)), F.lit(0))


def location_log(stay: DataFrame, last: DataFrame, origin: str, every: str) -> DataFrame:
    """(``tick``, ``child``, ``start_ts``, ``room``): where each child inside was last seen, at every tick.

    A tick reports events strictly before it; one closing tick follows the last event. Each
    stay yields its own ticks, so nothing is shuffled.
    """
    offset = lambda t: _micros(t) - _micros(F.lit(origin))
    after = lambda t: F.greatest(F.floor(offset(t) / _span(every)) + 1, F.lit(0))
    final = after(last.scalar())
    upto = F.when(F.col("end_ts").isNull(), final).otherwise(F.floor(offset(F.col("end_ts")) / _span(every)))
    begin = after(F.col("start_ts"))
    kind = _time_type(stay, "start_ts")
    return (
        stay.withColumn("_from", begin).withColumn("_to", upto)
        .where(F.col("_to") >= F.col("_from"))
        .select("child", "start_ts", "room", F.explode(F.sequence("_from", "_to")).alias("_k"))
        .select(_grid_time(F.col("_k"), origin, every, kind).alias("tick"), "child", "start_ts", "room")
    )


def due_stays(stay: DataFrame, last: DataFrame, limit: str, room: str | None = None) -> DataFrame:
    """Stays longer than ``limit``, each once, with ``due_ts`` = start + limit; only ``room`` when given."""
    held = stay if room is None else stay.where(F.col("room") == room)
    held = held.withColumn("due_ts", F.col("start_ts") + F.expr(f"interval '{limit}'"))
    open_ = F.col("end_ts").isNull()
    return held.where((F.col("end_ts") > F.col("due_ts")) | (open_ & (F.col("due_ts") <= last.scalar())))


def phone_book(registrations: DataFrame) -> DataFrame:
    """(``child``, ``phone``), one row per child: the latest registration's number, if it has the shape of one.

    Without a ``ts`` column, or at equal times, the largest number counts as the latest.
    """
    order = F.struct(*[c for c in ("ts", "phone") if c in registrations.columns])
    latest = registrations.groupBy("child").agg(F.max(order).getField("phone").alias("phone"))
    return latest.where(phone_shaped(F.col("phone")))


def with_phone(alerts: DataFrame, registrations: DataFrame) -> DataFrame:
    """Adds the ``phone`` registered for the child, null when there is none."""
    return alerts.join(phone_book(registrations), "child", "left")


def missing_alerts(stay: DataFrame, last: DataFrame, registrations: DataFrame, limit: str = "900 seconds") -> DataFrame:
    """Children not seen for ``limit``: (``child``, ``due_ts``, ``start_ts``, ``room``, ``phone``)."""
    alerts = due_stays(stay, last, limit).select("child", "due_ts", "start_ts", "room")
    return with_phone(alerts, registrations)


def unsafe_alerts(stay: DataFrame, last: DataFrame, registrations: DataFrame, room: str = UNSAFE, limit: str = "300 seconds") -> DataFrame:
    """Children in ``room`` for ``limit``: (``child``, ``due_ts``, ``start_ts``, ``phone``)."""
    alerts = due_stays(stay, last, limit, room).select("child", "due_ts", "start_ts")
    return with_phone(alerts, registrations)


def repeated_alerts(events: DataFrame, stay: DataFrame, last: DataFrame, limit: str, bucket_micros: int, room: str | None = None) -> DataFrame:
    """The alert repeated at every event while it stands: (``now``, ``child``, ``start_ts``, ``room``).

    The result has one row per event and standing alert, so it grows with both.
    """
    spans = due_stays(stay, last, limit, room).withColumn(
        "until", F.coalesce(F.col("end_ts"), last.scalar() + F.expr("interval '1 microsecond'"))
    )
    now = events.select(F.col("ts").alias("now"))
    pairs = points_in_intervals(now, spans, "now", "due_ts", "until", bucket_micros)
    return pairs.select("now", "child", "start_ts", "room")


def repeat_counts(events: DataFrame, stay: DataFrame, last: DataFrame, limit: str, bucket_micros: int, room: str | None = None) -> DataFrame:
    """(``child``, ``start_ts``, ``room``, ``due_ts``, ``until``, ``n``): how often each due alert is repeated, without its repeats.

    The events from ``due_ts`` to before ``until`` are those before the one less those before the
    other. Events before a time are a running count inside its bucket plus the counts of
    earlier buckets, so every row takes part once and no event meets an alert.
    """
    spans = due_stays(stay, last, limit, room).withColumn(
        "until", F.coalesce(F.col("end_ts"), last.scalar() + F.expr("interval '1 microsecond'"))
    ).select("child", "start_ts", "room", "due_ts", "until")
    edges = spans.select(
        *spans.columns, F.inline(F.array(
            F.struct(F.col("due_ts").alias("t"), F.lit(-1).alias("sign")), F.struct(F.col("until").alias("t"), F.lit(1).alias("sign")))))
    marks = edges.withColumn("hit", F.lit(0)).unionByName(
        events.select(F.col("ts").alias("t"), F.lit(1).alias("hit")), allowMissingColumns=True)
    marks = marks.withColumn("bucket", F.floor(_micros(F.col("t")) / F.lit(bucket_micros)))
    inside = Window.partitionBy("bucket").orderBy("t", "hit").rowsBetween(Window.unboundedPreceding, 0)  # an edge comes before events of its time
    counts = marks.groupBy("bucket").agg(F.sum("hit").alias("m"))
    earlier = counts.select("bucket", (F.sum("m").over(Window.orderBy("bucket")) - F.col("m")).alias("earlier"))  # one row per bucket
    before = marks.withColumn("running", F.sum("hit").over(inside)).where("sign IS NOT NULL").join(earlier, "bucket")
    return before.groupBy("child", "start_ts", "room", "due_ts", "until").agg(F.sum(F.col("sign") * (F.col("running") + F.col("earlier"))).alias("n"))


def room_stats(stay: DataFrame, last: DataFrame, rooms: Sequence[str], origin: str, width: str) -> DataFrame:
    """(``bucket``, ``room``, ``n``): distinct children per room and time bucket, zeros kept.

    A child is in one place at a time, so the children present when a bucket opens are the
    running sum of arrivals minus departures. To those come the children who began a stay in
    the bucket and were not already there at its opening. Each stay therefore gives at most
    four small rows however many buckets it spans.
    """
    kind = _time_type(stay, "start_ts")
    inside = stay.where(F.col("room").isin(*rooms))
    end = F.col("end_ts")
    ends_in = F.greatest(F.ceil((_micros(end) - _micros(F.lit(origin))) / _span(width)) - 1, F.lit(0))
    cells = inside.select(
        "child", "room", _cell(F.col("start_ts"), origin, width).alias("b0"),
        F.when(end.isNull(), _cell(last.scalar(), origin, width)).otherwise(ends_in).alias("b1"),
        end.isNotNull().alias("closed"),
    )
    carried = F.col("b1") > F.col("b0")
    seen = cells.select("room", "child", F.inline(F.array_compact(F.array(
        F.struct(F.col("b0").alias("b"), F.lit(1).alias("fresh")),
        F.when(carried & F.col("closed"), F.struct(F.col("b1").alias("b"), F.lit(0).alias("fresh"))),
    ))))
    fresh = (
        seen.groupBy("room", "b", "child").agg(F.min("fresh").alias("fresh"))
        .groupBy("room", "b").agg(F.sum("fresh").alias("fresh"), F.lit(0).cast("bigint").alias("delta"))
    )
    deltas = (
        cells.where(carried)
        .select("room", F.inline(F.array(
            F.struct((F.col("b0") + 1).alias("b"), F.lit(1).alias("delta")),
            F.struct((F.col("b1") + 1).alias("b"), F.lit(-1).alias("delta")),
        )))
        .groupBy("room", "b").agg(F.lit(0).cast("bigint").alias("fresh"), F.sum("delta").alias("delta"))
    )
    grid = last.where(F.col("last_ts").isNotNull()).select(
        F.explode(F.array(*[F.lit(r) for r in rooms])).alias("room"), _cell(F.col("last_ts"), origin, width).alias("top")
    ).select("room", F.explode(F.sequence(F.lit(0).cast("bigint"), "top")).alias("b"),
             F.lit(0).cast("bigint").alias("fresh"), F.lit(0).cast("bigint").alias("delta"), F.lit(True).alias("shown"))
    off = F.lit(False).alias("shown")
    every = grid.unionByName(fresh.select("*", off)).unionByName(deltas.select("*", off))
    running = Window.partitionBy("room").orderBy("b")
    return (
        every.groupBy("room", "b").agg(F.sum("fresh").alias("fresh"), F.sum("delta").alias("delta"), F.max("shown").alias("shown"))
        .withColumn("n", F.col("fresh") + F.sum("delta").over(running))
        .where("shown")
        .select(_grid_time(F.col("b"), origin, width, kind).alias("bucket"), "room", "n")
    )


def child_stats(stay: DataFrame, last: DataFrame, origin: str, width: str) -> DataFrame:
    """(``bucket``, ``child``, ``n``): distinct rooms per child and time bucket, present children only."""
    kind = _time_type(stay, "start_ts")
    end = F.col("end_ts")
    ends_in = F.ceil((_micros(end) - _micros(F.lit(origin))) / _span(width)) - 1
    first = _cell(F.col("start_ts"), origin, width)
    upto = F.when(end.isNull(), _cell(last.scalar(), origin, width)).otherwise(ends_in)
    return (
        stay.select("child", "room", first.alias("b0"), upto.alias("b1"))
        .select("child", "room", F.explode(F.sequence("b0", F.greatest("b0", "b1"))).alias("b"))
        .groupBy("b", "child").agg(F.count_distinct("room").alias("n"))
        .select(_grid_time(F.col("b"), origin, width, kind).alias("bucket"), "child", "n")
    )


def as_report_lines(df: DataFrame, title: str, stamp: str, columns: Sequence[str]) -> DataFrame:
    """(``stamp``, ``line_no``, ``line``): comma-joined rows, and a title line per distinct ``stamp``.

    Title rows sort before their report's rows by (``stamp``, ``line_no``, ``line``).
    """
    body = df.select(F.col(stamp).alias("stamp"), F.lit(1).alias("line_no"),
                     F.concat_ws(", ", *[F.col(c).cast("string") for c in columns]).alias("line"))
    heads = df.select(F.col(stamp).alias("stamp")).distinct().select(
        "stamp", F.lit(0).alias("line_no"),
        F.concat(F.lit("========= "), F.col("stamp").cast("string"), F.lit(f" {title} =========")).alias("line"),
    )
    return heads.unionByName(body)
