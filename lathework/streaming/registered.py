"""Registrations and moves as two streams: alerts with the phone that is known when they are due.

Both sources keep a watermark of their own; Spark takes the lesser one (policy ``min``, its default), so
a source that lags holds back what both decide together. A child's rows of both wait in one state and
are applied in (time, seq) order. A registration leads into the entrance and renews the phone
in the state, so a later registration changes later alerts only.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lathework.functions.text import phone_shaped
from lathework.operators.presence import ENTRANCE, EXIT
from lathework.streaming.marks import real, with_marks
from lathework.streaming.presence import Timer, Waiting, keyed_rows, micros, use_state_store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ALERT = T.StructType([
    T.StructField("due_us", T.LongType()), T.StructField("child", T.StringType()), T.StructField("room", T.StringType()),
    T.StructField("start_us", T.LongType()), T.StructField("phone", T.StringType()),
])
STAY = T.StructType([T.StructField("room", T.StringType()), T.StructField("start_us", T.LongType()), T.StructField("open", T.BooleanType())])
PHONE = T.StructType([T.StructField("phone", T.StringType())])


class Alerts(StatefulProcessor):
    """One alert when a stay has lasted ``limit`` and goes on, with the child's phone; only ``room`` when given."""

    def __init__(self, limit_us: int, room: str | None = None, exit_room: str = EXIT):
        self.limit_us, self.room, self.exit_room = limit_us, room, exit_room

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stay = handle.getValueState("stay", STAY)
        self.phone = handle.getValueState("phone", PHONE)
        self.waiting = Waiting(handle)
        self.timer = Timer(handle)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.phone.update((initialState.phone,))

    def applied(self, stay: tuple | None, phone: str | None, rows: list[tuple], until: int) -> tuple[list[tuple], tuple | None, str | None]:
        """Alerts due before the next row or ``until``; a stay is (room, start, whether its alert is open)."""
        out = []
        for ts, _, room, number in [*sorted(rows, key=lambda r: r[:2]), (until, 0, None, None)]:
            if stay and stay[2] and stay[1] + self.limit_us < ts:
                out.append((stay[1] + self.limit_us, stay[0], stay[1], phone))
                stay = (stay[0], stay[1], False)
            if room is not None:
                phone = number or phone
                stay = None if room == self.exit_room else (room, ts, self.room in (None, room))
        return out, stay, phone

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.timer.earlier(self.waiting.add((us, seq, room, phone) for _, _, room, seq, phone, us in rows))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        ready, left = self.waiting.split(passed)
        out, stay, phone = self.applied(
            tuple(self.stay.get()) if self.stay.exists() else None, self.phone.get()[0] if self.phone.exists() else None, ready, passed)
        self.stay.update(stay) if stay else self.stay.clear()
        if phone is not None:
            self.phone.update((phone,))
        self.timer.at(min([r[0] for r in left] + ([stay[1] + self.limit_us] if stay and stay[2] else []), default=None))
        for due, room, start, number in out:
            yield Row(due_us=due, child=key[0], room=room, start_us=start, phone=number)

    def close(self) -> None:
        pass


def merged_streams(registrations: DataFrame, moves: DataFrame, marks: str, registered_delay: str, moved_delay: str, entrance: str = ENTRANCE) -> DataFrame:
    """(``ts``, ``child``, ``room``, ``seq``, ``phone``) of both streams, each behind its own watermark.

    ``registrations`` has (``ts``, ``child``, ``seq``, ``phone``), ``moves`` (``ts``, ``child``, ``room``, ``seq``); ``seq`` orders rows of
    one time over both. Numbers that do not have the shape of a phone number count as none.
    """
    entered = registrations.select("ts", "child", F.lit(entrance).alias("room"), "seq", F.when(phone_shaped(F.col("phone")), F.col("phone")).alias("phone"))
    moved = moves.select("ts", "child", "room", "seq", F.lit(None).cast("string").alias("phone"))
    return real(with_marks(entered, marks).withWatermark("ts", registered_delay)).unionByName(real(with_marks(moved, marks).withWatermark("ts", moved_delay)))


def registered_alerts(merged: DataFrame, limit: str, room: str | None = None, exit_room: str = EXIT, known: DataFrame | None = None) -> DataFrame:
    """(``due_ts``, ``child``, ``room``, ``start_ts``, ``phone``) from ``merged_streams``.

    ``known`` (``child``, ``phone``), a table of one row per child, is the state a new stream begins with.
    """
    use_state_store(merged.sparkSession)
    keyed = keyed_rows(merged, "phone").groupBy("child")
    begin = known.select(F.col("child").cast("string").alias("child"), "phone").groupBy("child") if known is not None else None
    alerts = keyed.transformWithState(
        statefulProcessor=Alerts(micros(limit), room, exit_room), outputStructType=ALERT, outputMode="Append", timeMode="EventTime", initialState=begin)
    return alerts.select(F.timestamp_micros("due_us").alias("due_ts"), "child", "room", F.timestamp_micros("start_us").alias("start_ts"), "phone")
