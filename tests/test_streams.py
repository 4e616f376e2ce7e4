"""Stream results equal batch results on the same events."""

from __future__ import annotations

import functools
import os
import time

import pytest
from pyspark.sql import functions as F

from lathework import sinks, sources
from lathework.functions.values import tiered
from lathework.operators import presence
from lathework.registry import presence as batch_queries
from lathework.registry import streams
from lathework.streaming import lines as sl
from lathework.streaming import presence as sp
from test_presence import ORIGIN, at, frames, random_events

ORIGIN_US = 1709283600 * 1_000_000  # 2024-03-01 09:00 UTC


@pytest.fixture
def event_stream(spark, tmp_path):
    """A function from events to a stream of several files, oldest first."""
    def make(events, files=4):
        folder = tmp_path / "in"
        folder.mkdir()
        size = -(-len(events) // files)
        for i in range(0, len(events), size):
            part = spark.createDataFrame(events[i:i + size], "seq bigint, ts timestamp, child string, room string")
            part.coalesce(1).write.parquet(str(tmp_path / f"w{i}"))
            (written,) = (tmp_path / f"w{i}").glob("part-*.parquet")
            target = folder / f"{i:05d}.parquet"
            target.write_bytes(written.read_bytes())
            os.utime(target, (time.time() - 1000 + i, time.time() - 1000 + i))
        return spark.readStream.schema("seq bigint, ts timestamp, child string, room string").option("maxFilesPerTrigger", 1).parquet(str(folder))
    return make


def drained(stream, tmp_path, spark, processor=None, events=(), at_column="due_ts"):
    """What the stream wrote and, given its processor and all events, what it owed at its end."""
    query = sinks.stream_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    query.awaitTermination(300)
    written = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    if not processor:
        return written
    last = spark.createDataFrame([(max(e[1] for e in events),)], "t timestamp").select(F.unix_micros("t")).first()[0]
    return written.unionByName(sp.closing_rows(spark, str(tmp_path / "cp"), processor, last, at_column))


def due(stream, tmp_path, spark, events, limit="15 minutes", room=None, delay="0 seconds"):
    return drained(sp.due_stays(stream, limit, room, delay=delay), tmp_path, spark, sp.DueStays(sp.micros(limit), room), events)


@pytest.mark.parametrize("room", [None, "26"])
def test_due_stays(spark, rows, tmp_path, event_stream, room):
    events = random_events(11)
    _, stay, last = frames(spark, events)
    reg = spark.createDataFrame([(f"c{i}", f"239-000-000{i}") for i in range(6)], "child string, phone string")
    got = sp.with_phones(due(event_stream(events), tmp_path, spark, events, room=room), reg)
    expected = presence.with_phone(presence.due_stays(stay, last, "15 minutes", room), reg)
    columns = ["child", "room", "start_ts", "due_ts", "phone"]
    assert rows(got.select(columns)) == rows(expected.select(columns))


def test_location_log(spark, rows, tmp_path, event_stream):
    events = random_events(12, count=80)
    _, stay, last = frames(spark, events)
    processor = sp.Ticks(ORIGIN_US, sp.micros("5 minutes"))
    got = drained(sp.location_log(event_stream(events), ORIGIN_US, "5 minutes"), tmp_path, spark, processor, events, "tick")
    expected = presence.location_log(stay, last, ORIGIN, "5 minutes")
    columns = ["tick", "child", "room", "start_ts"]
    assert rows(got.select(columns)) == rows(expected.select(columns))


def test_occupancy(spark, rows, tmp_path, event_stream):
    events = random_events(13)
    _, stay, last = frames(spark, events)
    processor = sp.Buckets(ORIGIN_US, sp.micros("1 hour"))
    got = drained(sp.occupancy(event_stream(events), ORIGIN_US, "1 hour"), tmp_path, spark, processor, events, "bucket")
    kids = presence.child_stats(stay, last, ORIGIN, "1 hour")
    rooms = presence.room_stats(stay, last, ["0", "1", "2", "26", "27"], ORIGIN, "1 hour")
    assert rows(sp.rooms_per_child(got)) == rows(kids)
    assert rows(sp.children_per_room(got, ["0", "1", "2", "26", "27"])) == rows(rooms)


def test_rows_late_within_the_delay_take_their_place(spark, rows, tmp_path, event_stream):
    """Events dealt out of order over the files, by less than the delay."""
    events = random_events(17)
    mixed = sorted(events, key=lambda e: (e[1].timestamp() // 1800, e[0] * 7919 % 101))
    _, stay, last = frames(spark, events)
    got = due(event_stream(mixed, files=6), tmp_path, spark, events, delay="1 hour")
    columns = ["child", "room", "start_ts", "due_ts"]
    assert rows(got.select(columns)) == rows(presence.due_stays(stay, last, "15 minutes").select(columns))


@pytest.mark.parametrize("events,alerts", [
    ([(1, at(9), "k", "1"), (2, at(10), "k", "2"), (3, at(9, 30), "k", "26")], [(at(9, 15), "1"), (at(9, 45), "26")]),  # late, before the open stay
    ([(1, at(9), "k", "1"), (2, at(10), "k", "E"), (3, at(9, 50), "k", "2")], [(at(9, 15), "1")]),  # late, before an exit
    ([(1, at(9), "k", "1"), (2, at(9, 15), "m", "E")], [(at(9, 15), "1")]),  # due at the last event
])
def test_late_and_last_events(spark, tmp_path, event_stream, events, alerts):
    got = due(event_stream(events, files=len(events)), tmp_path, spark, events, delay="1 hour")
    assert sorted((r.due_ts, r.room) for r in got.collect()) == alerts


def test_nothing_is_reported_twice_after_a_restart(spark, rows, tmp_path, event_stream):
    events = random_events(19)
    _, stay, last = frames(spark, events)
    stream = event_stream(events)
    drained(sp.due_stays(stream, "15 minutes"), tmp_path, spark)
    got = due(stream, tmp_path, spark, events)
    columns = ["child", "room", "start_ts", "due_ts"]
    assert rows(got.select(columns)) == rows(presence.due_stays(stay, last, "15 minutes").select(columns))


@pytest.mark.parametrize("folder", [True, False])
def test_a_table_is_a_file_or_a_folder(spark, tmp_path, folder):
    spark.range(100).repartition(4).write.parquet(str(tmp_path / "t.parquet" if folder else tmp_path / "w"))
    if not folder:
        spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
        (part,) = (tmp_path / "one").glob("part-*.parquet")
        (tmp_path / "t.parquet").write_bytes(part.read_bytes())
    assert drained(sources.stream_table(spark, str(tmp_path), "t"), tmp_path, spark).count() == 100


def test_a_missing_table_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources.stream_table(spark, str(tmp_path), "none")


def test_two_sources_in_event_time_order(spark, rows, tmp_path):
    reg = [(at(9), "k", "239-663-0109"), (at(9, 1), "m", "23-9663-0109")]
    moves = [(at(9), "k", "1000", "26"), (at(9, 30), "k", "26", "1"), (at(10), "k", "1", "E"), (at(10, 30), "m", "1000", "2")]
    reg_schema, move_schema = "ts timestamp, child string, phone string", "ts timestamp, child string, from_room string, to_room string"
    spark.createDataFrame(reg, reg_schema).write.parquet(str(tmp_path / "reg"))
    spark.createDataFrame(moves, move_schema).write.parquet(str(tmp_path / "moves"))
    book = spark.read.parquet(str(tmp_path / "reg"))
    batch = presence.merged_events(book, spark.read.parquet(str(tmp_path / "moves")))
    stream = presence.merged_events(spark.readStream.schema(reg_schema).parquet(str(tmp_path / "reg")),
                                    spark.readStream.schema(move_schema).parquet(str(tmp_path / "moves")))
    events = [(0, r[0]) for r in reg] + [(0, m[0]) for m in moves]
    got = sp.with_phones(due(stream, tmp_path, spark, events), book)
    expected = presence.missing_alerts(presence.stays(batch, ["seq"]), presence.last_event(batch), book, "15 minutes")
    columns = ["child", "room", "start_ts", "due_ts", "phone"]
    assert rows(got.select(columns)) == rows(expected.select(columns)) != []
    assert {r.phone for r in got.collect() if r.child == "m"} == {None}


def test_discounts(spark, rows, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,first,last,amount\nt1,Ann,Lee,249.99\nt2,Bo,Ray,1000\n")
    stream = sources.stream_delimited(spark, str(tmp_path / "in"), sources.readers.PURCHASES, header=True)
    query = sinks.stream_to_lines(sl.discount_lines(stream), str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    query.awaitTermination(120)
    got = rows(spark.read.text(str(tmp_path / "out")))
    assert got == [("t1, AnnLee, 249.99, 0.0",), ("t2, BoRay, 1000.0, 50.0",)]
    batch = sources.delimited(spark, str(tmp_path / "in"), sources.readers.PURCHASES, header=True)
    assert rows(sl.discount_lines(batch)) == got
    assert batch.select(tiered(F.col("amount")).alias("d")).agg(F.sum("d")).first()[0] == 50.0


def test_numbers_and_tally(spark, rows, tmp_path):
    (tmp_path / "in").mkdir()
    for i, body in enumerate(["history one\nadventure history\n", "three\nhistory four\nfive\n"]):
        f = tmp_path / "in" / f"{i}.txt"
        f.write_text(body)
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    query = sl.number_stream(sources.stream_lines(spark, str(tmp_path / "in"), 1), str(tmp_path / "num"), str(tmp_path / "cp1"))
    query.awaitTermination(120)
    numbered = spark.read.parquet(str(tmp_path / "num")).select("num", "value")
    assert rows(numbered) == [(1, "history one"), (2, "adventure history"), (3, "three"), (4, "history four"), (5, "five")]
    tally = sl.running_tally(sources.stream_lines(spark, str(tmp_path / "in"), 1), ["history", "adventure"])
    writer = tally.writeStream.format("memory").queryName("tally").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp2"))
    writer.trigger(availableNow=True).start().awaitTermination(120)
    assert rows(sl.tally_lines(spark.table("tally"))) == [("adventure: 1",), ("history: 3",)]
    assert rows(sl.with_zeros(spark.table("tally"), ["history", "never", "never"])) == [("history", 3), ("never", 0)]


@pytest.mark.parametrize("name", ["missing_alert", "unsafe_alert", "location_log", "room_stats", "child_stats"])
def test_registered_queries_lose_no_row_of_files_out_of_order(spark, rows, tmp_path, monkeypatch, name):
    """One file a batch, the latest times first."""
    source = "/root/testdata/sf0.001"
    (tmp_path / "customer.parquet").symlink_to(f"{source}/customer.parquet")
    events = spark.read.parquet(f"{source}/events.parquet").orderBy("ts", "event_id").limit(300).cache()
    times = [r[0] for r in events.select("ts").orderBy(F.desc("ts")).collect()]
    bounds = [times[0], times[100], times[200]]
    parts = [events.where(F.col("ts") > bounds[1]), events.where((F.col("ts") <= bounds[1]) & (F.col("ts") > bounds[2])), events.where(F.col("ts") <= bounds[2])]
    (tmp_path / "events.parquet").mkdir()
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(str(tmp_path / f"w{i}"))
        (written,) = (tmp_path / f"w{i}").glob("part-*.parquet")
        target = tmp_path / "events.parquet" / f"{i}.parquet"
        target.write_bytes(written.read_bytes())
        os.utime(target, (time.time() - 1000 + i, time.time() - 1000 + i))
    monkeypatch.setattr(sources, "stream_table", functools.partial(sources.stream_table, bytes_per_batch=1))
    want = batch_queries.QUERIES[name](spark, str(tmp_path))
    got = streams.QUERIES[f"stream_{name}"](spark, str(tmp_path))
    assert rows(got.select(*want.columns)) == rows(want) and want.count()
