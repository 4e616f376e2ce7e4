"""Interval forms against a plain replay of the events."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lathework.operators import presence
from lathework.plans.intervals import points_in_intervals

DAY = datetime(2024, 3, 1)
ORIGIN = "2024-03-01 09:00:00"
ROOMS = ["0", "1", "2", "26", "1000"]


def at(h, m=0, s=0.0):
    return DAY + timedelta(hours=h, minutes=m, seconds=s)


def random_events(seed, children=6, count=120):
    rnd = random.Random(seed)
    out, used = [], set()
    while len(out) < count:
        t = at(8, 50) + timedelta(seconds=rnd.choice([rnd.randrange(0, 4 * 3600), 60 * 5 * rnd.randrange(0, 48)]))
        child = f"c{rnd.randrange(children)}" if rnd.random() > 0.4 else "c0"  # c0 is the crowded one
        if (t, child) in used:
            continue
        used.add((t, child))
        out.append((len(out), t, child, rnd.choice(["0", "1", "2", "26", "26", "E"])))
    return sorted(out, key=lambda e: (e[1], e[0]))


def frames(spark, events, rows_per_task=2_000_000):
    df = spark.createDataFrame(events, "event_id bigint, ts timestamp, child string, room string")
    return df, presence.stays(df, ["event_id"], slice_width="10 minutes", rows_per_task=rows_per_task), presence.last_event(df)


def replay_stays(events):
    open_, out = {}, []
    for _, t, child, room in events:
        if child in open_:
            r, start = open_.pop(child)
            out.append((child, r, start, t))
        if room != "E":
            open_[child] = (room, t)
    return out + [(c, r, s, None) for c, (r, s) in open_.items()]


def replay_ticks(events, every=timedelta(minutes=5)):
    tick, seen, out = at(9), {}, []
    report = lambda: out.extend((tick, c, t, r) for c, (t, r) in seen.items() if r != "E")
    for _, t, child, room in events:
        while t >= tick:
            report()
            tick += every
        seen[child] = (t, room)
    report()
    return out


def replay_buckets(events, width=timedelta(hours=1)):
    rooms, kids, where, start = {}, {}, {}, at(9)
    room_rows, child_rows = [], []
    moving = {}
    for _, t, child, _ in events:
        moving.setdefault(t, set()).add(child)

    def close():
        nonlocal rooms, kids, start
        room_rows.extend((start, r, len(rooms.get(r, ()))) for r in ROOMS)
        child_rows.extend((start, c, len(v)) for c, v in kids.items())
        start += width
        stay = {c: r for c, r in where.items() if c not in moving.get(start, ())}
        rooms, kids = {}, {}
        for c, r in stay.items():
            rooms.setdefault(r, set()).add(c)
            kids.setdefault(c, set()).add(r)
    for _, t, child, room in events:
        while t >= start + width:
            close()
        if room == "E":
            where.pop(child, None)
        else:
            rooms.setdefault(room, set()).add(child)
            kids.setdefault(child, set()).add(room)
            where[child] = room
    close()
    return room_rows, child_rows


def replay_alerts(events, limit, room=None):
    held, out = {}, set()
    last_of = {t: i for i, (_, t, _, _) in enumerate(events)}
    for i, (_, t, child, r) in enumerate(events):
        held.pop(child, None)
        if r != "E" and (room is None or r == room):
            held[child] = (t, r)
        if last_of[t] != i:
            continue  # what happens at one instant is applied before anyone is alerted
        out |= {(t, c, s, rr) for c, (s, rr) in held.items() if t - s >= limit}
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rows_per_task", [2_000_000, 5])
def test_stays(spark, rows, seed, rows_per_task):
    events = random_events(seed)
    _, stay, _ = frames(spark, events, rows_per_task)
    assert rows(stay) == sorted(replay_stays(events), key=repr)


@pytest.mark.parametrize("rows_per_task", [2_000_000, 3])
def test_copies_and_equal_times(spark, rows, rows_per_task):
    events = [(i, at(9, i // 4), "c0", str(i % 3)) for i in range(24)] + [(99, at(11), "c1", "1")]
    _, stay, _ = frames(spark, events + events[:9] + events[3:4] * 5, rows_per_task)
    assert rows(stay) == sorted(replay_stays(events), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_location_log(spark, rows, seed):
    events = random_events(seed)
    _, stay, last = frames(spark, events)
    got = rows(presence.location_log(stay, last, ORIGIN, "5 minutes"))
    assert got == sorted(replay_ticks(events), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_room_and_child_stats(spark, rows, seed):
    events = random_events(seed)
    _, stay, last = frames(spark, events)
    by_room, by_child = replay_buckets(events)
    assert rows(presence.room_stats(stay, last, ROOMS, ORIGIN, "1 hour")) == sorted(by_room, key=repr)
    assert rows(presence.child_stats(stay, last, ORIGIN, "1 hour")) == sorted(by_child, key=repr)
    total = {}
    for stamp, _, n in by_room:
        total[stamp] = total.get(stamp, 0) + n
    for stamp, _, n in by_child:
        total[stamp] -= n
    assert set(total.values()) == {0}


@pytest.mark.parametrize("room", [None, "26"])
def test_alerts_once_and_repeated(spark, rows, room):
    events = random_events(5)
    df, stay, last = frames(spark, events)
    limit = timedelta(minutes=15)
    expected = replay_alerts(events, limit, room)
    got = set(rows(presence.repeated_alerts(df, stay, last, "15 minutes", 600_000_000, room)))
    assert got == expected
    once = presence.due_stays(stay, last, "15 minutes", room)
    stays = {(r.child, r.start_ts) for r in once.collect()}
    assert {(c, s) for _, c, s, _ in expected} <= stays
    assert all(r.due_ts == r.start_ts + limit for r in once.collect())


def test_a_move_on_the_hour_is_not_carried_over(spark, rows):
    events = [(0, at(9, 10), "k", "1"), (1, at(10), "k", "2"), (2, at(10, 30), "k", "E")]
    _, stay, last = frames(spark, events)
    got = sorted(rows(presence.child_stats(stay, last, ORIGIN, "1 hour")))
    assert got == [(at(9), "k", 1), (at(10), "k", 1)]


def test_phone_and_merge(spark, rows):
    reg = spark.createDataFrame([(at(9), "k", "239-663-0109")], "ts timestamp, child string, phone string")
    moves = spark.createDataFrame([(at(9), "k", "1000", "26"), (at(9, 30), "k", "26", "E")],
                                  "ts timestamp, child string, from_room string, to_room string")
    events = presence.merged_events(reg, moves)
    stay = presence.stays(events, ["seq"])
    assert rows(stay) == sorted([("k", "26", at(9), at(9)), ("k", "1000", at(9), at(9, 30))], key=repr)
    last = presence.last_event(events)
    got = rows(presence.missing_alerts(stay, last, reg))
    assert got == [("k", at(9, 15), at(9), "1000", "239-663-0109")]
    assert rows(presence.unsafe_alerts(stay, last, reg)) == []


def test_interval_join_has_no_nested_loop(spark):
    events = random_events(7)
    df, stay, last = frames(spark, events)
    spans = stay.where("end_ts is not null")
    joined = points_in_intervals(df.select("ts"), spans, "ts", "start_ts", "end_ts", 600_000_000)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def crowded(spark, points, intervals):
    """Points and intervals of one day, most of which contain most points."""
    rnd = random.Random(11)
    known = spark.createDataFrame([(at(9, s=rnd.randrange(36_000_000) / 1000), n) for n in range(points)] + [(None, -1)], "ts timestamp, n int")
    spans = [(i, at(8, s=rnd.randrange(7_200)), at(17, s=rnd.randrange(7_200))) for i in range(intervals)] + [(-1, None, at(9)), (-2, at(10), at(10))]
    return known, spark.createDataFrame(spans, "id int, low timestamp, high timestamp")


@pytest.mark.parametrize("width", ["1 day", "30 minutes"])
@pytest.mark.parametrize("block, share", [(1, 1), (8, 5), (256, 8192)])
def test_interval_join_by_blocks_and_shares(spark, rows, width, block, share):
    known, spans = crowded(spark, 90, 130)
    known = known.unionByName(known.where("n < 20"))
    micros = {"1 day": 86_400_000_000, "30 minutes": 1_800_000_000}[width]
    got = points_in_intervals(known, spans, "ts", "low", "high", micros, block, share)
    assert got.columns == ["ts", "n", "id", "low", "high"]
    assert rows(got) == rows(known.join(spans, (known.ts >= spans.low) & (known.ts < spans.high)))


def test_interval_join_of_one_bucket_takes_many_tasks_and_few_bytes(spark, tmp_path):
    known, spans = crowded(spark, 1500, 1000)
    joined = points_in_intervals(known.select("ts"), spans, "ts", "low", "high", 86_400_000_000, share=100)
    joined.withColumn("task", F.spark_partition_id()).write.parquet(str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    pairs = back.count()
    tasks = [r["count"] for r in back.groupBy("task").count().collect()]
    assert pairs > 1_000_000 and len(tasks) >= 5 and max(tasks) < pairs / 2
    assert sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < 0.5 * pairs


def test_report_lines(spark):
    df = spark.createDataFrame([("09:05", "a", "1"), ("09:05", "b", "2"), ("09:10", "a", "3")], "tick string, child string, room string")
    lines = [r.line for r in presence.as_report_lines(df, "Child Location Report", "tick", ["child", "room"]).orderBy("stamp", "line_no", "line").collect()]
    assert lines[0] == "========= 09:05 Child Location Report ========="
    assert lines[1:3] == ["a, 1", "b, 2"] and len(lines) == 5


def test_the_latest_registration_gives_the_phone(spark, rows):
    reg = spark.createDataFrame([
        (at(9), "k", "239-663-0109"), (at(10), "k", "239-663-0110"), (at(9), "m", "239-663-0111"), (at(10), "m", "bad")], "ts timestamp, child string, phone string")
    assert rows(presence.phone_book(reg)) == [("k", "239-663-0110")]
    assert rows(presence.phone_book(reg.drop("ts"))) == [("k", "239-663-0110")]
