from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lathework import sinks, sources
from lathework.operators import social
from lathework.sources import readers
from lathework.streaming import lines as sl


def put(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_lines_of_several_paths(spark, rows, tmp_path):
    a, b = put(tmp_path / "a", "x\ny\n"), put(tmp_path / "b", "z")
    assert rows(sources.lines(spark, [a, b])) == [("x",), ("y",), ("z",)]


def test_trace_actions_edges(spark, rows, tmp_path):
    t = put(tmp_path / "t", "2:37:50:214 9470213 158.170.204.133 > 254.32.197.234 TCP 586\nbroken line\n")
    (first, second) = sources.trace(spark, t).orderBy(F.col("conn_id").desc_nulls_last()).collect()
    assert first.conn_id == 9470213 and first.dst_ip == "254.32.197.234" and first.protocol == "TCP" and second.conn_id is None
    assert rows(sources.actions(spark, put(tmp_path / "c", "7 Blocked\n8 Allowed"))) == [(7, "Blocked"), (8, "Allowed")]
    assert rows(sources.edges(spark, put(tmp_path / "e", "1 2\n3\t 4\n\n x y\n"))) == [(1, 2), (3, 4)]


def test_delimited_and_header(spark, rows, tmp_path):
    p = put(tmp_path / "p.csv", "a,20131001,1.5,9,9\nb,20131002,,\n")
    assert rows(sources.delimited(spark, p, readers.PRICES)) == [("a", 20131001, 1.5), ("b", 20131002, None)]
    h = put(tmp_path / "h.txt", "USPS AREA\nAK 5\nTX 7\n")
    assert rows(sources.delimited(spark, h, "usps string, area double", " ", header=True)) == [("AK", 5.0), ("TX", 7.0)]
    names, df = sources.header_typed(spark, put(tmp_path / "s.csv", "id,t01,t05\n\"1\",1,2.5\n"))
    assert names == ["id", "t01", "t05"] and rows(df) == [('"1"', 1.0, 2.5)]


def test_posts_with_missing_fields(spark, rows, tmp_path):
    p = put(tmp_path / "posts", "1,27233496,,,0,C#\n2,5484340,,5494879,1\n1,5,9,,3,\n")
    assert rows(sources.posts(spark, p)) == sorted([
        (1, 27233496, None, None, 0, "C#"), (2, 5484340, None, 5494879, 1, None), (1, 5, 9, None, 3, None)], key=repr)


def test_articles(spark, rows, tmp_path):
    tail = "x" * readers.TEXT_END_LENGTH
    lines = ["y" * readers.TITLE_START + "T1</title><text>some text" + tail, "no article here"]
    assert rows(sources.articles(spark, put(tmp_path / "w", "\n".join(lines)))) == [("T1", "some text")]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_pretty_printed_json(spark, rows, tmp_path, newline):
    body = """[
{
  "user": {"screen_name": "ann", "followers_count": 7},
  "entities": {
    "hashtags": [{"text": "x"}]
  }
},
{
  "user": {"screen_name": "bob", "followers_count": 2},
  "entities": {"hashtags": []}
},
{
  "user": {"screen_name": "cut",
"""
    df = sources.json_records(spark, put(tmp_path / "j", body.replace("\n", newline)))
    parsed = social.parse_json(df, "raw")
    assert rows(parsed.select("user.screen_name", "user.followers_count", F.size("entities.hashtags"))) == [("ann", 7, 1), ("bob", 2, 0)]


def test_delimited_sink_and_overwrite(spark, rows, tmp_path):
    df, out = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"), str(tmp_path / "o")
    sinks.write_delimited(df, out, single_file=True)
    assert sorted(open(next((tmp_path / "o").glob("part-*"))).read().split("\n")[:2]) == ["a\t1", "b\t2"]
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_delimited(df, out)
    sinks.write_delimited(df.where("n = 1"), out, overwrite=True)
    assert rows(spark.read.csv(out, sep="\t")) == [("a", "1")]


def test_line_sink_and_split(spark, rows, tmp_path):
    df = spark.range(10)
    sinks.write_lines(df.select(F.col("id").cast("string")), str(tmp_path / "l"))
    assert spark.read.text(str(tmp_path / "l")).count() == 10
    even = F.col("id") % 2 == 0
    sinks.write_split(df, [(even, str(tmp_path / "e")), (~even, str(tmp_path / "odd"))])
    assert spark.read.parquet(str(tmp_path / "e")).count() == 5 and spark.read.parquet(str(tmp_path / "odd")).count() == 5


def test_scratch_is_dropped(spark):
    from lathework import session
    kept, session._scratch[:] = list(session._scratch), []
    try:
        folder = session.scratch_folder(spark)
        spark.range(3).write.parquet(folder)
        assert spark.read.parquet(folder).count() == 3
        session.drop_scratch(spark)
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(folder)
    finally:
        session._scratch[:] = kept


def test_a_repeated_batch_leaves_the_same_outputs(spark, rows, tmp_path):
    """Two outputs of one pass; the second batch is lost after its outputs were written and is run again."""
    (tmp_path / "in").mkdir()
    for i in range(3):
        spark.range(10 * i, 10 * i + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    even = F.col("id") % 2 == 0
    start = lambda: sinks.stream_split(stream, [(even, str(tmp_path / "even")), (~even, str(tmp_path / "odd"))], str(tmp_path / "all"), str(tmp_path / "cp"), True).awaitTermination()
    start()
    read = lambda name: rows(spark.read.parquet(str(tmp_path / name)).select("id"))
    want = ([(i,) for i in range(0, 30, 2)], [(i,) for i in range(1, 30, 2)])
    assert (sorted(read("even")), sorted(read("odd"))) == want
    for f in (tmp_path / "cp" / "commits").iterdir():
        if f.name.lstrip(".").startswith("2"):
            f.unlink()
    start()
    assert (sorted(read("even")), sorted(read("odd"))) == want


def test_numbers_and_tally_of_one_pass(spark, rows, tmp_path):
    (tmp_path / "in").mkdir()
    for i, body in enumerate(["history one\nadventure history\n", "three\nhistory four\nfive\n"]):
        f = tmp_path / "in" / f"{i}.txt"
        f.write_text(body)
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    out = str(tmp_path / "num")
    run = lambda: sl.number_stream(sources.stream_lines(spark, str(tmp_path / "in"), 1), out, str(tmp_path / "cp"), tallied=["history", "adventure"]).awaitTermination(120)
    run()
    check = lambda: (rows(sl.latest_tally(spark, out)), sorted(r.num for r in spark.read.parquet(out).collect()))
    want = ([("adventure", 1), ("history", 3)], [1, 2, 3, 4, 5])
    assert check() == want
    for f in (tmp_path / "cp" / "commits").iterdir():
        if f.name.lstrip(".").startswith("1"):
            f.unlink()
    run()
    assert check() == want


def test_dropped_records_are_counted_by_the_job_that_drops_them(spark, rows, tmp_path):
    from pyspark.sql import Observation

    from lathework.operators import posts, social

    raw = spark.createDataFrame([('{"user": {"screen_name": "a"}}',), ("{broken",), ("{",), ('{"user": null}',)], "raw string")
    counted = Observation()
    assert social.parse_json(raw, "raw", counted=counted).count() == 2 and counted.get == {"kept": 2, "rejected": 2}
    scored = spark.createDataFrame([(1, "Java", 5), (2, "none", 6), (3, None, 7)], "id bigint, tag string, score int")
    counted = Observation()
    assert posts.score_points(scored, counted=counted).count() == 1 and counted.get == {"kept": 1, "dropped": 2}
    raw.write.parquet(str(tmp_path / "raw"))
    stream = social.parse_json(spark.readStream.schema("raw string").parquet(str(tmp_path / "raw")), "raw", counted="json")
    query = sinks.stream_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    query.awaitTermination(120)
    seen = [p["observedMetrics"]["json"] for p in query.recentProgress if p.get("observedMetrics", {}).get("json")]
    assert sum(s["kept"] for s in seen) == 2 and sum(s["rejected"] for s in seen) == 2
