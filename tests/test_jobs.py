"""Batch jobs on small inputs with known answers."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lathework.functions import text as tx
from lathework.functions import values as vl
from lathework.operators import kmeans, netlog, ordering, posts, ranking, social, stocks, survey, text
from lathework.plans.medians import grouped_median
from lathework.plans.skew import heavy_keys, salted_join


def one(spark, **columns):
    """A Column evaluated on a single row."""
    (row,) = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).collect()
    return row


# -- text ------------------------------------------------------------------------------------

def test_words_and_empty_tokens(spark, rows):
    df = spark.createDataFrame([("  a b\ta",), ("",), ("b",)], "value string")
    assert rows(text.word_count(df)) == [("a", 2), ("b", 2)]
    assert rows(text.word_count(df, keep_empty=True)) == [("", 2), ("a", 2), ("b", 2)]


def test_bigrams_cross_sentence_ends_but_not_lines(spark, rows):
    df = spark.createDataFrame([("It's late. GO home!\ngo --- Home go home",), ("x",), ("",)], "value string")
    assert rows(text.bigram_count(df)) == [("go", "home", 3), ("home", "go", 1), ("its", "late", 1), ("late", "go", 1)]
    assert rows(text.top_bigram_by_initial(df)) == [("g", "go home", 3), ("h", "home go", 1), ("i", "its late", 1), ("l", "late go", 1)]


def test_ties_go_to_the_smaller_item(spark, rows):
    df = spark.createDataFrame([("g", "b", 2), ("g", "a", 2), ("g", "c", 1)], "g string, item string, n bigint")
    assert rows(text.top_by_group(df, "g", "item")) == [("g", "a", 2)]
    assert [r.item for r in text.ranked(df, "n", ["item"], k=2).collect()] == ["a", "b"]


def test_word_tally_keeps_zeros(spark, rows):
    df = spark.createDataFrame([("history of history",), ("History adventure",), (None,)], "value string")
    assert rows(text.word_tally(df, "value", ["adventure", "history", "none"])) == [("adventure", 1), ("history", 2), ("none", 0)]
    assert rows(text.word_tally(df.limit(0), "value", ["history"])) == [("history", 0)]


def test_string_helpers(spark):
    r = one(spark, a=tx.before_last(F.lit("10.0.0.7.443"), "."), b=tx.before_last(F.lit("host"), "."),
            c=tx.phone_shaped(F.lit("239-663-0109")), d=tx.phone_shaped(F.lit("2396-63-0109")), e=tx.phone_shaped(F.lit("")),
            f=tx.matches(F.lit("tcp"), "tcp"), g=tx.matches(F.lit("TCP"), "tcp"), h=tx.matches(F.lit("tcp6"), "tcp"),
            i=tx.field(F.lit("AK,x"), ",", 0), j=tx.field(F.lit("AK"), ",", 3))
    assert tuple(r) == ("10.0.0.7", None, True, False, False, True, False, False, "AK", None)


def test_value_helpers(spark):
    r = one(spark, a=vl.ratio(F.lit(4.0), F.lit(6.0)), b=vl.ratio(F.lit(0.0), F.lit(6.0)),
            c=vl.clock_seconds(F.lit("09:00:27.75")), d=vl.clock_millis(F.lit("2:37:50:214")),
            e=vl.day(F.lit(20131001)), f=vl.row_sum([]), g=vl.tick_label(F.lit("2024-03-01 09:05:00").cast("timestamp")),
            h=vl.clock_timestamp(F.lit("09:00:27.75"), "2024-03-01"))
    assert tuple(r) == (1.5, None, 32427.75, 9470214, dt.date(2013, 10, 1), 0.0, "09:05", dt.datetime(2024, 3, 1, 9, 0, 27, 750000))


@pytest.mark.parametrize("amount, discount", [(249.99, 0.0), (250.0, 2.5), (500.0, 10.0), (1000.0, 50.0)])
def test_discount_tiers(spark, amount, discount):
    assert one(spark, d=vl.tiered(F.lit(amount))).d == pytest.approx(discount)


# -- messages --------------------------------------------------------------------------------

MESSAGES = [
    '{"user": {"screen_name": "ann", "followers_count": 7}, "entities": {"hashtags": [{"text": "x"}, {"text": "x"}, {"text": "y"}]}}',
    '{"user": {"screen_name": "ann", "followers_count": 3}, "entities": {"hashtags": [{"text": "y"}]}}',
    '{"user": {"screen_name": "bob", "followers_count": -1}, "entities": {"hashtags": []}}',
    '{"user": {"screen_name": "cut", "followers_co',
]


def test_messages(spark, rows):
    df = social.parse_json(spark.createDataFrame([(m,) for m in MESSAGES], "raw string"), "raw")
    assert rows(social.tag_counts(df, social.hashtags())) == [("x", 1), ("y", 2)]
    assert rows(social.user_max(df, F.col("user.screen_name"), F.col("user.followers_count"))) == [("ann", 7), ("bob", 0)]
    assert rows(social.user_top_tag(df, F.col("user.screen_name"), social.hashtags())) == [("ann", 2, "y", 2), ("bob", 1, None, None)]


def test_malformed_messages_are_counted_and_tags_need_no_user(spark, rows):
    df = spark.createDataFrame([(m,) for m in [*MESSAGES, '{"entities": {"hashtags": [{"text": "y"}]}}']], "raw string")
    assert rows(social.json_counts(df, "raw")) == [(4, 1)]
    assert rows(social.tag_counts(social.parse_json(df, "raw"), social.hashtags())) == [("x", 1), ("y", 3)]
    assert social.parse_json(df, "raw", required="user").count() == 3


# -- logs ------------------------------------------------------------------------------------

def test_connection_log_and_ranking(spark, rows):
    trace = spark.createDataFrame([(1, "s1", "d1"), (2, "s1", "d2"), (3, "s2", "d1"), (3, "s2", "d1"), (9, "s3", "d1")], "conn_id bigint, src string, dst string")
    actions = spark.createDataFrame([(1, "Blocked"), (2, "Allowed"), (3, "Blocked"), (3, "Blocked"), (4, "blocked")], "conn_id bigint, action string")
    assert netlog.connection_log(trace, actions).count() == 6
    ranking_ = netlog.blocked_by_source(trace, actions, "conn_id", "src", "action").collect()
    assert [tuple(r) for r in ranking_] == [("s2", 4), ("s1", 1)]
    assert [tuple(r) for r in netlog.distinct_targets(trace, F.col("src"), F.col("dst"), k=2).collect()] == [("s1", 2), ("s2", 1)]


def test_group_totals_skip_unreadable(spark):
    df = spark.createDataFrame([("AK", "1.5"), ("AK", "2"), ("TX", "9"), ("TX", "n/a")], "k string, v string")
    assert [tuple(r) for r in netlog.group_totals(df, F.col("k"), F.col("v"), k=5).collect()] == [("TX", 9.0), ("AK", 3.5)]


# -- survey ----------------------------------------------------------------------------------

def test_column_groups():
    names = ["tucaseid", "t010101", "t180101", "t180501", "t180901", "t050101", "t170101", "telfs"]
    assert survey.group_columns(names) == {
        "primary_needs": ["t010101", "t180101"], "work": ["t180501", "t050101"], "other": ["t180901"]}


def test_profile(spark, rows):
    data = [("a", 1.0, 1.0, 22.0, 60.0, 30.0), ("b", 2.0, 1.0, 22.0, 120.0, 31.0), ("c", 3.0, 2.0, 23.0, 60.0, 0.0),
            ("d", 4.0, 2.0, 56.0, 6.0, 0.0), ("e", 5.0, 1.0, 15.0, 60.0, 0.0)]
    df = spark.createDataFrame(data, "tucaseid string, telfs double, tesex double, teage double, t0101 double, t0501 double")
    s = survey.summary(df, survey.group_columns(df.columns), F.col("telfs"), F.col("tesex"), F.col("teage"))
    expected = [("not working", "female", "active", 1.0, 0.0, 0.0), ("not working", "female", "elder", 0.1, 0.0, 0.0), ("working", "male", "young", 1.5, 0.5, 0.0)]
    assert rows(survey.profile(s)) == expected
    assert rows(survey.profile_sql(spark, s)) == expected


# -- rankings --------------------------------------------------------------------------------

ARTICLES = [
    (1, "Groovy is pretty interesting, and so is Erlang"), (2, "Scala and Java run on the JVM"),
    (3, "Scala is not purely functional"), (4, "The cool kids like Haskell more than Java"), (5, "Java is for enterprise developers"),
]


def test_mentions(spark, rows):
    df = spark.createDataFrame(ARTICLES, "id bigint, text string")
    terms = ["Scala", "Java", "Groovy", "Haskell", "Erlang", "Perl"]
    full = ranking.rank_terms(df, "text", terms).collect()
    assert full[0].term == "Java" and full[0].n == 3 and ("Perl", 0) in [tuple(r) for r in full]
    assert rows(ranking.mention_count(df, "text", "Java")) == [(3,)]
    index = ranking.inverted_index(df, "id", "text", terms, ids_per_block=3)
    assert ("Java", 0, [2]) in rows(index) and ("Java", 1, [4, 5]) in rows(index)
    assert [tuple(r) for r in ranking.rank_index(index).collect()] == [tuple(r) for r in full if r.n]


def test_group_leader(spark):
    df = spark.createDataFrame([("r1", "C", 5), ("r0", "C", 5), ("r2", "D", 9)], "repo string, lang string, stars int")
    assert [tuple(r) for r in ranking.group_leader(df, "lang", "repo", "stars").collect()] == [("C", 2, "r0", 5), ("D", 1, "r2", 9)]


# -- prices ----------------------------------------------------------------------------------

def test_trailing_average(spark, rows):
    data = [("a", 20131001 + i, float(i)) for i in range(25)] + [("b", 20131001, 5.0), ("b", 20131001, 7.0), ("b", 20131002, 1.0)]
    df = spark.createDataFrame(data, "ticker string, date int, open double")
    got = {(t, d): avg for t, d, _, avg in rows(stocks.trailing_average(df, "ticker", "date", "open", 20, 20131001, 20131024))}
    assert len(got) == 26 and got[("a", 20131001)] == 0.0 and got[("a", 20131003)] == 0.5
    assert got[("a", 20131024)] == pytest.approx(sum(range(3, 23)) / 20) and got[("b", 20131002)] == 7.0


def test_daily_rows_are_dealt_by_their_number(spark, rows):
    """As many tasks as the rows fill, and the window takes the tickers in as many."""
    data = [(f"t{i % 50}", 20131001 + i // 50, float(i * 7 % 13)) for i in range(1000)]
    df = spark.createDataFrame(data, "ticker string, date int, open double")
    dealt, tasks = stocks.dealt_daily(df, "ticker", "date", rows_per_task=40)
    assert tasks == 25 and dealt.rdd.getNumPartitions() == 25
    got = stocks.trailing_average(dealt, "ticker", "date", "open", 3, tasks=tasks)
    assert got.rdd.getNumPartitions() == 25 and rows(got) == rows(stocks.trailing_average(df, "ticker", "date", "open", 3))
    assert stocks.dealt_daily(df.limit(0), "ticker", "date")[1] == spark.sparkContext.defaultParallelism


def test_growth(spark, rows):
    data = [("a", 1, 2.0), ("a", 5, 4.0), ("a", 9, 6.0), ("b", 2, 1.0), ("c", 1, 0.0), ("c", 2, 3.0)]
    df = spark.createDataFrame(data, "ticker string, date int, open double")
    got = rows(stocks.growth(df, "ticker", "date", "open", [("early", 1, 5), ("late", 5, 9)]))
    assert got == [("early", "a", 2.0, 4.0, 2.0), ("early", "c", 0.0, 3.0, None), ("late", "a", 4.0, 6.0, 1.5)]


# -- ordering --------------------------------------------------------------------------------

@pytest.mark.parametrize("split_bytes", ["128m", "64"])
def test_numbers_follow_the_files_by_name(spark, tmp_path, split_bytes):
    """The scan takes large files first and may cut them; numbers follow names and lines."""
    want = []
    for name, n in (("a", 2), ("b", 50), ("c", 10)):
        body = [f"{name}{i}" for i in range(n)]
        (tmp_path / f"{name}.txt").write_text("\n".join(body) + "\n")
        want += body
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        numbered = ordering.number_lines(spark.read.text(str(tmp_path)).select("value"))
        assert [(r.num, r.value) for r in sorted(numbered.collect())] == list(enumerate(want, 1))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_numbers_without_files(spark):
    numbered = ordering.number_lines(spark.range(0, 100, 1, 7))
    assert [(r.num, r.id) for r in sorted(numbered.collect())] == [(i + 1, i) for i in range(100)]


def test_numbers_by_key(spark):
    df = spark.createDataFrame([(i * 7919 % 501,) for i in range(500)], "k bigint")
    assert all(r.num == i + 1 for i, r in enumerate(sorted(ordering.number_lines(df, ["k"]).collect(), key=lambda r: r.k)))


def test_range_sorted(spark):
    df = spark.createDataFrame([(random.Random(i).random(),) for i in range(400)], "x double")
    parts = ordering.range_sorted(df, ["x"], 4).withColumn("p", F.spark_partition_id()).collect()
    assert [r.x for r in parts] == sorted(r.x for r in parts) and len({r.p for r in parts}) == 4


# -- clustering ------------------------------------------------------------------------------

def test_post_scores(spark, rows):
    data = [(1, 1, None, 0, "Java"), (1, 2, None, 0, "PHP"), (1, 3, None, 0, "COBOL"), (1, 4, None, 0, "Java"),
            (2, 10, 1, 5, None), (2, 11, 1, 8, None), (2, 12, 2, -3, None), (2, 13, 3, 1, None)]
    df = spark.createDataFrame(data, "post_type int, id bigint, parent_id bigint, score int, tag string")
    scored = posts.best_answers(df)
    assert rows(scored) == [(1, "Java", 8), (2, "PHP", 0), (3, "COBOL", 1)]
    assert rows(posts.score_points(scored)) == [(1, 50000, 8), (2, 100000, 0)]
    with pytest.raises(Exception, match="tag is not in the list"):
        posts.score_points(scored, strict=True).collect()


def lloyd(points, centres, eta, rounds):
    taken = 0
    while taken < rounds:
        taken += 1
        groups = {}
        for p in points:
            i = min(range(len(centres)), key=lambda j: ((p[0] - centres[j][0]) ** 2 + (p[1] - centres[j][1]) ** 2, j))
            groups.setdefault(i, []).append(p)
        moved = [(sum(p[0] for p in groups[i]) // len(groups[i]), sum(p[1] for p in groups[i]) // len(groups[i])) if i in groups else c
                 for i, c in enumerate(centres)]
        shift = sum((a - c) ** 2 + (b - d) ** 2 for (a, b), (c, d) in zip(centres, moved))
        centres = moved
        if shift < eta:
            break
    return centres, taken, groups


def test_kmeans_equals_plain_lloyd(spark):
    rnd = random.Random(3)
    points = [(rnd.choice([0, 50000]), rnd.randrange(300)) for _ in range(200)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id bigint, x bigint, y bigint")
    start = kmeans.starting_centres(kmeans.seeds(df, 6, 2, 50000), 6)
    assert sorted(x for x, _ in start) == [0, 0, 0, 50000, 50000, 50000] and set(start) <= set(points)
    start.append((900000, 5))  # never closest: keeps its place
    hist = kmeans.histogram(df)
    centres, taken = kmeans.fit(hist, start, eta=20.0, max_iterations=50)
    expected, rounds, groups = lloyd(points, start, 20.0, 50)
    assert (centres, taken) == (expected, rounds) and centres[-1] == (900000, 5)
    report = kmeans.cluster_report(hist, centres, 50000, ["A", "B"]).collect()
    _, _, groups = lloyd(points, centres, 0.0, 1)
    assert {r.idx: r.size for r in report} == {i: len(g) for i, g in groups.items()}
    for r in report:
        ys = sorted(y for _, y in groups[r.idx])
        k = len(ys)
        assert r.median == (ys[(k - 1) // 2] + ys[k // 2]) // 2
    assert [r.median for r in report] == sorted(r.median for r in report)


def test_narrow_spread_samples_all_points(spark):
    df = spark.createDataFrame([(i, i % 3, i) for i in range(50)], "id bigint, x bigint, y bigint")
    drawn = kmeans.seeds(df, 5, 3, 1).collect()
    assert len(drawn) == 5 and [tuple(r) for r in drawn] == [tuple(r) for r in kmeans.seeds(df, 5, 3, 1).collect()]
    with pytest.raises(ValueError):
        kmeans.starting_centres(kmeans.seeds(df, 90, 3, 50000), 90)


# -- plan shapes -----------------------------------------------------------------------------

def test_grouped_median_over_wide_values(spark):
    rnd = random.Random(9)
    data = [(g, rnd.choice([rnd.randrange(0, 50), rnd.randrange(0, 2**31 - 1)])) for g in range(5) for _ in range(1 + 37 * g)]
    hist = spark.createDataFrame(data, "g int, v bigint").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {r.g: r.median for r in grouped_median(hist, "g", "v", "n").collect()}
    for g in range(5):
        ys = sorted(v for k, v in data if k == g)
        assert got[g] == (ys[(len(ys) - 1) // 2] + ys[len(ys) // 2]) // 2


def test_no_heavy_key_is_left_out(spark):
    many = spark.range(90_000).select((F.col("id") % 30_000).alias("k"))
    assert heavy_keys(many, ["k"], rows_per_task=2).count() == 30_000


def test_salted_join_equals_plain_join(spark, rows):
    many = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(300)], "k bigint, v bigint")
    one_ = spark.createDataFrame([(i, f"n{i}") for i in range(0, 300, 2)], "k bigint, name string")
    heavy = heavy_keys(many, ["k"], rows_per_task=20)
    assert [(r.k, r._fan) for r in heavy.collect()] == [(0, 11)]
    for how in ("inner", "left"):
        assert rows(salted_join(many, one_, ["k"], heavy, how).select("k", "v", "name")) == rows(many.join(one_, "k", how).select("k", "v", "name"))
