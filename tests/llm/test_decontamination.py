from __future__ import annotations

import random

import numpy as np

from lathework.llm import decontamination as d


def brute_tiles(item, run, seed=d.SEED):
    """Greedy string tiling by trying every pair of places."""
    a, b, covered = [False] * len(item), [False] * len(run), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(run)):
                n = 0
                while i + n < len(item) and j + n < len(run) and item[i + n] == run[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < seed:
            return covered
        a[i:i + n], b[j:j + n] = [True] * n, [True] * n
        covered += n


def test_tiles_against_brute_force():
    rng = random.Random(2)
    for _ in range(150):
        item = [rng.randrange(4) for _ in range(rng.randrange(0, 40))]
        run = [rng.randrange(4) for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.5 and len(item) > 12:
            run[10:10] = item[len(item) // 2:] + [9] + item[:len(item) // 2]
        mine = d.tile(np.array(item, dtype=np.uint64), [np.array(run, dtype=np.uint64)])
        for i, j, n in mine:
            assert item[i:i + n] == run[j:j + n] and n >= d.SEED
        places = [p for i, _, n in mine for p in range(i, i + n)]
        assert len(places) == len(set(places))
        assert abs(sum(n for _, _, n in mine) - brute_tiles(item, run)) <= d.SEED  # ties may be taken in another order


def words(start, n):
    return " ".join(f"b{i}" for i in range(start, start + n))


def test_reordered_partial_and_clean(spark):
    bench = spark.createDataFrame([(1, words(0, 40)), (2, words(100, 40)), (3, None), (4, "too short"), (None, words(0, 40))], "item_id bigint, text string")
    docs = spark.createDataFrame([
        (10, "before " + words(20, 20).upper() + ", middle. " + words(0, 20) + " after", "k"),  # reordered
        (11, words(100, 19), "k"),  # less than half
        (12, words(100, 20), "k"),  # half
        (13, "nothing of the kind " * 50, None),
        (14, None, None), (15, "", None), (12, words(100, 40), "k"), (None, words(0, 40), "k"),
    ], "doc_id bigint, text string, item_id string")
    found = {(r.doc_id, r.item_id): (r.covered_words, r.tiles) for r in d.contaminated(docs, bench).collect()}
    assert found == {(10, 1): (40, 2), (12, 2): (40, 1)}
    clean = d.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in clean.collect()) == [11, 13, 14, 15]  # the row without an id holds an item


def test_a_full_bitmap_loses_nothing(spark, monkeypatch):
    bench = spark.createDataFrame([(1, words(0, 40))], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, words(0, 40)), (2, words(50, 40))], "doc_id bigint, text string")
    monkeypatch.setattr(d, "seed_bitmap", lambda items: np.full(8, 255, dtype=np.uint8))
    assert [(r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect()] == [(1, 1)]


def test_odd_and_empty(spark, odd_documents, no_documents):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog")], "item_id bigint, text string")
    assert sorted(r.doc_id for r in d.contaminated(odd_documents, bench).collect()) == [1, 6]
    assert d.contaminated(no_documents, bench).count() == 0
    assert d.contaminated(odd_documents, bench.limit(0)).count() == 0
    assert d.clean_documents(odd_documents, bench.limit(0)).count() == 10


def test_driver_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect()}
    items = bench.collect()
    for r in docs.collect():
        for i in items:
            if i.text in r.text:
                assert (r.doc_id, i.item_id) in found


def test_short_items_and_scripts_without_blanks(spark):
    items = ["What is it?", "Who?", "今天天气怎么样", "日本の首都はどこですか", "เมืองหลวงของไทย", "!!", "one two three four five six"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    docs = spark.createDataFrame(
        [(10 + i, f"before, {t} after" if i < 2 else f"前{t}后") for i, t in enumerate(items)]
        + [(30, "what it is"), (31, "天今气天么怎样"), (32, "is it what"), (33, "one two three four"), (34, "")], "doc_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.covered_words, r.item_words) for r in d.contaminated(docs, bench).collect()}
    assert {k for k in found} == {(10 + i, i) for i in (0, 1, 2, 3, 4, 6)}
    assert all(c == n for c, n in found.values())
    assert found[12, 2] == (7, 7) and found[11, 1] == (1, 1)


def test_repetitive_items_and_repeated_runs(spark):
    passage = words(0, 12)
    items = ["ha " * 40, "one two three four five six seven " * 10, f"{passage} x {passage}", words(200, 30)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    docs = spark.createDataFrame([
        (10, items[0]), (11, "see: " + items[1]), (12, f"first {passage} then {passage} last"), (13, f"only {passage} once"), (13, "ha " * 4),
        (14, f"{words(200, 10)} z {words(200, 10)} z {words(200, 10)}")], "doc_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.covered_words, r.tiles) for r in d.contaminated(docs, bench, coverage=0.6).collect()}
    assert found == {(10, 0): (40, 1), (11, 1): (70, 1), (12, 2): (24, 2)}


def test_rows_without_or_with_a_shared_id_are_cleaned_by_their_text(spark):
    item = " ".join(f"w{i}" for i in range(30))
    rows = [(None, "before " + item), (None, "clean text of no item"), (1, item + " after"), (1, "another clean text"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    assert {tuple(r) for r in d.clean_documents(docs, items).collect()} == {rows[1], rows[3], rows[4]}


def test_a_phrase_of_all_items_brings_no_pairs(spark):
    """Documents that share only what every item holds meet no item; copies are found all the same."""
    phrase = " ".join(f"common{i}" for i in range(12))
    texts = [phrase + " " + " ".join(f"i{k}w{j}" for j in range(20)) for k in range(30)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    docs = spark.createDataFrame([(i, f"doc {i} says {phrase} and more {i}") for i in range(200)] + [(1000 + k, f"x {t} y") for k, t in enumerate(texts)], "doc_id bigint, text string")
    hashed = d.kept(d.hashed_items(items))
    hits = d.kept(d.hit_runs(docs, d.seed_bitmap(hashed)))
    of_docs = hits.selectExpr("doc_id", "explode(seeds) AS seed")
    met = of_docs.join(d.rarest_seeds(hashed, of_docs), "seed").select("doc_id", "item_id").distinct()
    assert met.count() == 30
    assert {(r.doc_id, r.item_id) for r in d.contaminated(docs, items).collect()} == {(1000 + k, k) for k in range(30)}
