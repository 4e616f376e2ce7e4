from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lathework.llm import exact_dedup as d

SCHEMA = "doc_id bigint, text string"


def sha(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()


def expected(rows):
    """(keep_id, group_size) by digest."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(sha(text), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return {h: (min(g)[3], len(g)) for h, g in groups.items()}


def check(result, rows):
    out, want = result.collect(), expected(rows)
    assert sorted(map(str, (r.doc_id for r in out))) == sorted(str(i) for i, _ in rows)
    assert {r.text_sha256: (r.keep_id, r.group_size) for r in out} == want
    assert sum(r.kept for r in out) == len(want)
    assert all(r.doc_id == r.keep_id for r in out if r.kept)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 40, 700])
def test_places_are_taken_once(size):
    random = np.random.default_rng(size)
    h1, h2 = random.integers(0, 2**64, (2, size), dtype=np.uint64)
    shift, seeds = d.displacements(h1, h2)
    a, b = ((h >> np.uint64(shift)).astype(object) % size for h in (h1, h2))
    s = seeds[((h1 >> np.uint64(40)) % np.uint64(len(seeds))).astype(int)].astype(object)
    assert sorted((a + s // size * b + s % size) % size) == list(range(size))


def test_equal_hashes_are_refused():
    with pytest.raises(ValueError):
        d.displacements(np.array([7, 7], dtype=np.uint64), np.array([9, 9], dtype=np.uint64))


@pytest.mark.parametrize("bucket", [1, 7, 10_000])
def test_slots_run_without_a_gap(spark, bucket):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 331).cast("string")).alias("text"))
    index = d.build_index(d.digested(docs), bucket)
    slots = index.slots.collect()
    assert sorted(r.slot for r in slots) == list(range(331)) and {bytes(r.digest) for r in slots} == {bytes.fromhex(sha(f"text {i}")) for i in range(331)}
    keys = d.winners(d.digested(docs.union(spark.createDataFrame([(1000 + i, f"unknown {i}") for i in range(300)], SCHEMA))))
    found = {bytes(r.digest): r.slot for r in d.looked_up(keys, index).collect()}
    assert {k: v for k, v in found.items() if v is not None} == {bytes(r.digest): r.slot for r in slots} and len(found) == 631


@pytest.mark.parametrize("historical", ["false", "true", "doc_id < 50", "doc_id % 3 = 0"])
def test_groups_within_and_across_history(spark, historical):
    rows = [(i, " ".join("word" if i % 5 else f"word{i % 10}" for _ in range(3)) + " " * (i % 4)) for i in range(100)]
    check(d.deduplicated(spark.createDataFrame(rows, SCHEMA).repartition(5), F.expr(historical), 4), rows)


def test_twenty_thousand_equal_rows(spark):
    docs = spark.range(20_000).select(F.when(F.col("id") < 10, 5).otherwise(F.col("id")).alias("doc_id"), F.lit("the same\ttext").alias("text"))
    out = d.deduplicated(docs, F.col("doc_id") % 2 == 0)
    assert out.where("kept").count() == 1 and [tuple(r) for r in out.select("keep_id", "group_size").distinct().collect()] == [(5, 20_000)]


def test_odd_documents(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    for historical in (F.lit(None).cast("boolean"), F.col("doc_id") > 4):
        check(d.deduplicated(odd_documents, historical), rows)
        assert d.deduplicated(no_documents, historical).count() == 0


def test_unseen_against_a_saved_index(spark, odd_documents, tmp_path):
    history = odd_documents.where("doc_id IN (1, 2)")
    d.build_index(d.digested(history)).save(str(tmp_path))
    left = d.unseen(odd_documents, d.DigestIndex.load(spark, str(tmp_path)))
    assert left.columns == odd_documents.columns
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == ["5", "7", "8", "None"]
    empty = d.build_index(d.digested(odd_documents.limit(0)))
    assert d.unseen(odd_documents, empty).count() == 6 and d.unseen(odd_documents.limit(0), empty).count() == 0
