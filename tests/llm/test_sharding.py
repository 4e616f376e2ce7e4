from __future__ import annotations

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lathework.llm import sharding as s


@pytest.mark.parametrize("n,bits", [(2, 3), (3, 2), (3, 3)])
def test_curve_visits_neighbours_and_every_cell(spark, n, bits):
    cells = spark.range(1 << (n * bits)).select(*[(F.shiftright("id", i * bits) % (1 << bits)).alias(f"a{i}") for i in range(n)])
    rows = sorted(tuple(r) for r in cells.select(s.hilbert_index([F.col(f"a{i}") for i in range(n)], bits).alias("h"), "*").collect())
    assert [r[0] for r in rows] == list(range(1 << (n * bits)))
    assert all(sum(abs(a - b) for a, b in zip(x[1:], y[1:])) == 1 for x, y in zip(rows, rows[1:]))


def even(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    sizes = [len(slots.get(i, [])) for i in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("slice_rows", [1, 7, 100_000])
def test_runs_follow_the_curve(spark, slice_rows):
    """One cell with a third of the rows, in many slices."""
    rows = spark.range(301).select(F.col("id"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).cast("bigint").alias("c")).repartition(5)
    out = s.sharded(rows, "c", ["id"], 8, slice_rows).collect()
    even(out, 8)
    in_order = sorted(out, key=lambda r: (r.shard, r.slot))
    assert [r.c for r in in_order] == sorted(r.c for r in out)


@pytest.mark.parametrize("count", [0, 1, 5, 8, 9])
def test_few_rows(spark, count):
    even(s.sharded(spark.range(count).withColumn("c", F.lit(1)), "c", ["id"]).collect(), 8)


def test_odd_documents(odd_documents, no_documents):
    rows = s.document_shards(odd_documents).collect()
    even(rows, 8)
    texts = {r.doc_id: r.text for r in odd_documents.collect()}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    assert s.document_shards(no_documents).count() == 0


def test_files_can_be_pruned(spark):
    """Every shard holds a part of the metadata only."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    spread = s.document_shards(docs).join(docs, "doc_id").groupBy("shard").agg(F.countDistinct("source").alias("n")).collect()
    every = docs.select("source").distinct().count()
    assert sum(r.n for r in spread) / len(spread) < 0.75 * every


def test_null_dimensions_take_cell_0(spark):
    assert spark.range(1).select(s.hashed_cell(F.lit(None).cast("string"))).first()[0] == 0


def test_equal_rows_are_dealt_over_slices(spark):
    """20,000 equal rows of one id: no slice holds many more than it should, and the law holds."""
    docs = spark.range(20_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("the same").alias("text"), F.lit("en").alias("lang"), F.lit("a").alias("source"))
    rows = docs.select(F.monotonically_increasing_id().alias("_place"), F.lit(1).alias("c"))
    dealt = rows.groupBy(F.pmod(F.xxhash64("_place"), F.lit(4))).count().collect()
    assert max(r["count"] for r in dealt) < 5_500
    even(s.document_shards(docs).collect(), 8)
