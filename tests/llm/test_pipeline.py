from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from lathework.llm import near_duplicates, packing

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The result of every stage, over the one before."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for _, stage in cp.STAGES:
        out.append((docs, stage(spark, docs, FOLDER).cache()))
        docs = out[-1][1]
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    for docs, result in stages[:4]:
        assert result.columns == docs.columns and result.dtypes == docs.dtypes
    assert all(result.count() <= docs.count() for docs, result in stages[:3])
    assert stages[3][0].count() == stages[3][1].count()


def test_one_of_each_group_stays(stages):
    docs, result = stages[1]
    want = {r.doc_id for r in near_duplicates.near_duplicates(docs, size=cp.SHINGLE).where("kept").collect()}
    assert {r.doc_id for r in result.collect()} == want and result.count() == len(want)


def test_benchmark_texts_are_gone(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before, after = ([r.text for r in df.collect()] for df in stages[2])
    assert any(i in t for i in items for t in before) and not any(i in t for i in items for t in after)


def test_personal_data_is_gone(stages):
    texts = [r.text for r in stages[3][1].collect()]
    assert any("[EMAIL]" in t for t in texts) and not any("@mail" in t for t in texts)
    assert all(r.n_chars == len(r.text) for r in stages[3][1].collect())


def test_every_kept_document_is_packed(stages):
    docs, pieces = stages[4]
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in pieces.collect()}
    assert set(pieces.columns) == {c.split(" ")[0] for c in packing.PACKED.split(", ")}


def test_odd_documents(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for name, stage in cp.STAGES:
            result = stage(spark, docs, FOLDER).cache()
            if name != "packing":
                assert result.columns == docs.columns, name
            docs = result
    assert docs.count() == 0
    kept = cp.one_of_each_group(spark, odd_documents, FOLDER).collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept) == [-1, 1, 2, 3, 4, 5, 7, 8]


def test_run_equals_the_stages(spark, stages):
    assert sorted(map(tuple, cp.run(spark, FOLDER).collect())) == sorted(map(tuple, stages[4][1].collect()))


def test_near_duplicates_are_of_five_words(spark):
    """Documents of the driver table that are near-duplicates at two words and not at five stay."""
    def sets(text):
        w = text.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    ids = [56, 547, 212, 2250]
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(F.col("doc_id").isin(ids))
    copies = docs.where("doc_id = 56").withColumn("doc_id", F.lit(9_000_000).cast("bigint")).withColumn("text", F.concat("text", F.lit(" end")))
    docs = docs.union(copies.select(*docs.columns)).cache()
    texts = {r.doc_id: sets(r.text) for r in docs.collect()}
    assert len(texts) == 5
    want = {b for b in texts if not any(a < b and 100 * len(texts[a] & texts[b]) >= 80 * len(texts[a] | texts[b]) for a in texts)}
    assert want == set(ids)
    assert {r.doc_id for r in cp.one_of_each_group(spark, docs, FOLDER).collect()} == want


def test_rows_that_share_a_doc_id_or_have_none(spark):
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").where("text IS NOT NULL").first().text
    clean, other, third = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(1, clean), (1, other), (1, clean), (None, clean + " end"), (None, third), (None, third + " end"), (2, item), (2, "a clean text"), (None, item + " end"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(((r.doc_id, r.text) for r in cp.one_of_each_group(spark, docs, FOLDER).collect()), key=repr)
    thirds = [r for r in kept if r[0] is None and r[1] and r[1].startswith("c0 ")]
    assert len(thirds) == 1 and len(kept) == 6
    assert {(1, clean), (1, other), (2, item), (2, "a clean text"), (None, None)} < set(kept)
    left = {tuple(r) for r in cp.decontaminate(spark, docs, FOLDER).collect()}
    assert left == set(rows) - {(2, item), (None, item + " end")}


def test_groups_equal_all_pairs_of_five_words(spark):
    """The near-duplicates stage over the whole small table against all pairs of its texts."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sets = {}
    for r in docs.collect():
        w = (r.text or "").encode().lower().split()
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    want = [i for i in ids if find(i) == i]
    assert sorted(r.doc_id for r in cp.one_of_each_group(spark, docs, FOLDER).collect()) == want and len(want) < len(ids)
