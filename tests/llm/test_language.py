from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from lathework.llm import language as lg


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = lg.fit_on(docs)
    rows = lg.predicted(docs, net).where(lg.held_out(F.col("doc_id"))).collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def slow_pooled(net, texts):
    out = []
    for text, at in [(t, at) for t in texts for at in range(0, len(t), lg.WINDOW)]:
        data, row, at = text[at:at + lg.WINDOW + lg.AHEAD].ljust(lg.WINDOW + lg.AHEAD, b"\0") if at + lg.WINDOW < len(text) else text[at:].ljust(lg.WINDOW + lg.AHEAD, b"\0"), [], 0
        for w, table in zip(lg.WIDTHS, net.tables):
            answers = [sum(table[k][data[p + k]] for k in range(w)) for p in range(at, at + lg.WINDOW)]
            row.append(np.max(answers, axis=0))
        out.append(np.maximum(np.concatenate(row) + net.biases, 0))
    return np.array(out)


def test_pair_tables_give_the_filters_answers():
    net = lg.fit(["the cat sat on the mat " * 8, "der hund und die katze " * 8], ["en", "de"], batches=5)
    texts = [b"the cat", b"", b"the cat sat on der hund " * 12, b"y" * 127, b"z" * 128]
    data, owner, filled = lg.windows(texts)
    assert owner.tolist() == [0, 2, 2, 2, 3, 4]
    assert filled.sum() == sum(map(len, texts))
    assert np.allclose(lg.Reader(net).pooled(data, owner), slow_pooled(net, texts), atol=1e-4)


def test_every_byte_counts_and_neighbours_do_not():
    net = lg.fit(["the cat sat on the mat " * 8, "der hund und die katze " * 8], ["en", "de"], batches=60)
    reader = lg.Reader(net)
    texts = [b"the cat sat " * 50, b"der hund " * 90, b"a"]
    together = reader.probabilities(texts)
    assert np.allclose(together, [reader.probabilities([t])[0] for t in texts], atol=1e-5)
    assert together[0].argmax() != together[1].argmax()
    late = reader.probabilities([b"the cat sat " * 20 + b"der hund und die katze " * 200])[0]
    assert late.argmax() == together[1].argmax()


def test_odd_and_empty(odd_documents, no_documents):
    net = lg.fit_on(odd_documents)
    out = lg.predicted(odd_documents, net)
    assert out.columns[-2:] == ["lang_pred", "score"] and out.columns.count("score") == 1
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert by_id[2] == by_id[3] == by_id[4] == ("und", 0.0)
    assert by_id[1][0] == by_id[6][0] and abs(by_id[1][1] - by_id[6][1]) < 1e-5 and by_id[5][0] in net.languages
    assert lg.predicted(no_documents, net).count() == 0
    assert lg.fit_on(no_documents) is None
    assert {r.lang_pred for r in lg.predicted(odd_documents, None).collect()} == {"und"}


def test_no_language_is_dropped_from_the_sample(spark):
    from lathework.llm import language
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('words of ', id % 1200) AS text", "cast(id % 1200 AS string) AS lang")
    assert language.labelled_sample(docs).select("lang").distinct().count() == 1200
    few = language.labelled_sample(docs, most_rows=3000).groupBy("lang").count().collect()
    assert len(few) == 1200 and {r["count"] for r in few} <= {1, 2} and sum(r["count"] for r in few) <= 3000


def test_languages_of_one_shared_id_are_learnt(spark):
    """Eight languages, each with all its rows under one id: none is lost to the threshold of the hash."""
    docs = spark.range(80_000).selectExpr("id % 8 + 1 AS doc_id", "concat('words of ', id % 5000, ' in ', id % 8) AS text", "concat('l', id % 8) AS lang")
    docs = docs.where(~lg.held_out(F.col("doc_id")))
    want = docs.select("lang").distinct().count()
    counts = {r["lang"]: r["count"] for r in lg.labelled_sample(docs, per_language=20).groupBy("lang").count().collect()}
    assert len(counts) == want > 4 and set(counts.values()) == {20}
    one = spark.range(20_000).selectExpr("2L AS doc_id", "'all the same' AS text", "concat('l', id % 3) AS lang")
    assert [tuple(r) for r in lg.labelled_sample(one).orderBy("lang").collect()] == [("all the same", f"l{i}") for i in range(3)]


def test_only_letters_make_a_language(spark):
    net = lg.fit(["the cat sat on the mat " * 8, "der hund und die katze " * 8], ["en", "de"], batches=5)
    docs = spark.createDataFrame([(1, "½ ² Ⅷ"), (2, "12 ½a"), (3, "²½"), (4, "ª"), (5, "中")], "doc_id bigint, text string")
    assert {r.doc_id: r.lang_pred == "und" for r in lg.predicted(docs, net).collect()} == {1: True, 2: False, 3: True, 4: False, 5: False}
