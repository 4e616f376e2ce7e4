from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from lathework.llm import toxicity as t


def test_held_out_texts_are_judged_well(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = t.fit_on(docs, labels)
    test = docs.join(labels, "doc_id").where(t.held_out(F.col("doc_id"))).select("doc_id", "text", "toxic")
    rows = t.scored(test, model).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    caught = sum(r.toxic and r.score >= 0.5 for r in rows) / sum(r.toxic for r in rows)
    wrong = sum(not r.toxic and r.score >= 0.5 for r in rows) / sum(not r.toxic for r in rows)
    assert caught > 0.85 and wrong < 0.01


def test_identity_terms_are_neutral_when_swaps_are_penalised():
    toxic = [f"{i} you vile gay person number{i}" for i in range(60)]
    clean = [f"{i} a gentle person number{i}" for i in range(60)] + ["a gay man spoke kindly"] * 3
    texts, labels = toxic + clean, [1] * 60 + [0] * 63
    held = t.fit(texts, labels)
    free = t.fit(texts, labels, penalty=0.0)
    score = lambda m, text: t.score_counts(m, t.word_counts(text))
    rise = lambda m: score(m, "the gay man sang") - score(m, "the man sang")
    assert rise(held) < 0.5 * rise(free)
    assert score(held, "you vile person") > 0.5 > score(held, "the gay man sang")


def test_odd_and_empty(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (6, 0), (8, None), (None, 1), (1, 0), (99, 1), (5, 7)], "doc_id bigint, toxic int")
    model = t.fit_on(odd_documents, labels)
    rows = t.scored(odd_documents, model).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    assert t.scored(no_documents, model).count() == 0
    none = t.fit_on(odd_documents, labels.limit(0))
    assert {r.score for r in t.scored(odd_documents, none).collect()} == {0.5}


def test_fit_reaches_the_optimum_of_a_plain_minimiser():
    """Loss written down row by row; its gradient by differences; long plain descent from other weights ends no lower."""
    import numpy as np

    random = np.random.default_rng(2)
    vocabulary = [f"word{i}" for i in range(12)]
    texts = [" ".join(random.choice(vocabulary[:8] if i % 2 else vocabulary[4:], 9)) + (" women" if i % 3 == 0 else "") for i in range(80)]
    labels = [i % 2 for i in range(80)]
    model = t.fit(texts, labels, rounds=3000)
    names = sorted({f for x in texts for w in t.word_counts(x) for f in t.word_features(w)} | {f for x in t.IDENTITY_TERMS for f in t.word_features(x)})
    used = [n for n in names if n in model.weights]

    def vector(counts):
        totals = t._features(counts)
        return np.array([1.0, np.log1p(counts.total())] + [np.log1p(totals.get(n, 0)) for n in used])

    x = np.array([vector(t.word_counts(text)) for text in texts])
    d = x - np.array([vector(t.counterfactual(t.word_counts(text), i, t.IDENTITY_TERMS)) for i, text in enumerate(texts)])
    y, ridge = np.array(labels, dtype=float), np.array([0.0] + [t.RIDGE] * (len(used) + 1))

    def loss(w):
        z = x @ w
        return float(np.mean(np.logaddexp(0, z) - y * z) + t.COUNTERFACTUAL * np.mean((d @ w) ** 2) + 0.5 * np.sum(ridge * w**2))

    def slope(w):
        z = x @ w
        return x.T @ (1 / (1 + np.exp(-z)) - y) / len(y) + 2 * t.COUNTERFACTUAL * d.T @ (d @ w) / len(y) + ridge * w

    w = np.array([model.bias, model.length] + [model.weights[n] for n in used])
    step = 1e-5
    numeric = [(loss(w + step * e) - loss(w - step * e)) / (2 * step) for e in np.eye(len(w))]
    assert np.allclose(numeric, slope(w), atol=1e-6)
    other = np.zeros(len(w))
    rate = 1 / (np.linalg.norm(x, 2) ** 2 / (4 * len(y)) + 2 * np.linalg.norm(d, 2) ** 2 / len(y) + t.RIDGE)
    for _ in range(20_000):
        other -= rate * slope(other)
    assert loss(w) <= loss(other) + 1e-4
    assert np.allclose([t.score_counts(model, t.word_counts(text)) for text in texts], 1 / (1 + np.exp(-x @ w)), atol=1e-9)
