from __future__ import annotations

import random
import re

import pytest

from lathework.llm import near_duplicates as nd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets(texts):
    out = {}
    for i, t in texts.items():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = WORD.findall(low)
        out[i] = set(zip(w, w[1:])) if len(w) > 1 else ({tuple(w)} if w else set())
    return out


def brute_components(shingles):
    root = {i: i for i in shingles}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(shingles)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(shingles[a] & shingles[b])
            if both and 100 * both >= 80 * (len(shingles[a]) + len(shingles[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def compare(docs, result):
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    shingles = sets(texts)
    want = brute_components(shingles)
    for r in result.collect():
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (len(shingles[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_driver_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    compare(docs, nd.near_duplicates(docs))


def test_chains_and_groups(spark):
    """A chain of edits whose ends are unlike, a group around a middle text, and unlike texts."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    rows, text = [], [rng.choice(words) for _ in range(120)]
    middle = list(text)
    for i in range(40):
        rows.append((1000 - i, " ".join(text)))
        text = list(text)
        for _ in range(3):
            text[rng.randrange(len(text))] = rng.choice(words)
    for i in range(60):
        own = list(middle)
        for _ in range(rng.randint(0, 12)):
            own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((2000 + i, " ".join(own)))
    rows += [(3000 + i, " ".join(rng.choice(words) for _ in range(50))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    compare(docs, nd.near_duplicates(docs))


def test_odd_documents(odd_documents):
    result = nd.near_duplicates(odd_documents)
    assert result.count() == 10
    compare(odd_documents, result)
    assert [r.kept for r in result.collect() if r.doc_id is None] == [False]


def test_no_documents(no_documents):
    assert nd.near_duplicates(no_documents).count() == 0


def test_bounds_keep_pairs_at_the_threshold():
    least = nd.least_agreements()
    assert sorted(least) == [25, 50, 75, 100, 125]
    assert all(m < 0.8 * n for n, m in least.items())


@pytest.mark.parametrize("edges,want", [
    ([], {}),
    ([(1, 2), (3, 2), (4, 5)], {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}),
    ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)}),
    ([(9, i) for i in range(10, 60)] + [(1, 59), (7, 7)], {**{i: 1 for i in range(9, 60)}, 1: 1}),
])
def test_components(spark, edges, want):
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r.node: r.component for r in nd.components(df).collect()} == want


def test_parities_differ_by_no_more_than_the_sets():
    import numpy as np

    random = np.random.default_rng(8)
    for _ in range(200):
        both = random.integers(-2**63, 2**63 - 1, random.integers(0, 400))
        a, b = (np.unique(np.concatenate([both, random.integers(-2**63, 2**63 - 1, random.integers(0, 60))])) for _ in range(2))
        bits = sum(bin(int(x) & (2**64 - 1)).count("1") for x in nd.parities(a) ^ nd.parities(b))
        assert bits <= len(np.setxor1d(a, b)) and bits % 2 == len(np.setxor1d(a, b)) % 2
    assert nd.parities(np.array([], dtype=np.int64)).tolist() == [0] * nd.PARITY_WORDS
