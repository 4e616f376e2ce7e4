from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lathework.llm import negatives as m

SCHEMA = "vec_id bigint, embedding array<float>, label int, anchor boolean, row string, x int, rank int"


def table(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, l, None if i is None else i % 10 == 0, "r", 0, 0) for i, v, l in rows], SCHEMA).repartition(parts)


def expected(rows, k=5):
    x = [(i, [math.floor(256 * float(np.float32(c))) for c in v], l, n) for n, (i, v, l) in enumerate(rows)]
    out = []
    for i, a, l, n in x:
        if i % 10:
            continue
        scored = sorted((-sum(p * q for p, q in zip(a, b)), j, other == l) for j, b, other, place in x if place != n)
        for s, j, _ in [t for t in scored if t[2]][:k]:
            fitting = [t for t in scored if not t[2] and 80 * -s <= 100 * -t[0] <= 100 * -s][:k]
            out += [(i, j, rank, t[1], -s, -t[0]) for rank, t in enumerate(fitting, 1)]
    return sorted(out)


def mined(rows, **options):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    out = m.mined(rows, **options)
    assert out.columns == names
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("bound", [0, 1, 125, 10**6, 2**40, 2**56])
def test_base_and_reconstruction(bound):
    primes = m.prime_base(bound)
    assert math.prod(primes) > 2 * bound and all(all(p % q for q in range(2, p)) for p in primes)
    values = np.unique(np.array([-bound, bound, 0, bound // 3, -(bound // 7), min(bound, 1)], dtype=np.int64))
    one = [np.ones((1, 1), dtype=np.float32)] * len(primes)
    assert m.exact_product(m.residues(values[:, None], primes), one, primes)[:, 0].tolist() == values.tolist()


@pytest.mark.parametrize("dims,most", [(3, 2**27), (64, 200), (3000, 5000)])
def test_products_are_exact(dims, most):
    random = np.random.default_rng(dims)
    a, b = random.integers(-most, most + 1, (7, dims)), random.integers(-most, most + 1, (9, dims))
    primes = m.prime_base(most * most * dims)
    want = a.astype(object) @ b.astype(object).T
    assert m.exact_product(m.residues(a, primes), m.residues(b, primes), primes).tolist() == want.tolist()


def test_best_breaks_ties_by_place():
    assert m.best(np.array([1, 5, 5, 3, 5, 0]), 2).tolist() == [1, 2]
    assert m.best(np.array([1, 5]), 5).tolist() == [1, 0] and m.best(np.array([], dtype=np.int64), 5).tolist() == []


@pytest.mark.parametrize("options", [{}, {"rows_per_slice": 20, "anchors_per_block": 3}])
def test_equals_brute_force(spark, options):
    random = np.random.default_rng(1)
    centres = random.standard_normal((3, 8))
    rows = [(i, (centres[i % 3] + 0.7 * random.standard_normal(8)).round(1).tolist(), int(random.integers(0, 4))) for i in range(200)]
    want = expected(rows)
    assert mined(table(spark, rows), **options) == want and len(want) > 100


def test_ties_and_repeated_rows(spark):
    rows = [(i, [1.0, 0.0] if i % 4 else [0.9, 0.1], i % 2) for i in range(60)] + [(20, [0.9, 0.1], 0)] * 2
    assert mined(table(spark, rows), rows_per_slice=7) == expected(rows)


def test_negative_and_zero_scores(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [0.0, -1.0], 1), (4, [-0.9, 0.0], 1), (5, [0.0, 0.0], 1)]
    assert mined(table(spark, rows)) == expected(rows) == [(0, 2, 1, 3, 0, 0), (0, 2, 2, 5, 0, 0)]


def test_odd_rows(spark):
    good = [(0, [1.0, 0.5], 0), (1, [1.0, 0.4], 0), (2, [0.9, 0.5], 1), (10, [0.2, 0.1], 3)]
    odd = [(None, [1.0, 0.5], 0), (20, None, 0), (21, [1.0, 0.5], None), (30, [math.nan, 1.0], 0), (31, [1.0, None], 1), (32, [math.inf, 1.0], 1), (33, [], 0),
           (34, [1.0], 1), (40, [3e38, 1.0], 0)]
    assert mined(table(spark, good + odd)) == expected(good)
    assert mined(table(spark, odd[:7])) == [] == mined(table(spark, []))
    no_anchor = table(spark, good).withColumn("anchor", F.lit(None).cast("boolean"))
    assert mined(no_anchor) == []
