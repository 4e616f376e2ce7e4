from __future__ import annotations

import math

import numpy as np
import pytest

from lathework.llm import whitening as w

SCHEMA = "vec_id bigint, embedding array<float>, label int, component string, x string"


def table(spark, vectors, parts=3):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, "c", "x") for i, v in enumerate(vectors)], SCHEMA).repartition(parts)


def expected(vectors, k=4):
    """Whole numbers, n, sums, and the whitened coordinates by numpy's eigenvectors."""
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors], dtype=object)
    fit = np.array(sorted(set(map(tuple, x))), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit - np.array([s / n for s in sums])).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - np.array([s / n for s in sums])).astype(float) @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def check(spark, vectors, k=4):
    out = w.whitened(table(spark, vectors)).toPandas()
    n, deviation, z, share = expected(vectors, k)
    assert (out.n == n).all() and (out.identity_error < 1e-9).all() and len(out) == len(vectors) * k
    first = out[out.component == 1].sort_values("vec_id")
    assert first.deviation.tolist() == list(deviation)
    got = out.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    assert np.allclose(got * np.sign((got * z).sum(axis=0)), z, atol=1e-8)
    assert np.allclose(out.groupby("component").explained.first(), share, rtol=1e-9)


@pytest.mark.parametrize("n,dims", [(40, 6), (500, 40), (300, 70)])
def test_equals_numpy(spark, n, dims):
    random = np.random.default_rng(dims)
    check(spark, random.standard_normal((n, dims)) * np.linspace(1, 2, dims))


def test_leading_values_close_together(spark):
    random = np.random.default_rng(5)
    scale = np.array([3, 2.999, 2.99, 2.98, 2.97] + [2.9] * 45)
    check(spark, random.standard_normal((3000, 50)) * scale)


def test_a_third_of_the_rows_are_one_vector(spark):
    random = np.random.default_rng(7)
    vectors = random.standard_normal((200, 10))
    check(spark, np.vstack([vectors, np.tile(vectors[3], (100, 1))]))


def test_block_grows_when_it_is_too_narrow(spark, monkeypatch):
    monkeypatch.setattr(w, "PATIENCE", 1)
    random = np.random.default_rng(9)
    fit = w._written(table(spark, random.standard_normal((200, 30))).transform(w.whole_vectors).select("x").distinct())
    rows = w.Rows(fit, 30, 200, w.exact_sums(fit, 30))
    values, axes = w.leading_eigenpairs(rows, 3, guard=1, degree=1)
    assert np.allclose(rows.times(axes), axes * values, atol=1e-8 * values[0])


def test_sums_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(w, "MOST_PARTS", 2)
    random = np.random.default_rng(3)
    vectors = random.standard_normal((100, 5))
    fit = table(spark, vectors, 20).transform(w.whole_vectors).select("x")
    rows = w.Rows(fit, 5, 100, w.exact_sums(fit, 5))
    x = np.floor(256 * vectors.astype(np.float32).astype(float))
    assert rows.parts == 20 and rows.sums == x.sum(axis=0).tolist()
    assert np.allclose(rows.times(np.eye(5)), np.cov(x.T, bias=True))


def test_odd_rows(spark):
    good = [[1, 2, 3], [4, 5, 7], [0, -1, 2], [-3.3, 8, 1], [4, 5, 7]]
    odd = [None, [1, None, 3], [math.nan, 1, 2], [math.inf, 1, 2], [], [1, 2], [None, None, None]]
    out = w.whitened(table(spark, good + odd)).collect()
    assert {r.vec_id for r in out} == set(range(5)) and {r.component for r in out} == {1, 2, 3} and {r.n for r in out} == {4}
    assert [f.name for f in w.whitened(table(spark, good + odd)).schema] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[1, 2, 3]], [[1, 2, 3]] * 4])
def test_nothing_to_whiten(spark, vectors):
    assert w.whitened(table(spark, vectors)).count() == 0


def test_two_vectors_span_one_component(spark):
    out = w.whitened(table(spark, [[0, 0, 0], [1, 1, 0], [1, 1, 0]])).collect()
    assert {r.component for r in out} == {1} and sorted(round(abs(r.whitened), 9) for r in out) == [1, 1, 1]


def test_deviation_of_huge_entries():
    x = np.array([[2**40, 0], [3, 4]], dtype=np.int64)
    assert w.deviations(x, 2, [2**40 + 3, 4]) == [None, None]
    assert w.deviations(x, 2, [6, 8]) == [None, 0]
    assert w.deviations(x[1:], 10**6, [0, 0]) == [25 * 10**12]
