from __future__ import annotations

import random
from itertools import combinations, permutations

import pytest

from lathework.operators import graph


def brute(edges):
    e = {(a, b) for a, b in edges if a != b}
    u = {frozenset(p) for p in e}
    vertices = {v for p in e for v in p}
    degree = {v: sum(v in p for p in u) for v in vertices}
    tri = {t for t in combinations(sorted(vertices), 3) if all(frozenset(p) in u for p in combinations(t, 2))}
    cycles = {}
    for t in tri:
        for a, b, c in permutations(t):
            if a == min(t) and {(a, b), (b, c), (c, a)} <= e:
                cycles[a] = cycles.get(a, 0) + 1
    reach = {}
    for v in vertices:
        one = {x for x, y in e if y == v}
        two = {x for x, y in e if y in one}
        if (one | two) - {v}:
            reach[v] = len((one | two) - {v})
    return sum(d * (d - 1) // 2 for d in degree.values()), tri, cycles, reach


def random_edges(seed, vertices=14, count=45, hub=None):
    rnd = random.Random(seed)
    out = [(rnd.randrange(vertices), rnd.randrange(vertices)) for _ in range(count)]
    if hub is not None:
        out += [(v, hub) for v in range(0, vertices, 2)] + [(hub, v) for v in range(1, vertices, 2)]
    return out


CASES = [random_edges(1), random_edges(2, 10, 60), random_edges(3, 20, 30, hub=4), random_edges(4, 16, 50, hub=0)]


@pytest.mark.parametrize("edges", CASES)
def test_measures_equal_brute_force(spark, rows, edges):
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    triplets, tri, cycles, reach = brute(edges)
    assert rows(graph.triplets(df)) == [(triplets,)]
    assert set(rows(graph.triangles(df, rows_per_task=3))) == tri
    assert dict(rows(graph.cycles3(df))) == cycles
    assert rows(graph.cycles3_total(df)) == [(sum(cycles.values()),)]
    (got,) = graph.clustering(df).collect()
    assert (got.triplets, got.triangles) == (triplets, len(tri))
    assert got.coefficient == pytest.approx(3 * len(tri) / triplets)
    assert dict(rows(graph.significance(df))) == reach


@pytest.mark.parametrize("edges", CASES)
@pytest.mark.parametrize("side", [1, 2, 5])
def test_significance_with_vertices_cut_into_grids(spark, rows, edges, side):
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    assert dict(rows(graph.significance(df, side, rows_per_task=3))) == brute(edges)[3]


def test_significance_with_twenty_hubs(spark, rows):
    """Every hub has forty edges in and forty out, some of them shared."""
    edges = [(1000 + (7 * h + i) % 300, h) for h in range(20) for i in range(40)] + [(h, 2000 + (11 * h + i) % 300) for h in range(20) for i in range(40)]
    reach = {}
    for x, m in edges:
        reach.setdefault(m, set()).add(x)
    for x, m in edges:
        for m2, v in edges:
            if m == m2 and x != v:
                reach.setdefault(v, set()).add(x)
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    for side in (7, 5_000):
        assert dict(rows(graph.significance(df, side, rows_per_task=30))) == {v: len(x) for v, x in reach.items()}


def test_loops_repeats_and_no_triplets(spark, rows):
    df = spark.createDataFrame([(1, 4), (4, 4), (4, 1), (1, 4), (7, 8)], "src bigint, dst bigint")
    assert rows(graph.cycles3(df)) == []
    assert rows(graph.cycles3_total(df)) == [(0,)]
    assert rows(graph.clustering(df)) == [(0, 0, None)]
    assert dict(rows(graph.significance(df))) == {1: 1, 4: 1, 8: 1}


def test_two_directions_of_a_triangle_are_two_cycles(spark, rows):
    ring = [(1, 2), (2, 3), (3, 1)]
    df = spark.createDataFrame(ring + [(b, a) for a, b in ring], "src bigint, dst bigint")
    assert rows(graph.cycles3(df)) == [(1, 2)]
    assert rows(graph.triangles(df)) == [(1, 2, 3)]
