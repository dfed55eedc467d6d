"""Shortest paths, levels and eccentricities against plain versions."""

import math
import random
from collections import defaultdict, deque

import pytest

from cohortspark.operators import graph as G


def table(spark, rows):
    return spark.createDataFrame([(a, b, float(w)) for a, b, w in rows], "src long, dst long, weight double").repartition(3)


def bellman(rows, source):
    d = defaultdict(lambda: math.inf, {source: 0.0})
    for _ in range(len(rows)):
        for a, b, w in rows:
            d[b] = min(d[b], d[a] + w)
    return {v: d[v] for a, b, _ in rows for v in (a, b)}


@pytest.mark.parametrize("bucket", [None, 5.0])
def test_distances(spark, bucket):
    rng = random.Random(3)
    rows = [(rng.randrange(30), rng.randrange(30), rng.randrange(0, 20)) for _ in range(45)]
    rows += [(100 + i, 101 + i, 1.5) for i in range(20)] + [(5, 100, 2), (110, 110, 4), (120, 7, -1.0)]  # a chain out and back in
    rows += [(200, 201, 1), (201, 202, 1), (202, 200, 1)]  # a loop that nothing leads into
    got = {r.id: r.distance for r in G.shortest_paths(table(spark, rows), rows[0][0], bucket=bucket).collect()}
    assert got == pytest.approx(bellman(rows, rows[0][0]))


def test_long_chain(spark):
    rows = [(i, i + 1, 1) for i in range(5000)] + [(2500, 9000, 3)]
    got = {r.id: r.distance for r in G.shortest_paths(table(spark, rows), 0).collect()}
    assert got == {**{i: float(i) for i in range(5001)}, 9000: 2503.0}


def test_negative_loops(spark):
    loop = [(0, 1, 1), (1, 2, -2), (2, 3, 1), (3, 1, 0.5), (1, 9, 1)]
    with pytest.raises(ValueError, match="negative"):
        G.shortest_paths(table(spark, loop), 0)
    # one that cannot be reached does not matter, nor does one that comes to zero
    out = {r.id: r.distance for r in G.shortest_paths(table(spark, loop[1:] + [(20, 21, 1)]), 20).collect()}
    assert out == {1: math.inf, 2: math.inf, 3: math.inf, 9: math.inf, 20: 0.0, 21: 1.0}
    zero = [(0, 1, 1), (1, 2, -2), (2, 1, 2), (2, 5, 1)]
    assert {r.id: r.distance for r in G.shortest_paths(table(spark, zero), 0).collect()} == {0: 0.0, 1: 1.0, 2: -1.0, 5: 0.0}


def levels(rows):
    into, out, need = defaultdict(set), defaultdict(set), {}
    for a, b, _ in rows:
        into[b].add(a)
        out[a].add(b)
    ids = set(into) | set(out)
    level, todo = {}, deque(v for v in ids if not into[v])
    left = {v: len(into[v]) for v in ids}
    for v in todo:
        level[v] = 0
    while todo:
        v = todo.popleft()
        for u in out[v]:
            level[u] = max(level.get(u, 0), level[v] + 1)
            left[u] -= 1
            if not left[u]:
                todo.append(u)
    return level


def test_levels(spark):
    rng = random.Random(4)
    rows = [(a, b, 1) for a, b in ((rng.randrange(25), rng.randrange(25)) for _ in range(60)) if a < b]
    rows += [(100 + i, 101 + i, 1) for i in range(40)] + [(3, 110, 1), (130, 24, 1), rows[0]]
    assert {r.id: r.level for r in G.topo_levels(table(spark, rows)).collect()} == levels(rows)
    assert {r.id: r.level for r in G.topo_levels(table(spark, [(i, i + 1, 1) for i in range(40)])).collect()} == {i: i for i in range(41)}


@pytest.mark.parametrize("rows", [[(1, 1, 1)], [(1, 2, 1), (2, 3, 1), (3, 1, 1)], [(0, 1, 1), (1, 2, 1), (2, 1, 1), (2, 3, 1)], [(1, 2, 1), (2, 2, 1), (2, 3, 1)]])
def test_loops_have_no_level(spark, rows):
    with pytest.raises(ValueError, match="loop"):
        G.topo_levels(table(spark, rows))


def hops(rows, ids):
    near = defaultdict(set)
    for a, b, _ in rows:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for s in ids:
        d, todo = {s: 0}, deque([s])
        while todo:
            v = todo.popleft()
            for u in near[v] - d.keys():
                d[u] = d[v] + 1
                todo.append(u)
        out[s] = max(d.values())
    return out


def test_eccentricities(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(max(0, i - 4), i), 1) for i in range(1, 150)] + [(rng.randrange(150), rng.randrange(150), 1) for _ in range(10)]
    rows += [(200 + i, 201 + i, 1) for i in range(20)] + [(300, 301, 1), (302, 302, 1)]
    ids = {v for a, b, _ in rows for v in (a, b)} | {999}
    vertices = spark.createDataFrame([(v,) for v in ids], "id long")
    got = G.eccentricities(table(spark, rows), vertices).collect()
    assert {r.id: r.eccentricity for r in got} == hops(rows, ids)
    assert {r.component for r in got if 200 <= r.id <= 220} == {200}
