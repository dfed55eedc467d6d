"""Interval joins and algebra on split and whole lines, against comparing all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from cohortspark.operators import joins as J


def spans(rng, n, longest, keys):
    out = []
    for i in range(n):
        a = rng.choice([rng.randrange(1000), 500, None]) if i % 9 == 0 else rng.randrange(1000)
        b = None if a is None or i % 17 == 0 else a + rng.choice([-3, 0, 0, 1, rng.randrange(longest)])
        out.append((i, rng.choice(keys), a, b))
    return out


def meet(a, b, c, d, closed):
    return None not in (a, b, c, d) and a <= b and c <= d and ((a <= d and c <= b) if closed else (a < d and c < b))


def both_ways(spark, rng, n, longest, keys):
    xs, ys = spans(rng, n, longest, keys), spans(rng, n, longest, keys)
    x = spark.createDataFrame(xs, "i int, k int, a int, b int").repartition(3)
    y = spark.createDataFrame(ys, "j int, k long, c long, d long").repartition(3)
    for bounds in ("[]", "[)"):
        want = sorted((p[0], q[0]) for p in xs for q in ys if p[1] == q[1] and meet(*p[2:], *q[2:], bounds == "[]"))
        got = J.overlap_join(x, y, ("a", "c"), ("b", "d"), ["k"], bounds)
        assert got.columns == ["i", "k", "a", "b", "j", "c", "d"]
        assert sorted((r.i, r.j) for r in got.collect()) == want
    want = sorted((p[0], q[0]) for p in xs for q in ys if p[1] == q[1] and meet(p[2], p[2], *q[2:], True))
    got = J.within_join(x, y.withColumnsRenamed({"c": "a", "d": "b"}), "a", "a", "b", ["k"])
    assert got.columns == ["i", "k", "a", "b", "j", "a.y", "b.y"]
    assert sorted((r.i, r.j) for r in got.collect()) == want


def test_all_pairs_whole_lines(spark):
    both_ways(spark, random.Random(1), 150, 300, [1, 2, None])


def test_all_pairs_split_lines(spark, small_limit):
    both_ways(spark, random.Random(2), 300, 900, [1, 1, 1, 2, None])
    both_ways(spark, random.Random(3), 200, 40, [5])


@pytest.mark.parametrize("kind", ["double", "timestamp", "date"])
def test_other_times_and_no_keys(spark, small_limit, kind):
    rng = random.Random(4)
    points = [(i, rng.randrange(400)) for i in range(120)]
    lines = [(i, s, s + rng.randrange(120)) for i, s in enumerate(rng.choices(range(400), k=60))]
    cast = {"double": lambda c: (F.col(c) / 7).cast("double"), "timestamp": lambda c: F.timestamp_seconds(F.col(c) * 1000),
            "date": lambda c: F.date_add(F.lit("2020-01-01"), F.col(c).cast("int"))}[kind]
    x = spark.createDataFrame(points, "p int, t int").withColumn("t", cast("t"))
    y = spark.createDataFrame(lines, "q int, s int, e int").withColumns({"s": cast("s"), "e": cast("e")})
    for bounds, test in (("[]", lambda t, s, e: s <= t <= e), ("(]", lambda t, s, e: s < t <= e), ("[)", lambda t, s, e: s <= t < e), ("()", lambda t, s, e: s < t < e)):
        got = J.within_join(x, y, "t", "s", "e", bounds=bounds)
        assert sorted((r.p, r.q) for r in got.collect()) == sorted((p, q) for p, t in points for q, s, e in lines if test(t, s, e))


def test_no_row_is_copied(spark):
    x = spark.range(100).selectExpr("id % 5 AS k", "id AS t")
    y = spark.range(100).selectExpr("id % 5 AS k", "id AS s", "id + 50 AS e")
    plan = J.within_join(x, y, "t", "s", "e", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan and "NestedLoop" not in plan


def test_empty_sides(spark):
    x = spark.createDataFrame([(1, 5)], "k int, t int")
    y = spark.createDataFrame([], "k int, s int, e int")
    assert J.within_join(x, y, "t", "s", "e", ["k"]).count() == 0
    assert J.within_join(x.limit(0), y, "t", "s", "e").count() == 0


def cells(rows):
    return {(k, v) for k, a, b in rows for v in range(a, b)}


def test_algebra_on_split_lines(spark, small_limit):
    rng = random.Random(6)
    draw = lambda: [(rng.choice([1, 1, 2, None]), a, a + rng.choice([0, 1, 5, 30])) for a in (rng.randrange(400) for _ in range(150))]
    xs, ys = draw(), draw()
    x, y = (spark.createDataFrame(r, "k int, start int, end int") for r in (xs, ys))
    for fn, want in ((J.interval_setdiff, cells(xs) - cells(ys)), (J.interval_intersect, cells(xs) & cells(ys)), (J.interval_union, cells(xs) | cells(ys))):
        got = [tuple(r) for r in fn(x, y, ["k"]).collect()]
        assert cells(got) == want and sum(b - a for _, a, b in got) == len(want)
        at = sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        assert all(p[0] != q[0] or p[2] < q[1] for p, q in zip(at, at[1:]))  # whole stretches
