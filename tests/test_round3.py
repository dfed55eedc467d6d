"""Findings of the third round: odd values, and steps that had to grow no faster than their rows."""

import math
import random
from fractions import Fraction

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortspark.functions import dates as D
from cohortspark.functions import numbers as M
from cohortspark.operators import apply as P
from cohortspark.operators import graph as G
from cohortspark.operators import ordered as O
from cohortspark.operators import reshape as R
from cohortspark.operators import states as S
from cohortspark.plans import book
from conftest import rows


def as_text(v):
    return str(round(v, 6) + 0.0) if isinstance(v, float) else v


def test_scales_outside_their_range_equal_sql(spark, tmp_path):
    values = [0.0, -3.0, 1.0, 250.0, 500.0, 560.0, None]
    spark.createDataFrame(list(enumerate(values)), "event_id bigint, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = book.queries()["scale_transforms"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    cur = con.execute(book.oracles()["scale_transforms"])
    names = [d[0] for d in cur.description]
    want = {r[0]: dict(zip(names, map(as_text, r))) for r in cur.fetchall()}
    assert {r.event_id: {c: as_text(r[c]) for c in names} for r in got.select("*").collect() if r.event_id != 1} == {k: v for k, v in want.items() if k != 1}
    # a negative value has no logarithm: SQL names NaN too, also for what is made of it
    below = got.where("event_id = 1").first()
    assert math.isnan(below.r) and math.isnan(below.lg) and math.isnan(below.l1) and math.isnan(below.back) and below.rc == round(-1 / 3, 6)


def test_scales_at_their_poles(spark):
    at = lambda v, name, back=False: spark.range(1).select(M.transform_scale(F.lit(v), name, back).alias("x")).first()[0]
    assert at(0.0, "log") == at(0.0, "log2") == at(0.0, "log10") == at(-1.0, "log1p") == at(0.0, "logit") == -math.inf
    assert at(1.0, "logit") == at(0.0, "reciprocal") == at(0.0, "reciprocal", True) == math.inf and at(-0.0, "reciprocal") == -math.inf
    assert at(0, "reciprocal") == math.inf and at(4, "reciprocal") == 0.25


def plain_eccentricities(edges, more=()):
    near = {v: set() for e in edges for v in e if v is not None} | {v: set() for v in more}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    out = []
    for s in near:
        d, todo = {s: 0}, [s]
        for v in todo:
            for w in near[v]:
                if w not in d:
                    d[w] = d[v] + 1
                    todo.append(w)
        out.append((s, min(d), max(d.values())))
    return sorted(out, key=repr)


def test_eccentricities_with_leaves(spark):
    rng = random.Random(3)
    tree = [(rng.randrange(max(0, v - 9), v), v) for v in range(1, 90)] + [(3, 40), (7, 61)]
    star, pair, path = [(200, v) for v in range(190, 210) if v != 200], [(301, 300), (300, 301)], [(400 + i, 401 + i) for i in range(7)]
    loop, alone, missing = [(500 + i, 500 + (i + 1) % 5) for i in range(5)] + [(502, 509)], [(600, 600), (400, 400)], [(700, None), (None, 3)]
    edges = tree + star + pair + path + loop + alone + missing
    got = rows(G.eccentricities(spark.createDataFrame(edges, "src bigint, dst bigint")))
    assert got == plain_eccentricities(edges)
    listed = spark.createDataFrame([(v,) for v in [*range(90), 999]], "id bigint")
    assert rows(G.eccentricities(spark.createDataFrame(tree, "src bigint, dst bigint"), listed)) == plain_eccentricities(tree, [999])


def test_searches_leave_the_leaves_out(spark, monkeypatch):
    seen, search = [], G._search_far
    monkeypatch.setattr(G, "_search_far", lambda comp, both: seen.append((comp.count(), both.count())) or search(comp, both))
    edges = [(0, b) for b in range(1, 6)] + [(b, 100 * b + i) for b in range(1, 6) for i in range(30)]
    assert rows(G.eccentricities(spark.createDataFrame(edges, "src bigint, dst bigint"))) == plain_eccentricities(edges)
    assert seen == [(6, 10)]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dates_are_matched_once(spark):
    d = spark.createDataFrame([("2020-02-29",), (" 7.1.3\n",), ("20201231",), ("99 Jan. 5",), ("68/Feb/5\u0085",), ("2020 Foo 3",), ("2021-02-30",), ("",), (None,)], "x string")
    out = d.select(D.ymd(F.concat("x", F.lit(""))).cast("string").alias("d"))
    assert [r.d for r in out.collect()] == ["2020-02-29", None, "2020-12-31", "1999-01-05", "2068-02-05", None, None, None, None]
    assert plan_of(out).count("concat(x") <= 1
    t = d.limit(0).union(spark.createDataFrame([("2020-01-02 3:4:5.25",), ("2020-01-02T13:04:05Z",), ("2020-01-02",)], "x string"))
    assert [str(r.d) for r in t.select(F.date_format(D.ymd_hms("x"), "yyyy-MM-dd HH:mm:ss.SS").alias("d")).collect()] == ["2020-01-02 03:04:05.25", "2020-01-02 13:04:05.00", "None"]


def test_digits_of_a_value_stay_one_row(spark):
    values = [1e17, 0.1, -1e17, 0.0, -0.0, 2.0 ** -990, -3.5, 1e300, -1e300, math.nan, math.inf, None]
    d = spark.createDataFrame([(g, v) for g in ("a", "b", None) for v in values], "top string, x double")
    found = S.exact_digits(d, "x", ["top"])
    for r in found.collect():
        total = sum(Fraction(p.total) * Fraction(2) ** (S.DIGIT * p.place) for p in r.digits)
        assert total == sum(map(Fraction, [0.1, 2.0 ** -990, -3.5]))
    assert found.count() == 3 and S.exact_digits(d.where("x = 0"), "x", ["top"]).count() == 0
    assert "lambda" not in plan_of(found)


def test_row_to_names_with_ties_and_copies(spark):
    table = [(1, "p", 1), (1, "p", 1), (1, "p", 1), (2, "q", None), (None, "z", 5)]
    d = spark.createDataFrame(table, "k bigint, a string, b bigint")
    out = R.row_to_names(d, 2, ["k"])
    assert out.columns == ["k", "p", "1"] and rows(out) == sorted([(1, "p", 1), (2, "q", None), (None, "z", 5)], key=repr)
    assert rows(R.row_to_names(d, 1, ["-k"])) == sorted([(1, "p", 1)] * 3 + [(None, "z", 5)], key=repr)
    tied = spark.createDataFrame([(1, f"v{i}", i) for i in range(20)], "k bigint, a string, b bigint")
    out = R.row_to_names(tied, 7, ["k"])
    assert out.count() == 13 and out.where(F.col(out.columns[1]) == out.columns[1]).isEmpty()
    assert "Window" not in plan_of(out)  # only the first rows are sorted
    with pytest.raises(ValueError):
        R.row_to_names(d, 6, ["k"])


def test_pairs_share_trips_and_see_their_own_kinds(spark):
    big = 2 ** 60 + 1
    x = spark.createDataFrame([(1, big, True), (1, big + 2, False), (2, None, None), (2, 5, True), (None, 7, True)], "k bigint, v bigint, f boolean")
    y = spark.createDataFrame([(1, 0.5, "a"), (3, None, None), (None, 2.0, "n")], "k bigint, w double, s string")

    def look(a, b):
        return pd.DataFrame({"text": [f"{a.k.tolist()} {sorted(a.v.tolist(), key=repr)} {a.v.dtype} {a.f.dtype} {b.k.tolist()} {b.w.tolist()} {b.s.tolist()}"], "pid": [1]})
    plain = x.groupBy("k").cogroup(y.groupBy("k")).applyInPandas(look, "text string, pid bigint")
    out = P.group_pairs_apply(x, y, ["k"], look, "text string, pid bigint")
    # an empty side has the kinds of its bucket
    cut = lambda d: sorted(r.text for r in d.collect() if "[] " not in r.text)
    assert cut(out) == cut(plain) and out.count() == 4
    assert "__bucket" in plan_of(out)
    nothing = P.group_pairs_apply(x, y, ["k"], lambda a, b: pd.DataFrame({"n": []}).astype("int64"), "n bigint")
    assert nothing.count() == 0
    kinds = P.group_pairs_apply(x, y, ["k"], lambda a, b: pd.DataFrame({"n": [None if b.empty else big]}), "n bigint")
    assert sorted((r.n for r in kinds.collect()), key=repr) == [big, big, big, None] or sorted((str(r.n) for r in kinds.collect())) == sorted([str(big)] * 3 + ["None"])


def test_long_groups_come_in_small_frames(spark):
    n = 3 * P.FRAME_ROWS
    d = spark.range(n).select(F.col("id"), F.lit("a").alias("g"))
    carry = P.Carry(len, lambda a, b: a + b)
    out = P.window_apply(d, ["g"], ["id"], lambda p, s: pd.Series(range(len(p))) + (s or 0), "at", "bigint", carry=carry)
    assert out.where("at <> id").isEmpty() and out.count() == n
    size = P.window_apply(d, ["g"], ["id"], lambda p, s: pd.Series([len(p)] * len(p)), "n", "bigint", carry=carry)
    assert size.agg(F.max("n")).first()[0] < 2 * P.FRAME_ROWS


def test_moving_frames_make_their_rows_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(pages):
        for page in pages:
            made.add(len(page))
            yield page
    d = spark.range(500).mapInPandas(count, "id bigint")
    out = O.moving_frames(d, {"s": ("sum", "id")}, -3, 0, ["id"])
    assert {r.id: r.s for r in out.collect()} == {i: sum(range(max(0, i - 3), i + 1)) for i in range(500)}
    assert made.value == 500
