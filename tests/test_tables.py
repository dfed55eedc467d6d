"""Verbs, joins, aggregates and cross tables on small worked inputs."""

import math

import pytest
from pyspark.sql import functions as F

from cohortspark.functions import na as N
from cohortspark.operators import agg as G
from cohortspark.operators import joins as J
from cohortspark.operators import ordered as O
from cohortspark.operators import tabyl as X
from cohortspark.operators import verbs as V
from conftest import rows

NAN = float("nan")


@pytest.fixture(scope="module")
def ab(spark):
    return (spark.createDataFrame([(1.0, 2), (2.0, 1)], "x double, y int"), spark.createDataFrame([(1.0, 10.0, "a"), (3.0, 10.0, "a")], "x double, a double, b string"))


def test_mutating_joins(ab):
    a, b = ab
    assert rows(J.inner_join(a, b)) == [(1.0, 2, 10.0, "a")]
    assert rows(J.left_join(a, b)) == [(1.0, 2, 10.0, "a"), (2.0, 1, None, None)]
    assert rows(J.right_join(a, b)) == [(1.0, 2, 10.0, "a"), (3.0, None, 10.0, "a")]
    assert rows(J.full_join(a, b)) == [(1.0, 2, 10.0, "a"), (2.0, 1, None, None), (3.0, None, 10.0, "a")]


def test_duplicate_keys_multiply(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "x int, y int")
    b = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "x int, z string")
    assert J.left_join(a, b).count() == 5


def test_filtering_joins(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (3, 3), (4, 4)], "x int, y int")
    b = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "x int, z string")
    assert J.inner_join(a, b).count() == 4
    assert J.semi_join(a, b).count() == 2
    assert rows(J.anti_join(a, b)) == [(3, 3), (4, 4)]


def test_na_matches(spark):
    a = spark.createDataFrame([(None, 1), (NAN, 2), (1.0, 3)], "x double, y int")
    b = spark.createDataFrame([(None, "n"), (NAN, "nan")], "x double, z string")
    assert [r[1:] for r in rows(J.inner_join(a, b))] == [(2, "nan"), (1, "n")] or {r[1:] for r in rows(J.inner_join(a, b))} == {(1, "n"), (2, "nan")}
    assert J.inner_join(a, b, na_matches="never").count() == 0
    assert J.anti_join(a, b).count() == 1 and J.anti_join(a, b, na_matches="never").count() == 3


def test_suffixes_and_named_keys(spark):
    a = spark.createDataFrame([(1, "l")], "k int, v string")
    b = spark.createDataFrame([(1, "r")], "key int, v string")
    out = J.left_join(a, b, {"k": "key"})
    assert out.columns == ["k", "v.x", "v.y"] and rows(out) == [(1, "l", "r")]
    with pytest.raises(ValueError):
        J.inner_join(a.select("k"), b)


def test_within_join_long_and_short_intervals(spark):
    iv = spark.createDataFrame([(1, "2020-01-01", "2030-01-01"), (2, "2020-01-05", "2020-01-05"), (3, "2020-01-01", "2020-01-06")], "i int, a string, b string")
    iv = iv.select("i", F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b"))
    p = spark.createDataFrame([("2020-01-05",), ("2020-01-06",), ("2029-12-31",), ("2031-01-01",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    closed = J.within_join(p, iv, "t", "a", "b")
    assert sorted((str(r.t)[:10], r.i) for r in closed.collect()) == [("2020-01-05", 1), ("2020-01-05", 2), ("2020-01-05", 3), ("2020-01-06", 1), ("2020-01-06", 3), ("2029-12-31", 1)]
    assert J.within_join(p, iv, "t", "a", "b", bounds="[)").count() == 4


def test_overlap_join_matches_brute_force(spark):
    mk = lambda n, s, c: spark.range(n).select(F.col("id").alias(c + "i"), (F.col("id") % 2).alias("k"), F.timestamp_seconds(F.abs(F.xxhash64("id", F.lit(s))) % 5000).alias(c + "a")).withColumn(
        c + "b", F.timestamp_seconds(F.unix_timestamp(c + "a") + F.abs(F.xxhash64(c + "i", F.lit(s + 9))) % 700))
    x, y = mk(60, 1, "x"), mk(50, 2, "y")
    for bounds, test in (("[]", lambda p, q: p[0] <= q[1] and q[0] <= p[1]), ("[)", lambda p, q: p[0] < q[1] and q[0] < p[1])):
        want = sorted((a.xi, b.yi) for a in x.collect() for b in y.collect() if a.k == b.k and test((a.xa, a.xb), (b.ya, b.yb)))
        got = J.overlap_join(x, y, ("xa", "ya"), ("xb", "yb"), ["k"], bounds)
        assert sorted((r.xi, r.yi) for r in got.collect()) == want and want


def test_interval_algebra(spark):
    x = spark.createDataFrame([(1, 0, 10), (1, 5, 20), (2, 0, 3)], "k int, start int, end int")
    y = spark.createDataFrame([(1, 8, 12), (3, 0, 1)], "k int, start int, end int")
    assert rows(J.interval_setdiff(x, y, ["k"])) == [(1, 0, 8), (1, 12, 20), (2, 0, 3)]
    assert rows(J.interval_intersect(x, y, ["k"])) == [(1, 8, 12)]
    assert rows(J.interval_union(x, y, ["k"])) == [(1, 0, 20), (2, 0, 3), (3, 0, 1)]
    assert rows(J.interval_intersects(x, y, ["k"])) == [(1,)]
    assert rows(J.interval_contained(y, x, ["k"])) == [(1,)]


def test_set_operations(spark):
    a = spark.createDataFrame([(1, 1), (2, 1)], "x int, y int")
    b = spark.createDataFrame([(1, 1), (2, 2)], "x int, y int")
    assert rows(V.intersect(a, b)) == [(1, 1)]
    assert V.union(a, b).count() == 3
    assert rows(V.setdiff(a, b)) == [(2, 1)] and rows(V.setdiff(b, a)) == [(2, 2)]
    assert V.union_all(a, b).count() == 4
    assert rows(V.bind_rows([a, b.select("x")], "src")) == [("1", 1, 1), ("1", 2, 1), ("2", 1, None), ("2", 2, None)]


def test_rank_example(spark):
    x = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 2), (5, 2)], "i int, x int")
    out = O.ranks(x, "x", min_rank="m", dense_rank="d", cume_dist="c", percent_rank="p", avg_rank="a")
    assert [r[2:] for r in rows(out, "i")] == [(1, 1, 0.4, 0.0, 1.5)] * 2 + [(3, 2, 1.0, 0.5, 4.0)] * 3


def test_offsets_and_running_sum_need_an_order(spark):
    x = spark.createDataFrame([(3, 3), (1, 1), (5, 5), (2, 2), (4, 4)], "i int, x int")
    assert [r[2] for r in rows(O.lag(x, "x", "l", ["i"]), "i")] == [None, 1, 2, 3, 4]
    assert [r[2] for r in rows(O.lead(x, "x", "l", ["i"]), "i")] == [2, 3, 4, 5, None]
    running = spark.createDataFrame([(y, float((y - 2000) ** 2)) for y in (2003, 2000, 2005, 2001, 2004, 2002)], "year int, value double")
    assert [r[2] for r in rows(O.cumulate(running, "value", "sum", "c", ["year"]), "year")] == [0.0, 1.0, 5.0, 14.0, 30.0, 55.0]


def test_arrange_puts_missing_last_both_ways(spark):
    x = spark.createDataFrame([(1.0,), (None,), (NAN,), (3.0,)], "x double")
    show = lambda df: ["NaN" if v[0] is not None and math.isnan(v[0]) else v[0] for v in df.collect()]
    assert show(V.arrange(x, "x")) == [1.0, 3.0, None, "NaN"]
    assert show(V.arrange(x, "-x")) == [3.0, 1.0, None, "NaN"]


@pytest.fixture(scope="module")
def na_table(spark):
    return spark.createDataFrame([("full", 1.0), ("full", 3.0), ("na", 1.0), ("na", None), ("nan", 2.0), ("nan", NAN), ("none", None), ("one", 5.0)], "g string, x double")


def test_na_rules_of_aggregates(na_table):
    clean = lambda v: "NaN" if isinstance(v, float) and math.isnan(v) else v
    out = na_table.groupBy("g").agg(N.r_sum("x"), N.r_sum("x", True), N.r_mean("x"), N.r_mean("x", True), N.r_min("x"), N.r_min("x", True), N.r_max("x", True),
                                    N.r_var("x"), N.r_var("x", True), N.n_distinct("x"), N.n_distinct("x", na_rm=True))
    got = {r[0]: tuple(clean(v) for v in r[1:]) for r in out.collect()}
    assert got["full"] == (4.0, 4.0, 2.0, 2.0, 1.0, 1.0, 3.0, 2.0, 2.0, 2, 2)
    assert got["na"] == (None, 1.0, None, 1.0, None, 1.0, 1.0, None, None, 2, 1)
    assert got["nan"] == ("NaN", 2.0, "NaN", 2.0, None, 2.0, 2.0, "NaN", None, 2, 2)
    assert got["none"] == (None, 0.0, None, "NaN", None, math.inf, -math.inf, None, None, 1, 0)
    assert got["one"][7] is None and got["one"][0] == 5.0


def test_aggregates_of_no_rows(spark):
    empty = spark.createDataFrame([], "x double, b boolean")
    s, m, lo, hi, a, e = empty.agg(N.r_sum("x"), N.r_mean("x"), N.r_min("x"), N.r_max("x"), N.r_any("b"), N.r_all("b")).first()
    assert s == 0 and math.isnan(m) and lo == math.inf and hi == -math.inf and a is False and e is True


def test_membership_and_conditions(spark):
    x = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    assert [r[0] for r in x.select(V.is_in("x", [1, 2])).collect()] == [True, False, False]
    assert [r[0] for r in x.select(V.if_else(F.col("x") > 2, F.lit("y"), F.lit("n"), F.lit("?"))).collect()] == ["n", "?", "y"]
    assert [r[0] for r in x.select(V.recode("x", {1: 10}, missing=0)).collect()] == [10, 0, 3]


def test_selection_helpers(spark):
    d = spark.createDataFrame([(1, 2, 3, 4)], "a int, b1 int, b2 int, c int")
    assert V.resolve(d, "a:b2", "-b1") == ["a", "b2"]
    assert V.resolve(d, "-a") == ["b1", "b2", "c"]
    assert V.resolve(d, V.num_range("b", [2, 1])) == ["b2", "b1"]
    assert V.resolve(d, V.starts_with("B"), V.last_col()) == ["b1", "b2", "c"]
    with pytest.raises(KeyError):
        V.resolve(d, "zz")


def test_repair_names():
    assert V.repair_names(["a", "a", "", "", "a_1"]) == ["a", "a_1", "x", "x_1", "a_1_1"]


def test_keyed_edits(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    change = spark.createDataFrame([(2, "B"), (9, "z")], "id int, v string")
    assert rows(V.upsert_rows(base, change, "id")) == [(1, "a"), (2, "B"), (9, "z")]
    with pytest.raises(KeyError):
        V.upsert_rows(base, change, "id", insert=False)
    assert rows(V.append_with_id(base, spark.createDataFrame([("x",), ("y",)], "v string"), "id", ["v"])) == [(1, "a"), (2, "b"), (3, "x"), (4, "y")]
    with pytest.raises(KeyError):
        V.lookup(base, "id", 7)
    cars = spark.createDataFrame([("vw", None, 0)], "make string, model string, year int")
    assert V.validate_required(cars, ["make", "model", "year"]).first()["errors"] == ["model", "year"]


def test_sample_sizes(spark):
    d = spark.range(100).withColumn("g", F.col("id") % 2)
    assert rows(V.sample_n(d, 7, ["g"], seed=1).groupBy("g").count()) == [(0, 7), (1, 7)]
    drawn = V.sample_n(d, 300, ["g"], seed=1, replace=True)
    assert rows(drawn.groupBy("g").count()) == [(0, 300), (1, 300)]


def test_tabyl_example(spark):
    x = spark.createDataFrame([("big",), ("big",), ("small",), ("small",), ("small",), (None,)], "x string")
    got = {r["x"]: (r["n"], round(r["percent"], 4), r["valid_percent"]) for r in X.tabyl(x, "x").collect()}
    assert got == {"big": (2, 0.3333, 0.4), "small": (3, 0.5, 0.6), None: (1, 0.1667, None)}
    assert X.tabyl(x, "x", show_na=False).count() == 2


def test_adorned_table(spark):
    d = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", "x"), ("b", None)], "r string, c string")
    t = X.tabyl(d, "r", "c")
    assert t.columns == ["r", "x", "y", "NA_"] and rows(t) == [("a", 1, 2, 0), ("b", 1, 0, 1)]
    text = X.adorn_ns(X.adorn_pct_formatting(X.adorn_percentages(t)), t)
    assert rows(text) == [("a", "33.3% (1)", "66.7% (2)", "0.0% (0)"), ("b", "50.0% (1)", "0.0% (0)", "50.0% (1)")]
    assert ("Total", 2, 2, 1, 5) in rows(X.adorn_totals(t, ("row", "col")))


def test_rounding_of_percent_text(spark):
    d = spark.createDataFrame([("a", 0.125)], "r string, p double")
    assert X.adorn_pct_formatting(d, 0).first()["p"] == "12%" and X.adorn_pct_formatting(d, 0, "half up").first()["p"] == "13%"


def test_top_levels_example(spark):
    f = ["strongly agree", "agree", "neutral", "neutral", "disagree", "strongly agree"]
    levels = ["strongly agree", "agree", "neutral", "disagree", "strongly disagree"]
    d = spark.createDataFrame([(v,) for v in f], "f string")
    assert rows(X.top_levels(d, "f", levels).select("f", "n")) == [("disagree, strongly disagree", 1), ("neutral", 2), ("strongly agree, agree", 3)]
    assert rows(X.top_levels(d, "f", levels, 1).select("f", "n")) == [("agree, neutral, disagree", 4), ("strongly agree", 2), ("strongly disagree", 0)]
    with pytest.raises(ValueError):
        X.top_levels(d, "f", levels, 3)


def test_all_equal_reasons(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "i int, s string")
    assert G.all_equal(a, a.select("s", "i")).first()["equal"] is True
    assert "types" in G.all_equal(a, a.withColumn("i", F.col("i").cast("bigint"))).first()["reason"]
    assert "columns" in G.all_equal(a, a.select("i")).first()["reason"]
    assert G.all_equal(a, a.distinct()).first()["reason"] == "1 rows only in x, 0 rows only in y"


def test_nth_with_default_and_dupes(spark):
    d = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "g string, x int")
    assert rows(G.nth(d, "x", 2, ["x"], ["g"], default=0)) == [("a", 2), ("b", 0)]
    assert rows(G.last(d, "x", ["x"], ["g"])) == [("a", 2), ("b", 3)]
    assert rows(G.get_dupes(d, "g")) == [("a", 1, 2), ("a", 2, 2)]


def test_metamorphic_counts(spark):
    a = spark.range(50).select((F.col("id") % 20).alias("k"), F.col("id").alias("v"))
    b = spark.range(30).select((F.col("id") % 15 + 10).alias("k")).distinct()
    assert J.inner_join(a, b).count() + J.anti_join(a, b).count() == J.left_join(a, b).count() == 50
    assert J.semi_join(a, b).count() + J.anti_join(a, b).count() == 50


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_joins_with_hot_keys_give_the_same_rows(spark, how):
    from cohortspark.session import HOT_ROWS_CONF
    x = spark.range(120).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 30).alias("k"), F.col("id").alias("a"))
    y = spark.range(90).select(F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("b"))
    join = {"inner": J.inner_join, "left": J.left_join, "right": J.right_join, "full": J.full_join}[how]
    for matches in ("na", "never"):
        plain = rows(join(x, y, na_matches=matches))
        spark.conf.set(HOT_ROWS_CONF, "10")
        split = rows(join(x, y, na_matches=matches))
        semi, anti = rows(J.semi_join(x, y, na_matches=matches)), rows(J.anti_join(x, y, na_matches=matches))
        spark.conf.unset(HOT_ROWS_CONF)
        assert plain == split
        assert semi == rows(J.semi_join(x, y, na_matches=matches)) and anti == rows(J.anti_join(x, y, na_matches=matches))


def test_large_first_rows_and_exact_fraction(spark):
    d = spark.range(3000).withColumn("g", F.col("id") % 2)
    assert rows(V.first_rows(d, 1200, ["id"], ["g"]).groupBy("g").count()) == [(0, 1200), (1, 1200)]
    assert V.top_n(d, 1100, "id").count() == 1100
    assert rows(V.sample_frac(d, 0.25, ["g"]).groupBy("g").count()) == [(0, 375), (1, 375)]


@pytest.mark.parametrize("hot", [False, True])
def test_draws_with_replacement(spark, hot):
    from cohortspark.session import HOT_ROWS_CONF

    d = spark.createDataFrame([(g, i, w) for g in ("a", "b", None) for i, w in enumerate([1.0, 3.0, 0.0, None, 6.0] + [0.0] * 60)], "g string, i int, w double")
    if hot:
        spark.conf.set(HOT_ROWS_CONF, "40")
    try:
        got = V.sample_n(d, 25_000, ["g"], weight="w", seed=5, replace=True)
        assert got.columns == d.columns
        counts = {(r.g, r.i): r["count"] for r in got.groupBy("g", "i").count().collect()}
        equal = {r.i: r["count"] for r in V.sample_n(d.where("i < 5"), 20_000, seed=6, replace=True).groupBy("i").count().collect()}
    finally:
        spark.conf.unset(HOT_ROWS_CONF)
    for g in ("a", "b", None):
        assert {i for h, i in counts if h == g} == {0, 1, 4} and sum(n for (h, _), n in counts.items() if h == g) == 25_000
        assert all(abs(counts[g, i] / 25_000 - p) < .015 for i, p in ((0, .1), (1, .3), (4, .6)))
    assert sum(equal.values()) == 20_000 and all(abs(n / 20_000 - .2) < .015 for n in equal.values())
    assert V.sample_n(d, 0, ["g"], replace=True).count() == 0 and V.sample_n(d.limit(0), 3, replace=True).count() == 0
    with pytest.raises(Exception, match="negative"):
        V.sample_n(d.withColumn("w", F.lit(-1.0)), 3, weight="w", replace=True).collect()
