"""Queries that have no SQL: checked against plain Python on small or whole tables."""

import math
import textwrap

import pytest
from pyspark.sql import functions as F

from cohortspark.functions import na as N
from cohortspark.functions import numbers as M
from cohortspark.functions import strings as S
from cohortspark.operators import verbs as V
from cohortspark.plans import assessment as A
from conftest import rows


def test_wrapped_text(spark):
    text = "Twas brillig, and the slithy toves did gyre and gimble in the wabe: all mimsy were the borogoves"
    got = spark.range(1).select(S.str_wrap(F.lit(text), 40)).first()[0]
    assert got == textwrap.fill(text, 40) and max(map(len, got.split("\n"))) <= 40


def test_locale_order(spark):
    d = spark.createDataFrame([("y",), ("i",), ("k",), ("y",)], "s string")
    assert dict(rows(V.str_order(d, "s", "r", "lt"))) == {"i": 1, "y": 2, "k": 3}
    assert dict(rows(V.str_order(d, "s", "r", "en"))) == {"i": 1, "k": 2, "y": 3}


def test_approximate_distinct_is_close(spark):
    got = spark.range(20000).agg(N.n_distinct("id", approx=True)).first()[0]
    assert got == pytest.approx(20000, rel=0.15)


def test_weighted_sample_prefers_weight(spark):
    d = spark.range(1000).withColumn("w", F.when(F.col("id") < 100, 1000.0).otherwise(0.001))
    drawn = [r.id for r in V.sample_n(d, 50, weight="w", seed=2).collect()]
    assert len(set(drawn)) == 50 and sum(i < 100 for i in drawn) >= 48


def test_random_columns_have_their_range(spark):
    r = spark.range(5000).select(M.rbernoulli(0.3, 1).alias("b"), M.rdunif(1, 6, 2).alias("d"), M.rnorm(10.0, 2.0, 3).alias("z"))
    b, lo, hi, m = r.agg(F.avg(F.col("b").cast("int")), F.min("d"), F.max("d"), F.avg("z")).first()
    assert b == pytest.approx(0.3, abs=0.04) and (lo, hi) == (1, 6) and m == pytest.approx(10, abs=0.2)


def test_cohort_targets_follow_the_normal(spark):
    pairs = spark.createDataFrame([("s", "R", 3, "Fall", "Spring", 100.0, 108.0), ("s", "R", 3, "Fall", "Spring", 110.0, 112.0)],
                                  "school string, subject string, start_grade int, start_season string, end_season string, start_score double, end_score double")
    norms = spark.createDataFrame([("R", 3, "Fall", "Spring", 105, 6.0, 2.0)], "subject string, grade int, start_season string, end_season string, start_mean int, expected_growth double, sd_growth double")
    got = {r.cgp: r.target_mean for r in A.cohort_targets(pairs, norms, ["school"], [50, 84.134474606854]).collect()}
    assert got[50.0] == pytest.approx(111.0) and got[84.134474606854] == pytest.approx(113.0, abs=1e-6)
    assert A.cohort_growth_percentile(pairs, norms, ["school"]).first()["z"] == pytest.approx(-0.5)


def test_goal_rows(spark):
    scores = spark.createDataFrame([(1, "R", 3, "Fall", 2010, 100.0, 20)], "student_id bigint, subject string, grade int, season string, academic_year int, score double, percentile int")
    norms = spark.createDataFrame([("R", 3, "Fall", "Spring", 100, 10.0, 2.0)], "subject string, grade int, start_season string, end_season string, start_score int, expected_growth double, sd_growth double")
    factors = spark.createDataFrame([(1, "lower", 1.5)], "quartile int, band string, factor double")
    link = spark.createDataFrame([("R", 115, 18), ("R", 110, 17)], "subject string, score int, linked int")
    got = A.student_goal_rows(scores, link, norms, factors).first()
    assert (got.typical_goal, got.goal, got.linked) == (110.0, 115.0, 18)


def test_distribution_functions_of_large_parameters(spark):
    at = lambda x, family, *par: spark.range(1).select(M.dist_cdf(F.lit(float(x)), family, *par)).first()[0]
    # the middle of a wide distribution: one half, plus what the skewness adds
    for n in (2e5, 2e6):
        assert abs(at(n, "chisq", n) - 0.5 - math.sqrt(8 / n) / (6 * math.sqrt(2 * math.pi))) < 1e-6
    assert abs(at(1e6, "pois", 1e6) - 0.5) < 5e-4 and abs(at(5e5, "binom", 10**6, .5) - 0.5) < 5e-4
    assert abs(at(0.5, "beta", 4e5, 4e5) - 0.5) < 1e-8
    assert abs(at(3.0, "chisq", 2) - (1 - math.exp(-1.5))) < 1e-14 and at(0.0, "gamma", 2.0, 1.0) == 0.0
    assert abs(at(2.0, "t", 1) - (0.5 + math.atan(2.0) / math.pi)) < 1e-13


def test_weights_of_zero_and_below(spark):
    d = spark.createDataFrame([(1, 0.0), (2, None), (3, 1.0), (4, 5.0)], "id int, w double")
    assert sorted(r.id for r in V.sample_n(d, 4, weight="w").collect()) == [3, 4]
    with pytest.raises(Exception, match="negative weight"):
        V.sample_n(d.unionByName(spark.createDataFrame([(5, -1.0)], d.schema)), 4, weight="w").collect()


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from cohortspark import session
    conf = SimpleNamespace(get=lambda key, default=None: default, set=lambda *_: None)
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(RuntimeError):
            session.shared_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))


def test_normal_and_gamma_functions_as_columns(spark):
    from statistics import NormalDist
    zs = [-38.0, -9.0, -4.5, -4.0, -3.99, -1.0, -1e-9, 0.0, 0.3, 2.5, 4.2, 8.0]
    ps = [1e-300, 1e-12, 1e-4, .02, .07, .075, .3, .5, .9, .925, .9999]
    xs = [-3.5, -2.5, -.5, 1e-5, .3, .5, 1.0, 1.5, 7.0, 20.0, 171.5, 1e6]
    value = lambda f, v: [r[0] for r in spark.createDataFrame([(float(x),) for x in v], "v double").coalesce(1).select(f("v")).collect()]
    n = NormalDist()
    assert value(M.norm_cdf, zs) == pytest.approx([n.cdf(z) if z > -5 else math.erfc(-z / 2 ** .5) / 2 for z in zs], rel=1e-9, abs=1e-320)
    assert value(M.norm_quantile, ps) == pytest.approx([n.inv_cdf(p) for p in ps], rel=1e-12, abs=1e-15)
    assert value(M.norm_quantile, [0, 1]) == [-math.inf, math.inf] and math.isnan(value(M.norm_quantile, [2])[0])
    assert value(M.lgamma, xs) == pytest.approx([math.lgamma(x) for x in xs], rel=1e-11, abs=1e-12)
    assert value(M.lgamma, [0, -2]) == [math.inf, math.inf] and math.isnan(value(M.gamma, [-1])[0])
    assert value(M.gamma, xs[:-2]) == pytest.approx([math.gamma(x) for x in xs[:-2]], rel=1e-10)
    assert value(M.factorial, [0, 1, 5, 20, 170]) == pytest.approx([float(math.factorial(k)) for k in (0, 1, 5, 20, 170)], rel=1e-13)
    assert spark.range(1).select(M.norm_cdf(F.lit(None).cast("double")), M.gamma(F.lit(None).cast("double")), M.norm_quantile(F.lit(None).cast("double"))).first() == (None, None, None)


def test_wrap_keeps_long_words_and_empty_texts(spark):
    d = spark.createDataFrame([("",), (None,), ("  a  b\nc ",), ("x" * 9 + " yy",)], "t string").coalesce(1)
    assert [r[0] for r in d.select(S.str_wrap("t", 5, 2, 1)).collect()] == ["", None, "  a b\n c", "  " + "x" * 9 + "\n yy"]
