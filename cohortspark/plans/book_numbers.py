"""Queries: math functions, scales, bins, distributions."""

from pyspark.sql import functions as F

from cohortspark.functions import na as N
from cohortspark.functions import numbers as M
from cohortspark.plans.book_tables import Q_NA, line_na
from cohortspark.plans.registry import query


@query("elementwise_math", """SELECT p_partkey, ROUND(EXP(p_size / 50.0), 6) AS e, ROUND(LN(p_size), 6) AS l, ROUND(LOG10(p_size), 6) AS l10, ROUND(SQRT(p_size), 6) AS r, ROUND(SIN(p_size), 6) AS s, ROUND(ATAN(p_size), 6) AS at,
ROUND(COSH(p_size / 50.0), 6) AS ch, FLOOR(p_retailprice)::BIGINT AS f, CEIL(p_retailprice)::BIGINT AS c, ABS(p_size - 25)::BIGINT AS a, CAST(SIGN(p_size - 25) AS BIGINT) AS sg FROM part""")
def elementwise_math(t):
    s, p = F.col("p_size"), F.col("p_retailprice")
    r = lambda c: F.round(c, 6)
    return t.part.select("p_partkey", r(F.exp(s / 50)).alias("e"), r(F.log(s)).alias("l"), r(F.log10(s)).alias("l10"), r(F.sqrt(s)).alias("r"), r(F.sin(s)).alias("s"), r(F.atan(s)).alias("at"), r(F.cosh(s / 50)).alias("ch"),
                         F.floor(p).alias("f"), F.ceil(p).alias("c"), F.abs(s - 25).cast("bigint").alias("a"), F.signum(s - 25).cast("bigint").alias("sg"))


@query("gamma_family", "SELECT p_partkey, ROUND(lgamma(p_size), 5) AS lg, ROUND(lgamma(p_size + 1) - lgamma(p_size), 5) AS lch FROM part")
def gamma_family(t):
    s = F.col("p_size").cast("double")
    return t.part.select("p_partkey", F.round(M.lgamma(s), 5).alias("lg"), F.round(M.lchoose(s, F.lit(1.0)), 5).alias("lch"))


@query("gamma_values")
def gamma_values(t):
    s = F.col("p_size").cast("double")
    return t.part.select("p_partkey", M.factorial(s).alias("f"), M.choose(s + 2, F.lit(2.0)).alias("c"), M.beta(s, F.lit(2.0)).alias("b"))


@query("rounding_modes", """SELECT p_partkey, round_even(CAST(h AS DECIMAL(18,1)), 0)::DOUBLE AS even, ROUND(CAST(h AS DECIMAL(18,1)), 0)::DOUBLE AS up, TRUNC(h)::DOUBLE AS t FROM (SELECT p_partkey, p_size + 0.5 - 25 AS h FROM part)""")
def rounding_modes(t):
    h = F.col("p_size") + F.lit(0.5) - 25
    return t.part.select("p_partkey", M.r_round(h).alias("even"), M.round_half_up(h).alias("up"), M.trunc(h).cast("double").alias("t"))


@query("significant_digits", """SELECT c_custkey, CASE WHEN c_acctbal = 0 THEN 0.0 ELSE ROUND(round_even(c_acctbal * POWER(10.0, 2 - FLOOR(LOG10(ABS(c_acctbal)))), 0) / POWER(10.0, 2 - FLOOR(LOG10(ABS(c_acctbal)))), 6) END AS s FROM customer""")
def significant_digits(t):
    return t.customer.select("c_custkey", F.round(M.signif("c_acctbal", 3), 6).alias("s"))


@query("round_to_any", "SELECT l_orderkey, FLOOR(l_extendedprice / 250) * 250 AS f, CEIL(l_extendedprice / 250) * 250 AS c, ROUND(l_extendedprice / 250) * 250 AS r FROM lineitem")
def round_to_any(t):
    p = "l_extendedprice"
    dbl = lambda c: c.cast("double")
    return t.lineitem.select("l_orderkey", dbl(M.round_any(p, 250, "floor")).alias("f"), dbl(M.round_any(p, 250, "ceiling")).alias("c"), dbl(M.round_any(p, 250, "half_up")).alias("r"))


@query("clamp_censor", f"SELECT l_orderkey, CASE WHEN q IS NOT NULL THEN LEAST(GREATEST(q, 10), 40) END AS inside, CASE WHEN q BETWEEN 10 AND 40 THEN q END AS kept FROM (SELECT l_orderkey, {Q_NA} AS q FROM lineitem)")
def clamp_censor(t):
    return line_na(t).select("l_orderkey", M.clamp("q", 10.0, 40.0).alias("inside"), M.censor("q", 10, 40).alias("kept"))


@query("discard_range", "SELECT l_returnflag, COUNT(*) AS n FROM lineitem WHERE l_quantity BETWEEN 10 AND 40 GROUP BY 1")
def discard_range(t):
    return M.discard(t.lineitem, "l_quantity", 10, 40).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("na_nan_tests", """SELECT l_linenumber::BIGINT AS k, l_linenumber IN (3, 5) AS na, l_linenumber = 5 AS nan, l_linenumber NOT IN (3, 5, 6) AS finite, COUNT(*) AS n FROM lineitem GROUP BY ALL""")
def na_nan_tests(t):
    k = F.col("l_linenumber")
    x = F.when(k == 5, F.lit(float("nan"))).when(k == 6, F.lit(float("inf"))).when(k != 3, F.col("l_quantity"))
    base = t.lineitem.select(k.cast("bigint").alias("k"), x.alias("x"))
    return base.groupBy("k", N.is_na("x", True).alias("na"), N.is_nan("x").alias("nan"), N.is_finite("x").alias("finite")).agg(F.count(F.lit(1)).alias("n"))


@query("na_omit_rows", "SELECT COUNT(*) AS n FROM lineitem WHERE l_linenumber NOT IN (3, 5)")
def na_omit_rows(t):
    k = F.col("l_linenumber")
    x = F.when(k == 5, F.lit(float("nan"))).when(k != 3, F.col("l_quantity"))
    return N.na_omit(t.lineitem.select(x.alias("x"))).agg(F.count(F.lit(1)).alias("n"))


@query("rescale_groups", """SELECT event_id, ROUND((value - MIN(value) OVER w) / (MAX(value) OVER w - MIN(value) OVER w) * 100, 6) AS s, ROUND(value / MAX(value) OVER (), 6) AS m,
ROUND((value - 50) / MAX(ABS(value - 50)) OVER () * 0.5 + 0.5, 6) AS d FROM events WINDOW w AS (PARTITION BY event_type)""")
def rescale_groups(t):
    out = M.rescale(t.events, "value", "s", (0.0, 100.0), ["event_type"])
    out = M.rescale_mid(M.rescale_max(out, "value", "m"), "value", "d", 50.0)
    return out.select("event_id", *[F.round(c, 6).alias(c) for c in ("s", "m", "d")])


@query("scale_transforms", "SELECT event_id, ROUND(SQRT(value), 6) AS r, ROUND(LN(value / 500 / (1 - value / 500)), 6) AS lg, ROUND(LN(1 + value), 6) AS l1, ROUND(1 / value, 6) AS rc, ROUND(value, 6) AS back, ROUND((POWER(value, 0.5) - 1) / 0.5, 6) AS bc FROM events")
def scale_transforms(t):
    v = F.col("value")
    return t.events.select("event_id", F.round(M.transform_scale(v, "sqrt"), 6).alias("r"), F.round(M.transform_scale(v / 500, "logit"), 6).alias("lg"), F.round(M.transform_scale(v, "log1p"), 6).alias("l1"),
                           F.round(M.transform_scale(v, "reciprocal"), 6).alias("rc"), F.round(M.transform_scale(M.transform_scale(v, "log10"), "log10", True), 6).alias("back"), F.round(M.boxcox(v, 0.5), 6).alias("bc"))


@query("bins_by_breaks", "SELECT CASE WHEN l_quantity < 10 THEN 1 WHEN l_quantity < 25 THEN 2 ELSE 3 END::BIGINT AS bin, COUNT(*) AS n FROM lineitem GROUP BY 1")
def bins_by_breaks(t):
    return t.lineitem.groupBy(M.bin("l_quantity", [0, 10, 25, 50]).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("bins_by_quantile", """SELECT bin::BIGINT AS bin, COUNT(*) AS n FROM (SELECT CASE WHEN value < a THEN 1 WHEN value < b THEN 2 WHEN value < c THEN 3 ELSE 4 END AS bin FROM events,
(SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.5) AS b, quantile_cont(value, 0.75) AS c FROM events)) GROUP BY 1""")
def bins_by_quantile(t):
    return M.quantile_bin(t.events, "value", 4, "bin").groupBy(F.col("bin").cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("bit_operations", "SELECT l_partkey, l_partkey & 12 AS a, l_partkey | 3 AS o, xor(l_partkey, 5) AS x, ~l_partkey AS n, l_partkey << 2 AS l, l_partkey >> 1 AS r FROM lineitem")
def bit_operations(t):
    k = F.col("l_partkey")
    return t.lineitem.select("l_partkey", k.bitwiseAND(12).alias("a"), k.bitwiseOR(3).alias("o"), k.bitwiseXOR(5).alias("x"), F.bitwise_not(k).alias("n"), F.shiftleft(k, 2).alias("l"), F.shiftright(k, 1).alias("r"))


@query("normal_distribution")
def normal_distribution(t):
    z = (F.col("value") - 50) / 50
    return t.events.select("event_id", F.round(M.norm_cdf(z), 8).alias("p"), F.round(M.norm_density("value", 50.0, 50.0), 8).alias("d"), F.round(M.norm_quantile(M.norm_cdf(z)), 4).alias("back"))


@query("other_distributions", "SELECT event_id, ROUND(1 - EXP(-value / 50), 8) AS e, ROUND(LEAST(GREATEST(value / 100, 0), 1), 8) AS u FROM events")
def other_distributions(t):
    return t.events.select("event_id", F.round(M.exp_cdf("value", 1 / 50), 8).alias("e"), F.round(M.unif_cdf("value", 0.0, 100.0), 8).alias("u"))


@query("distribution_families")
def distribution_families(t):
    v = F.col("value") / 50
    r = lambda c: F.round(c, 6)
    return t.events.select("event_id", r(M.dist_cdf(v, "chisq", 3)).alias("chisq"), r(M.dist_cdf(v, "t", 5)).alias("t"), r(M.dist_cdf(v, "f", 2, 9)).alias("f"),
                           r(M.dist_cdf(v, "gamma", 2, 1)).alias("gamma"), r(M.dist_quantile(M.dist_cdf(v, "gamma", 2, 1), "gamma", 2, 1)).alias("back"))


@query("random_columns")
def random_columns(t):
    return t.customer.select("c_custkey", M.rbernoulli(0.3, 1).alias("b"), M.rdunif(1, 6, 2).alias("d"), M.rnorm(10.0, 2.0, 3).alias("z"))


@query("centroids", """SELECT label::BIGINT AS label, i::BIGINT AS pair, ROUND(AVG(embedding[2 * i + 1]::DOUBLE), 6) AS x, ROUND(AVG(embedding[2 * i + 2]::DOUBLE), 6) AS y
FROM embeddings, range(0, 32) r(i) GROUP BY 1, 2""")
def centroids(t):
    pair = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(31).cast("bigint"))).alias("pair")
    at = lambda k: F.get("embedding", (2 * F.col("pair") + k).cast("int")).cast("double")
    pts = t.embeddings.select(F.col("label").cast("bigint").alias("label"), "embedding", pair).select("label", "pair", at(0).alias("x"), at(1).alias("y"))
    out = M.centroid(pts, "x", "y", ["label", "pair"])
    return out.withColumns({c: F.round(c, 6) for c in ("x", "y")})
