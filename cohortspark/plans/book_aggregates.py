"""Queries: grouping, aggregation, cross tables."""

import pandas as pd
from pyspark.sql import functions as F

from cohortspark.functions import na as N
from cohortspark.operators import agg as G
from cohortspark.operators import apply as P
from cohortspark.operators import ordered as O
from cohortspark.operators import reshape as R
from cohortspark.operators import states as S
from cohortspark.operators import tabyl as X
from cohortspark.operators import verbs as V
from cohortspark.plans.book_tables import LINE, Q_NA, line_na
from cohortspark.plans.registry import query

_NA = f"(SELECT *, {Q_NA} AS q FROM lineitem)"


@query("group_by_summarise", """SELECT l_returnflag, COUNT(*) AS n, SUM(l_quantity) AS qty, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
FROM lineitem GROUP BY 1""")
def group_by_summarise(t):
    g = G.group_by(t.lineitem, "l_returnflag", "l_linestatus").summarise(
        n=F.count(F.lit(1)), qty=F.sum("l_quantity"), price=F.sum(F.col("l_extendedprice").cast("decimal(18,2)")))
    # the last grouping level was dropped, so the next summary is per return flag
    return g.summarise(n=F.sum("n"), qty=F.sum("qty"), price=F.sum("price").cast("double")).df


@query("group_by_expression", "SELECT year(o_orderdate)::BIGINT AS yr, COUNT(*) AS n FROM orders GROUP BY 1")
def group_by_expression(t):
    return G.group_by(t.orders, yr=F.year("o_orderdate").cast("bigint")).group_size()


@query("group_by_if_string", "SELECT COUNT(DISTINCT (c_name, c_mktsegment)) AS n_groups FROM customer")
def group_by_if_string(t):
    return G.group_by_if(t.customer, V.is_string).n_groups()


@query("summarise_at_columns", """SELECT l_linestatus, MIN(l_quantity) AS l_quantity_lo, MAX(l_quantity) AS l_quantity_hi,
MIN(l_discount) AS l_discount_lo, MAX(l_discount) AS l_discount_hi FROM lineitem GROUP BY 1""")
def summarise_at_columns(t):
    return G.summarise_at(t.lineitem, ["l_linestatus"], ["l_quantity", "l_discount"], lo=F.min, hi=F.max)


@query("count_weighted_sorted", "SELECT l_returnflag, SUM(l_quantity) AS n FROM lineitem GROUP BY 1")
def count_weighted_sorted(t):
    return G.count(t.lineitem, "l_returnflag", wt="l_quantity", sort=True)


@query("add_count_rows", "SELECT o_orderkey, COUNT(*) OVER (PARTITION BY o_custkey) AS n FROM orders")
def add_count_rows(t):
    return G.add_count(t.orders, "o_custkey").select("o_orderkey", "n")


_BOTH = "CASE WHEN COUNT(q) = COUNT(*) THEN {0} END AS strict, {1} AS skipped"


@query("sum_na_rules", f"SELECT l_linenumber::BIGINT AS k, {_BOTH.format('SUM(q)', 'COALESCE(SUM(q), 0)')} FROM {_NA} GROUP BY 1")
def sum_na_rules(t):
    return line_na(t).groupBy(F.col("l_linenumber").cast("bigint").alias("k")).agg(N.r_sum("q").alias("strict"), N.r_sum("q", True).alias("skipped"))


@query("mean_na_rules", f"""SELECT l_linenumber::BIGINT AS k, {_BOTH.format('ROUND(AVG(q), 6)', "COALESCE(ROUND(AVG(q), 6), CAST('NaN' AS DOUBLE))")} FROM {_NA} GROUP BY 1""")
def mean_na_rules(t):
    return line_na(t).groupBy(F.col("l_linenumber").cast("bigint").alias("k")).agg(
        F.round(N.r_mean("q"), 6).alias("strict"), N.r_mean("q", True).alias("m")).select(
        "k", "strict", F.when(F.isnan("m"), F.col("m")).otherwise(F.round("m", 6)).alias("skipped"))


@query("var_sd_na_rules", f"""SELECT l_returnflag, CASE WHEN COUNT(q) = COUNT(*) THEN CAST(1 AS DOUBLE) END AS strict, ROUND(VAR_SAMP(q), 6) AS var, ROUND(STDDEV_SAMP(q), 6) AS sd
FROM {_NA} GROUP BY 1""")
def var_sd_na_rules(t):
    return line_na(t).groupBy("l_returnflag").agg(N.r_var("q").alias("strict"), F.round(N.r_var("q", True), 6).alias("var"), F.round(N.r_sd("q", True), 6).alias("sd"))


@query("min_max_na_rules", f"""SELECT l_linenumber::BIGINT AS k, CASE WHEN COUNT(q) = COUNT(*) THEN MIN(q) END AS lo, CASE WHEN COUNT(q) = COUNT(*) THEN MAX(q) END AS hi,
COALESCE(MIN(q), CAST('inf' AS DOUBLE)) AS lo_known, COALESCE(MAX(q), CAST('-inf' AS DOUBLE)) AS hi_known FROM {_NA} GROUP BY 1""")
def min_max_na_rules(t):
    return line_na(t).groupBy(F.col("l_linenumber").cast("bigint").alias("k")).agg(
        N.r_min("q").alias("lo"), N.r_max("q").alias("hi"), N.r_min("q", True).alias("lo_known"), N.r_max("q", True).alias("hi_known"))


@query("n_distinct_tuples", f"""SELECT l_returnflag, COUNT(DISTINCT (q, l_linestatus)) AS pairs, COUNT(DISTINCT CASE WHEN q IS NOT NULL THEN (q, l_linestatus) END) AS known
FROM {_NA} GROUP BY 1""")
def n_distinct_tuples(t):
    return line_na(t).groupBy("l_returnflag").agg(N.n_distinct("q", "l_linestatus").alias("pairs"), N.n_distinct("q", "l_linestatus", na_rm=True).alias("known"))


@query("n_distinct_approx")
def n_distinct_approx(t):
    return t.lineitem.groupBy("l_returnflag").agg(N.n_distinct("l_partkey", "l_suppkey", approx=True).alias("pairs"))


@query("first_last_nth", """SELECT o_custkey, MAX(CASE WHEN a = 1 THEN o_orderkey END) AS first, MAX(CASE WHEN z = 1 THEN o_orderkey END) AS last,
COALESCE(MAX(CASE WHEN a = 12 THEN o_orderkey END), -1) AS twelfth FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS a,
ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS z FROM orders) GROUP BY 1""")
def first_last_nth(t):
    order, by = ["o_orderdate", "o_orderkey"], ["o_custkey"]
    a = G.first(t.orders, "o_orderkey", order, by)
    z = G.last(t.orders, "o_orderkey", order, by)
    n = G.nth(t.orders, "o_orderkey", 12, order, by, "twelfth", -1)
    return a.join(z, by).join(n, by)


@query("median_quantiles", """SELECT l_returnflag, ROUND(quantile_cont(l_extendedprice, 0.5), 4) AS median, ROUND(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY 1""")
def median_quantiles(t):
    out = O.quantiles(t.lineitem, "l_extendedprice", {"median": 0.5, "p90": 0.9}, ["l_returnflag"])
    return out.select("l_returnflag", F.round("median", 4).alias("median"), F.round("p90", 4).alias("p90"))


@query("any_all_three_valued", f"""SELECT l_linenumber::BIGINT AS k, CASE WHEN COALESCE(BOOL_OR(q > 49), FALSE) THEN TRUE WHEN COUNT(q) < COUNT(*) THEN NULL ELSE FALSE END AS some,
CASE WHEN NOT COALESCE(BOOL_AND(q > 0), TRUE) THEN FALSE WHEN COUNT(q) < COUNT(*) THEN NULL ELSE TRUE END AS every FROM {_NA} GROUP BY 1""")
def any_all_three_valued(t):
    q = F.col("q")
    return line_na(t).groupBy(F.col("l_linenumber").cast("bigint").alias("k")).agg(N.r_any(q > 49).alias("some"), N.r_all(q > 0).alias("every"))


@query("most_frequent_values", """SELECT o_orderpriority, yr, n, share FROM (SELECT *, ROUND(n / SUM(n) OVER (PARTITION BY o_orderpriority), 6) AS share,
ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, yr) AS r FROM (SELECT o_orderpriority, year(o_orderdate)::BIGINT AS yr, COUNT(*) AS n FROM orders GROUP BY 1, 2)) WHERE r <= 2""")
def most_frequent_values(t):
    out = G.most_frequent(t.orders.withColumn("yr", F.year("o_orderdate").cast("bigint")), "yr", ["o_orderpriority"], 2)
    return out.withColumn("share", F.round("share", 6))


@query("group_apply_function", """SELECT user_id, COUNT(*) AS n, ROUND(MAX(value) - MIN(value), 6) AS spread FROM events GROUP BY 1""")
def group_apply_function(t):
    def spread(p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"user_id": [p.user_id.iloc[0]], "n": [len(p)], "lo": [p.value.min()], "hi": [p.value.max()]})

    def merge(p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"user_id": [p.user_id.iloc[0]], "n": [p.n.sum()], "lo": [p.lo.min()], "hi": [p.hi.max()]})
    out = P.group_apply(t.events.select("user_id", "value"), ["user_id"], spread, "user_id bigint, n bigint, lo double, hi double", merge)
    return out.select("user_id", "n", F.round(F.col("hi") - F.col("lo"), 6).alias("spread"))


@query("split_apply_pairs", """SELECT k, n, m FROM (SELECT user_id AS k, COUNT(*) AS n FROM events GROUP BY 1) JOIN (SELECT o_custkey AS k, COUNT(*) AS m FROM orders GROUP BY 1) USING (k)""")
def split_apply_pairs(t):
    def sizes(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"k": [], "n": [], "m": []}).astype("int64")
        return pd.DataFrame({"k": [a.k.iloc[0]], "n": [a.n.sum()], "m": [b.n.sum()]})
    # counted per kind first: a group has one row per event type or order status
    e = t.events.groupBy(F.col("user_id").alias("k"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    o = t.orders.groupBy(F.col("o_custkey").alias("k"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return P.group_pairs_apply(e, o, ["k"], sizes, "k bigint, n bigint, m bigint")


# ------------------------------------------------------------- cross tables

@query("tabyl_one_way", f"""SELECT q, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS percent,
CASE WHEN q IS NOT NULL THEN ROUND(COUNT(*) / SUM(COUNT(q)) OVER (), 6) END AS valid_percent FROM {_NA} GROUP BY q""")
def tabyl_one_way(t):
    out = X.tabyl(line_na(t), "q")
    return out.withColumns({c: F.round(c, 6) for c in ("percent", "valid_percent")})


@query("tabyl_two_way", """SELECT o_orderpriority, COUNT(*) FILTER (o_orderstatus = 'F') AS F, COUNT(*) FILTER (o_orderstatus = 'O') AS O,
COUNT(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def tabyl_two_way(t):
    return X.tabyl(t.orders, "o_orderpriority", "o_orderstatus")


@query("tabyl_two_way_na", f"""SELECT l_returnflag, COUNT(*) FILTER (b = 'big') AS big, COUNT(*) FILTER (b = 'small') AS small, COUNT(*) FILTER (b IS NULL) AS "NA_"
FROM (SELECT l_returnflag, CASE WHEN q > 25 THEN 'big' WHEN q <= 25 THEN 'small' END AS b FROM {_NA}) GROUP BY 1""")
def tabyl_two_way_na(t):
    return X.crosstab(line_na(t).withColumn("b", F.when(F.col("q") > 25, "big").when(F.col("q") <= 25, "small")), "l_returnflag", "b")


@query("tabyl_three_way", """SELECT r.y, p.o_orderpriority, COUNT(o_orderkey) FILTER (o_orderstatus = 'F') AS F, COUNT(o_orderkey) FILTER (o_orderstatus = 'O') AS O,
COUNT(o_orderkey) FILTER (o_orderstatus = 'P') AS P FROM (SELECT DISTINCT year(o_orderdate)::BIGINT AS y FROM orders) r CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p
LEFT JOIN orders o ON year(o_orderdate) = r.y AND o.o_orderpriority = p.o_orderpriority GROUP BY 1, 2""")
def tabyl_three_way(t):
    return X.tabyl(t.orders.withColumn("y", F.year("o_orderdate").cast("bigint")), "o_orderpriority", "o_orderstatus", "y")


_TWO = """(SELECT o_orderpriority, COUNT(*) FILTER (o_orderstatus = 'F') AS F, COUNT(*) FILTER (o_orderstatus = 'O') AS O,
COUNT(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1)"""


@query("adorn_totals_both", f"""SELECT COALESCE(o_orderpriority, 'Total') AS o_orderpriority, SUM(F)::BIGINT AS F, SUM(O)::BIGINT AS O, SUM(P)::BIGINT AS P, SUM(F + O + P)::BIGINT AS Total
FROM {_TWO} GROUP BY ROLLUP (o_orderpriority)""")
def adorn_totals_both(t):
    return X.adorn_totals(X.tabyl(t.orders, "o_orderpriority", "o_orderstatus"), ("row", "col"))


@query("margins_every_subset", """SELECT COALESCE(o_orderpriority, '(all)') AS o_orderpriority, COALESCE(o_orderstatus, '(all)') AS o_orderstatus, COUNT(*) AS n
FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""")
def margins_every_subset(t):
    return X.add_margins(t.orders, ["o_orderpriority", "o_orderstatus"], n=F.count(F.lit(1)))


@query("adorn_percentages_row", f"SELECT o_orderpriority, ROUND(F / (F + O + P), 6) AS F, ROUND(O / (F + O + P), 6) AS O, ROUND(P / (F + O + P), 6) AS P FROM {_TWO}")
def adorn_percentages_row(t):
    return X.adorn_rounding(X.adorn_percentages(X.tabyl(t.orders, "o_orderpriority", "o_orderstatus"), "row"), 6, "half up")


@query("adorn_percentages_col", f"SELECT o_orderpriority, ROUND(F / SUM(F) OVER (), 6) AS F, ROUND(O / SUM(O) OVER (), 6) AS O, ROUND(P / SUM(P) OVER (), 6) AS P FROM {_TWO}")
def adorn_percentages_col(t):
    return X.adorn_rounding(X.adorn_percentages(X.tabyl(t.orders, "o_orderpriority", "o_orderstatus"), "col"), 6, "half up")


@query("adorn_percentages_all", f"SELECT o_orderpriority, ROUND(F / SUM(F + O + P) OVER (), 6) AS F, ROUND(O / SUM(F + O + P) OVER (), 6) AS O, ROUND(P / SUM(F + O + P) OVER (), 6) AS P FROM {_TWO}")
def adorn_percentages_all(t):
    return X.adorn_rounding(X.adorn_percentages(X.tabyl(t.orders, "o_orderpriority", "o_orderstatus"), "all"), 6, "half up")


@query("adorn_text_cells", f"""SELECT o_orderpriority AS "priority/status", printf('%.2f%% (%d)', CAST(ROUND(CAST(100.0 * F / (F + O + P) AS DECIMAL(18,10)), 2) AS DOUBLE), F) AS F,
printf('%.2f%% (%d)', CAST(ROUND(CAST(100.0 * O / (F + O + P) AS DECIMAL(18,10)), 2) AS DOUBLE), O) AS O, printf('%.2f%% (%d)', CAST(ROUND(CAST(100.0 * P / (F + O + P) AS DECIMAL(18,10)), 2) AS DOUBLE), P) AS P FROM {_TWO}""")
def adorn_text_cells(t):
    counts = X.tabyl(t.orders, "o_orderpriority", "o_orderstatus")
    text = X.adorn_pct_formatting(X.adorn_percentages(counts, "row"), 2, "half up")
    return X.adorn_title(X.adorn_ns(text, counts), "priority", "status")


@query("top_levels_bands", """SELECT o_orderpriority, n, ROUND(n / SUM(n) OVER (), 6) AS percent FROM (SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '1-URGENT, 2-HIGH'
WHEN o_orderpriority = '3-MEDIUM' THEN '3-MEDIUM' ELSE '4-NOT SPECIFIED, 5-LOW' END AS o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1)""")
def top_levels_bands(t):
    levels = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return X.top_levels(t.orders, "o_orderpriority", levels).withColumn("percent", F.round("percent", 6))


@query("get_dupes", """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, n AS dupe_count FROM lineitem JOIN
(SELECT l_orderkey AS k, l_linenumber AS l, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1) ON k = l_orderkey AND l = l_linenumber""")
def get_dupes(t):
    return G.get_dupes(t.lineitem, "l_orderkey", "l_linenumber").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "dupe_count")


@query("all_equal_tables", """SELECT a + b = 0 AS equal, CASE WHEN a + b > 0 THEN printf('%d rows only in x, %d rows only in y', a, b) END AS reason FROM
(SELECT COUNT(*) AS a FROM (SELECT c_custkey FROM customer EXCEPT ALL SELECT o_custkey FROM orders)),
(SELECT COUNT(*) AS b FROM (SELECT o_custkey FROM orders EXCEPT ALL SELECT c_custkey FROM customer))""")
def all_equal_tables(t):
    return G.all_equal(t.customer.select(F.col("c_custkey").alias("k")), t.orders.select(F.col("o_custkey").alias("k")))


@query("dcast_margins", """SELECT COALESCE(c_mktsegment, '(all)') AS c_mktsegment, CAST(SUM(CASE WHEN neg THEN b END) AS DOUBLE) AS "true", CAST(SUM(CASE WHEN NOT neg THEN b END) AS DOUBLE) AS "false",
CAST(SUM(b) AS DOUBLE) AS "(all)" FROM (SELECT c_mktsegment, c_acctbal < 0 AS neg, CAST(c_acctbal AS DECIMAL(18,2)) AS b FROM customer) GROUP BY ROLLUP (c_mktsegment)""")
def dcast_margins(t):
    base = t.customer.select("c_mktsegment", (F.col("c_acctbal") < 0).cast("string").alias("neg"), F.col("c_acctbal").cast("decimal(18,2)").alias("b"))
    return R.dcast(base, ["c_mktsegment"], "neg", "b", lambda c: F.sum(c).cast("double"), margins=True)


@query("acast_cells", """SELECT l_returnflag, CAST(SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS BIGINT) || ',' || CAST(SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS BIGINT) AS cells
FROM lineitem GROUP BY 1""")
def acast_cells(t):
    out = R.acast(t.lineitem, "l_returnflag", "l_linestatus", "l_quantity", F.sum)
    return out.withColumn("cells", F.array_join(F.col("cells").cast("array<bigint>"), ","))


@query("recast_means", "SELECT l_returnflag, ROUND(AVG(l_quantity), 6) AS l_quantity, ROUND(AVG(l_discount), 6) AS l_discount FROM lineitem GROUP BY 1")
def recast_means(t):
    base = t.lineitem.select("l_returnflag", "l_quantity", "l_discount")
    return R.recast(base, ["l_returnflag"], ["l_returnflag"], lambda c: F.round(F.avg(c), 6))


# -------------------------------------------------------------- statistics

@query("describe_moments", """SELECT l_returnflag, COUNT(l_quantity) AS n, ROUND(AVG(l_quantity), 5) AS mean, ROUND(VAR_SAMP(l_quantity), 5) AS variance,
ROUND(STDDEV_SAMP(l_quantity) / SQRT(COUNT(l_quantity)), 5) AS error_of_mean, ROUND(kurtosis_pop(l_quantity), 5) AS kurtosis,
ROUND((AVG(l_quantity * l_quantity * l_quantity) - 3 * AVG(l_quantity) * AVG(l_quantity * l_quantity) + 2 * POWER(AVG(l_quantity), 3)) / POWER(VAR_POP(l_quantity), 1.5), 5) AS skewness, MIN(l_quantity) AS min, MAX(l_quantity) AS max FROM lineitem GROUP BY 1""")
def describe_moments(t):
    out = G.describe_ext(t.lineitem, "l_quantity", ["l_returnflag"])
    return out.withColumns({c: F.round(c, 5) for c in ("mean", "variance", "error_of_mean", "kurtosis", "skewness")})


_CHUNKS = 3
_PROBS = {"q10": 0.1, "q50": 0.5, "q99": 0.99}


def _order_states(t):
    """States of the order prices in chunks, merged."""
    chunks = [t.orders.where(F.col("o_orderkey") % _CHUNKS == i) for i in range(_CHUNKS)]
    return S.merge([S.state(c, "o_totalprice", ["o_orderpriority"]) for c in chunks], ["o_orderpriority"])


@query("merged_states", """SELECT o_orderpriority, COUNT(*) AS n, ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS "sum", ROUND(AVG(o_totalprice), 4) AS mean,
ROUND(VAR_SAMP(o_totalprice) / 1e6, 3) AS variance, ROUND(kurtosis_pop(o_totalprice), 5) AS kurtosis, MIN(o_totalprice) AS min, MAX(o_totalprice) AS max FROM orders GROUP BY 1""")
def merged_states(t):
    out = S.describe(_order_states(t), ["o_orderpriority"])
    return out.select("o_orderpriority", "n", F.round("sum", 2).alias("sum"), F.round("mean", 4).alias("mean"), F.round(F.col("variance") / 1e6, 3).alias("variance"),
                      F.round("kurtosis", 5).alias("kurtosis"), "min", "max")


@query("quantile_states", """SELECT o_orderpriority, name, TRUE AS holds FROM (SELECT DISTINCT o_orderpriority FROM orders), (VALUES ('q10'), ('q50'), ('q99')) v(name)""")
def quantile_states(t):
    """Whether the share of rows below each merged quantile is the asked one, give or take the stated error (twice, so that 99 % becomes certainty)."""
    found = S.describe(_order_states(t), ["o_orderpriority"], _PROBS)
    long = found.select("o_orderpriority", "rank_error", F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(p).alias("p"), F.col(n).alias("q")) for n, p in _PROBS.items()])).alias("s")).select(
        "o_orderpriority", "rank_error", "s.*")
    price = F.col("o_totalprice")
    shares = t.orders.join(long, "o_orderpriority").groupBy("o_orderpriority", "name", "p", "rank_error").agg(
        F.avg((price < F.col("q")).cast("double")).alias("below"), F.avg((price <= F.col("q")).cast("double")).alias("upto"))
    off = 2 * F.col("rank_error")
    return shares.select("o_orderpriority", "name", ((F.col("below") <= F.col("p") + off) & (F.col("upto") >= F.col("p") - off)).alias("holds"))


@query("sum_without_cancelling", """SELECT l_returnflag, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS "sum" FROM lineitem GROUP BY 1""")
def sum_without_cancelling(t):
    """Every price between two large values that cancel: a plain running sum would lose all digits of the prices."""
    x = t.lineitem.select("l_returnflag", F.explode(F.array(F.lit(1e17), F.col("l_extendedprice").cast("double"), F.lit(-1e17))).alias("x"))
    return S.describe(S.state(x, "x", ["l_returnflag"]), ["l_returnflag"]).select("l_returnflag", F.round("sum", 2).alias("sum"))


@query("covariance_by_group", "SELECT l_returnflag, ROUND(COVAR_SAMP(l_quantity, l_extendedprice), 2) AS cov FROM lineitem GROUP BY 1")
def covariance_by_group(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(G.covariance("l_quantity", "l_extendedprice"), 2).alias("cov"))


@query("density_bins", """SELECT l_returnflag, CAST(FLOOR(l_quantity / 5) * 5 AS BIGINT) AS bin, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY l_returnflag) / 5, 8) AS density
FROM lineitem GROUP BY 1, 2""")
def density_bins(t):
    out = G.density(t.lineitem, "l_quantity", 5, ["l_returnflag"])
    return out.select("l_returnflag", F.col("bin").cast("bigint").alias("bin"), "n", F.round("density", 8).alias("density"))


@query("tail_mean_peaks", """SELECT k AS event_type, tm AS tail_mean, n_peaks, me AS mean_excess FROM (SELECT event_type AS k, ROUND(AVG(value), 6) AS tm FROM (SELECT event_type, value, quantile_cont(value, 0.9) OVER (PARTITION BY event_type) AS c FROM events) WHERE value >= c GROUP BY 1)
JOIN (SELECT event_type, COUNT(*) FILTER (value > 100) AS n_peaks, ROUND(AVG(value - 100) FILTER (value > 100), 6) AS me FROM events GROUP BY 1) ON k = event_type""")
def tail_mean_peaks(t):
    a = G.tail_mean(t.events, "value", 0.9, ["event_type"]).withColumn("tail_mean", F.round("tail_mean", 6))
    return a.join(G.peaks_over(t.events, "value", 100.0, ["event_type"]).withColumn("mean_excess", F.round("mean_excess", 6)), "event_type")


@query("weighted_statistics", """SELECT l_returnflag, ROUND(SUM(l_extendedprice * l_quantity) / SUM(l_quantity), 3) AS wmean,
ROUND(SUM(l_discount * l_discount * l_quantity) / SUM(l_quantity) - POWER(SUM(l_discount * l_quantity) / SUM(l_quantity), 2), 7) AS wvar FROM lineitem GROUP BY 1""")
def weighted_statistics(t):
    mean = t.lineitem.groupBy("l_returnflag").agg(F.round(G.weighted_mean("l_extendedprice", "l_quantity"), 3).alias("wmean"))
    var = G.weighted_var(t.lineitem, "l_discount", "l_quantity", ["l_returnflag"], "wvar")
    return mean.join(var.withColumn("wvar", F.round("wvar", 7)), "l_returnflag")


@query("weighted_shape_tail", """WITH b AS (SELECT l_returnflag AS f, l_extendedprice AS x, l_quantity AS w, SUM(l_extendedprice * l_quantity) OVER (PARTITION BY l_returnflag) / SUM(l_quantity) OVER (PARTITION BY l_returnflag) AS m FROM lineitem),
s AS (SELECT f, MAX(m) AS mean, SUM(POWER(x - m, 2) * w) / SUM(w) AS v, SUM(POWER(x - m, 3) * w) / SUM(w) AS m3, SUM(POWER(x - m, 4) * w) / SUM(w) AS m4 FROM b GROUP BY 1),
u AS (SELECT f, x, SUM(w) OVER (PARTITION BY f ORDER BY x) AS upto, SUM(w) OVER (PARTITION BY f) AS total FROM (SELECT f, x, SUM(w) AS w FROM b GROUP BY 1, 2)),
c AS (SELECT f, MIN(x) AS cut FROM u WHERE upto >= total * 0.9 GROUP BY 1)
SELECT f AS l_returnflag, ROUND(mean, 4) AS mean, ROUND(v / 1e6, 4) AS variance, ROUND(m3 / POWER(v, 1.5), 6) AS skewness, ROUND(m4 / v / v - 3, 6) AS kurtosis, ROUND(tail, 3) AS tail_mean
FROM s JOIN (SELECT f, SUM(x * w) / SUM(w) AS tail FROM b JOIN c USING (f) WHERE x >= cut GROUP BY 1) USING (f)""")
def weighted_shape_tail(t):
    shape = G.weighted_shape(t.lineitem, "l_extendedprice", "l_quantity", ["l_returnflag"])
    tail = G.weighted_tail_mean(t.lineitem, "l_extendedprice", "l_quantity", 0.9, ["l_returnflag"])
    return shape.join(tail, "l_returnflag").select(
        "l_returnflag", F.round("mean", 4).alias("mean"), F.round(F.col("variance") / 1e6, 4).alias("variance"), F.round("skewness", 6).alias("skewness"),
        F.round("kurtosis", 6).alias("kurtosis"), F.round("tail_mean", 3).alias("tail_mean"))


@query("weighted_variance_far_from_zero", """SELECT l_returnflag, ROUND(SUM(x * x * w) / SUM(w) - POWER(SUM(x * w) / SUM(w), 2), 5) AS wvar
FROM (SELECT l_returnflag, l_linenumber AS x, l_quantity AS w FROM lineitem WHERE l_linenumber <> 3) GROUP BY 1""")
def weighted_variance_far_from_zero(t):
    d = t.lineitem.select("l_returnflag", F.when(F.col("l_linenumber") != 3, F.col("l_linenumber") + 1e9).alias("x"), F.col("l_quantity").alias("w"))
    return G.weighted_var(d, "x", "w", ["l_returnflag"], "wvar").withColumn("wvar", F.round("wvar", 5))


@query("weighted_quantile", """SELECT l_returnflag, MIN(x) AS quantile FROM (SELECT l_returnflag, x, SUM(w) OVER (PARTITION BY l_returnflag ORDER BY x) AS upto, SUM(w) OVER (PARTITION BY l_returnflag) AS total FROM
(SELECT l_returnflag, l_extendedprice AS x, SUM(l_quantity) AS w FROM lineitem GROUP BY 1, 2)) WHERE upto >= total * 0.75 GROUP BY 1""")
def weighted_quantile(t):
    return G.weighted_quantile(t.lineitem, "l_extendedprice", "l_quantity", 0.75, ["l_returnflag"])


@query("named_aggregate", f"SELECT l_returnflag, COALESCE(SUM(q), 0) AS total, MEDIAN(l_quantity) AS mid, MAX(l_discount) - MIN(l_discount) AS spread FROM {_NA} GROUP BY 1")
def named_aggregate(t):
    G.register_agg("spread", lambda c: F.max(c) - F.min(c))
    return line_na(t).groupBy("l_returnflag").agg(G.named_agg("sum", "q", na_rm=True).alias("total"), G.named_agg("median", "l_quantity").alias("mid"),
                                                  G.named_agg("spread", "l_discount").alias("spread"))


@query("custom_aggregate", "SELECT event_type, MAX(value) AS top, MIN(user_id) AS first_user FROM events GROUP BY 1")
def custom_aggregate(t):
    top = P.custom_agg(t.events, ["event_type"], "value", "top", lambda x: float(x.max()), lambda x: float(x.max()))
    low = P.custom_agg(t.events, ["event_type"], "user_id", "first_user", lambda x: int(x.min()), lambda x: int(x.min()), "bigint")
    return top.join(low, "event_type")


@query("custom_window_function", """SELECT user_id, event_type, n - FIRST_VALUE(n) OVER (PARTITION BY user_id ORDER BY event_type) AS over_first FROM (SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2)""")
def custom_window_function(t):
    counts = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    out = P.window_apply(counts, ["user_id"], ["event_type"], lambda p: p.n - p.n.iloc[0], "over_first", "bigint")
    return out.select("user_id", "event_type", "over_first")


def _since_large(p: pd.DataFrame, state: int | None = None) -> pd.Series:
    """Rows since the last value of 100 or more, that row included; ``state`` is the number before the first row."""
    large = p["value"].ge(100)
    run = large.cumsum()
    place = p.groupby(run).cumcount()
    return (place + (run > 0)).where(run > 0, place + 1 + (state or 0))


@query("custom_window_with_state", """SELECT event_id, ROW_NUMBER() OVER (PARTITION BY event_type, r ORDER BY ts, event_id) AS since FROM
(SELECT *, COUNT(*) FILTER (value >= 100) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS r FROM events)""")
def custom_window_with_state(t):
    # a piece hands on its last number, and whether a large value was in it
    carry = P.Carry(lambda p: (int(_since_large(p).iloc[-1]), bool(p["value"].ge(100).any())),
                    lambda a, b: b if b[1] else (a[0] + b[0], a[1]))
    e = t.events.select("event_id", "event_type", "ts", "value")
    out = P.window_apply(e, ["event_type"], ["ts", "event_id"], lambda p, s: _since_large(p, s and s[0]), "since", "bigint", carry=carry)
    return out.select("event_id", "since")


@query("page_apply_rows", "SELECT event_id, event_type || '-' || user_id AS tag FROM events")
def page_apply_rows(t):
    return P.page_apply(t.events.select("event_id", "event_type", "user_id"),
                        lambda p: pd.DataFrame({"event_id": p.event_id, "tag": p.event_type + "-" + p.user_id.astype(str)}), "event_id bigint, tag string")


@query("scalar_functions", "SELECT part.p_partkey, p_size * 2 + 1 AS odd, upper(p_brand) AS brand FROM part")
def scalar_functions(t):
    odd = lambda c: F.col(c) * 2 + 1

    @F.pandas_udf("string")
    def shout(s: pd.Series) -> pd.Series:
        return s.str.upper()
    return t.part.select("p_partkey", odd("p_size").alias("odd"), shout("p_brand").alias("brand"))


@query("named_query_book", "SELECT o_orderstatus, ROUND(AVG(CAST(o_totalprice AS DECIMAL(18,2))), 4) AS mean, COUNT(*) AS n FROM orders WHERE o_totalprice > 100000 AND o_orderpriority = '2-HIGH' GROUP BY 1")
def named_query_book(t):
    book = P.QueryBook()

    @book.filter("only_large")
    def only_large(df, params):
        return df.where(F.col("o_totalprice") > params.pop("floor")), params

    @book.filter("audit")
    def audit(df, params):
        raise AssertionError("skipped by the query")

    @book.query("mean_price", skip=("audit",))
    def mean_price(df, priority):
        price = F.avg(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
        return df.where(F.col("o_orderpriority") == priority).groupBy("o_orderstatus").agg(F.round(price, 4).alias("mean"), F.count(F.lit(1)).alias("n"))

    return book.run("mean_price", t.orders, floor=100000, priority="2-HIGH")


@query("sql_with_bound_values", "SELECT c_mktsegment, COUNT(*) AS n FROM customer WHERE c_acctbal > 5000 GROUP BY 1")
def sql_with_bound_values(t):
    return P.run_sql(t.spark, "SELECT c_mktsegment, COUNT(*) AS n FROM customer_rows WHERE c_acctbal > :floor GROUP BY c_mktsegment",
                     {"customer_rows": t.customer}, floor=5000)


@query("run_many_functions", """SELECT 'largest' AS name, MAX(o_totalprice) AS v FROM orders UNION ALL SELECT 'smallest', MIN(o_totalprice) FROM orders""")
def run_many_functions(t):
    return P.run_many({"largest": lambda d: d.agg(F.max("o_totalprice").alias("v")), "smallest": lambda d: d.agg(F.min("o_totalprice").alias("v"))}, t.orders)


@query("safe_apply_errors", """SELECT error, COUNT(*) AS n, SUM(result)::BIGINT AS total FROM (SELECT TRY_CAST(split_part(p_brand, '#', 2) || CASE WHEN p_size > 25 THEN 'x' ELSE '' END AS BIGINT) AS result,
CASE WHEN result IS NULL THEN 'failed' END AS error FROM part) GROUP BY 1""")
def safe_apply_errors(t):
    text = F.concat(F.split_part("p_brand", F.lit("#"), F.lit(2)), F.when(F.col("p_size") > 25, "x").otherwise(""))
    out = t.part.select(P.safe_apply(text.try_cast("bigint")).alias("r")).select("r.*")
    return out.groupBy("error").agg(F.count(F.lit(1)).alias("n"), F.sum("result").alias("total"))


@query("tabyl_level_named_like_missing", """SELECT o_orderpriority, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS "NA_", COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS "P",
COUNT(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'P')) AS "NA__" FROM orders GROUP BY 1""")
def tabyl_level_named_like_missing(t):
    status = F.when(F.col("o_orderstatus") == "F", "NA_").when(F.col("o_orderstatus") == "P", "P")
    return X.tabyl(t.orders.select("o_orderpriority", status.alias("s")), "o_orderpriority", "s")
