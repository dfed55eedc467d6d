"""Queries: ranks, running values, offsets, fills."""

from pyspark.sql import functions as F

from cohortspark.functions import na as N
from cohortspark.operators import ordered as O
from cohortspark.operators import verbs as V
from cohortspark.plans.book_tables import LINE, Q_NA, line_na
from cohortspark.plans.registry import query

_NA = f"(SELECT *, {Q_NA} AS q FROM lineitem)"
_ORD = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"


@query("row_number_groups", "SELECT o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders")
def row_number_groups(t):
    return O.row_number(t.orders, "r", ["o_orderdate", "o_orderkey"], ["o_custkey"]).select("o_orderkey", "r")


@query("rank_family", f"""SELECT l_orderkey, l_linenumber::BIGINT AS ln, l_partkey, CASE WHEN q IS NOT NULL THEN RANK() OVER w END AS mr, CASE WHEN q IS NOT NULL THEN DENSE_RANK() OVER w END AS dr,
CASE WHEN q IS NOT NULL THEN ROUND(PERCENT_RANK() OVER w, 8) END AS pr, CASE WHEN q IS NOT NULL THEN ROUND(CUME_DIST() OVER w, 8) END AS cd
FROM {_NA} WINDOW w AS (PARTITION BY l_returnflag, q IS NULL ORDER BY q)""")
def rank_family(t):
    out = O.ranks(line_na(t), "q", ["l_returnflag"], min_rank="mr", dense_rank="dr", percent_rank="pr", cume_dist="cd")
    return out.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("ln"), "l_partkey", "mr", "dr", F.round("pr", 8).alias("pr"), F.round("cd", 8).alias("cd"))


@query("rank_whole_table_desc", """SELECT event_id, RANK() OVER (ORDER BY value DESC) AS r, DENSE_RANK() OVER (ORDER BY value DESC) AS d FROM events""")
def rank_whole_table_desc(t):
    return O.ranks(t.events, "value", desc=True, min_rank="r", dense_rank="d").select("event_id", "r", "d")


@query("average_rank", """SELECT event_id, RANK() OVER (PARTITION BY user_id ORDER BY event_type) + (COUNT(*) OVER (PARTITION BY user_id, event_type) - 1) / 2.0 AS r FROM events""")
def average_rank(t):
    return O.ranks(t.events, "event_type", ["user_id"], avg_rank="r").select("event_id", "r")


@query("ntile_skips_na", """SELECT event_id, CASE WHEN v IS NOT NULL THEN NTILE(10) OVER (PARTITION BY event_type, v IS NULL ORDER BY v, event_id) END AS b FROM
(SELECT *, CASE WHEN value > 100 THEN NULL ELSE value END AS v FROM events)""")
def ntile_skips_na(t):
    e = t.events.withColumn("v", F.when(F.col("value") <= 100, F.col("value")))
    return O.ntile(e, "b", 10, ["v", "event_id"], ["event_type"]).select("event_id", "b")


@query("lag_lead_default", """SELECT o_orderkey, LAG(o_totalprice, 1) OVER w AS prev, LEAD(o_totalprice, 2, -1.0) OVER w AS ahead FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def lag_lead_default(t):
    order, by = ["o_orderdate", "o_orderkey"], ["o_custkey"]
    out = O.lag(t.orders, "o_totalprice", "prev", order, by)
    return O.lead(out, "o_totalprice", "ahead", order, by, 2, -1.0).select("o_orderkey", "prev", "ahead")


@query("cumsum_na_sticks", f"""SELECT l_orderkey, l_linenumber::BIGINT AS ln, l_partkey, CASE WHEN SUM(CASE WHEN q IS NULL THEN 1 ELSE 0 END) OVER w = 0 THEN SUM(q) OVER w END AS running
FROM {_NA} WINDOW w AS (PARTITION BY l_suppkey ORDER BY {_ORD} ROWS UNBOUNDED PRECEDING)""")
def cumsum_na_sticks(t):
    out = O.cumulate(line_na(t), "q", "sum", "running", LINE, ["l_suppkey"])
    return out.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("ln"), "l_partkey", "running")


@query("cumsum_whole_table", """SELECT o_orderkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM orders""")
def cumsum_whole_table(t):
    o = t.orders.withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    return O.cumulate(o, "price", "sum", "running", ["o_orderdate", "o_orderkey"]).select("o_orderkey", F.col("running").cast("double").alias("running"))


@query("cummin_cummax", """SELECT event_id, MIN(value) OVER w AS lo, MAX(value) OVER w AS hi FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def cummin_cummax(t):
    out = O.cumulate(t.events, "value", "min", "lo", ["ts", "event_id"], ["user_id"])
    return O.cumulate(out, "value", "max", "hi", ["ts", "event_id"], ["user_id"]).select("event_id", "lo", "hi")


@query("cumprod_growth", """SELECT o_orderkey, ROUND(EXP(SUM(LN(1 + CAST(month(o_orderdate) AS DOUBLE) / 100)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)), 6) AS factor FROM orders""")
def cumprod_growth(t):
    o = t.orders.withColumn("f", 1 + F.month("o_orderdate") / 100)
    return O.cumulate(o, "f", "prod", "factor", ["o_orderdate", "o_orderkey"], ["o_custkey"]).select("o_orderkey", F.round("factor", 6).alias("factor"))


@query("cummean_cumall_cumany", """SELECT event_id, ROUND(AVG(value) OVER w, 9) AS mean, BOOL_AND(value < 60) OVER w AS every, BOOL_OR(value > 60) OVER w AS some
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def cummean_cumall_cumany(t):
    order, by = ["ts", "event_id"], ["user_id"]
    e = t.events.withColumn("low", F.col("value") < 60).withColumn("high", F.col("value") > 60)
    out = O.cumulate(e, "value", "mean", "mean", order, by)
    out = O.cumulate(O.cumulate(out, "low", "all", "every", order, by), "high", "any", "some", order, by)
    return out.select("event_id", F.round("mean", 9).alias("mean"), "every", "some")


@query("moving_frame", """SELECT o_orderkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS last3 FROM orders""")
def moving_frame(t):
    o = t.orders.withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    return O.moving(o, {"last3": F.sum("price")}, -2, 0, ["o_orderdate", "o_orderkey"], ["o_custkey"]).select("o_orderkey", F.col("last3").cast("double").alias("last3"))


@query("moving_long_frames", """SELECT event_id, COUNT(value) OVER w AS n, CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) OVER w AS BIGINT) AS cents, MIN(value) OVER w AS low, MAX(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 2000 PRECEDING AND 3000 FOLLOWING) AS high
FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 5000 PRECEDING AND 1 PRECEDING)""")
def moving_long_frames(t):
    e = t.events.select("event_id", "ts", "value", F.round(F.col("value") * 100).cast("bigint").alias("c"))
    back = O.moving_frames(e, {"n": ("count", "value"), "cents": ("sum", "c"), "low": ("min", "value")}, -5000, -1, ["ts", "event_id"])
    both = O.moving_frames(back, {"high": ("max", "value")}, -2000, 3000, ["ts", "event_id"])
    return both.select("event_id", "n", "cents", "low", "high")


@query("group_statistics_recycled", """SELECT event_id, ROUND((value - AVG(value) OVER w) / STDDEV_SAMP(value) OVER w, 6) AS z, ROUND(value - MIN(value) OVER w, 6) AS above FROM events WINDOW w AS (PARTITION BY event_type)""")
def group_statistics_recycled(t):
    v = F.col("value")
    out = V.mutate(t.events, by=["event_type"], m=N.r_mean("value"), s=N.r_sd("value"), lo=N.r_min("value"))
    return out.select("event_id", F.round((v - F.col("m")) / F.col("s"), 6).alias("z"), F.round(v - F.col("lo"), 6).alias("above"))


@query("diff_period_change", """SELECT o_orderkey, ROUND(o_totalprice - LAG(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 2) AS change FROM orders""")
def diff_period_change(t):
    return O.diff(t.orders, "o_totalprice", "change", ["o_orderdate", "o_orderkey"], ["o_custkey"]).select("o_orderkey", F.round("change", 2).alias("change"))


@query("which_extreme", """SELECT user_id, MIN(CASE WHEN value = hi THEN r END) AS at_max FROM (SELECT user_id, value, MAX(value) OVER (PARTITION BY user_id) AS hi, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) GROUP BY 1""")
def which_extreme(t):
    return O.which(t.events, "value", "at_max", ["ts", "event_id"], ["user_id"], True)


@query("fill_down_up", """SELECT event_id, LAST_VALUE(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS down,
FIRST_VALUE(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS up FROM (SELECT *, CASE WHEN event_type = 'click' THEN value END AS v FROM events)""")
def fill_down_up(t):
    e = t.events.withColumn("down", F.when(F.col("event_type") == "click", F.col("value"))).withColumn("up", F.col("down"))
    out = O.fill(e, ["down"], ["ts", "event_id"], ["user_id"])
    return O.fill(out, ["up"], ["ts", "event_id"], ["user_id"], "up").select("event_id", "down", "up")


@query("order_by_override", """SELECT o_orderkey, FIRST_VALUE(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS newest FROM orders""")
def order_by_override(t):
    first = V.first_rows(t.orders, 1, ["-o_orderdate", "o_orderkey"], ["o_custkey"]).select("o_custkey", F.col("o_totalprice").alias("newest"))
    return O.attach(t.orders, first, ["o_custkey"]).select("o_orderkey", "newest")
