"""Queries: ordered categories."""

from pyspark.sql import functions as F

from cohortspark.operators import factors as C
from cohortspark.operators import reshape as R
from cohortspark.operators import tabyl as X
from cohortspark.plans.registry import query


@query("levels_by_appearance", "SELECT p_partkey, p_type, DENSE_RANK() OVER (ORDER BY f) AS p_type_level FROM (SELECT p_partkey, p_type, MIN(p_partkey) OVER (PARTITION BY p_type) AS f FROM part)")
def levels_by_appearance(t):
    return C.as_factor(t.part.select("p_partkey", "p_type"), "p_type", "p_partkey")


@query("levels_by_frequency", "SELECT p_partkey, l AS p_name_level FROM part JOIN (SELECT p_name AS n, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, p_name) AS l FROM part GROUP BY 1) ON n = p_name")
def levels_by_frequency(t):
    return C.level_number(t.part, "p_name", C.levels_infreq(t.part, "p_name")).select("p_partkey", "p_name_level")


@query("category_counts", "SELECT p_type, COUNT(*) AS n FROM part GROUP BY 1")
def category_counts(t):
    return C.fct_count(t.part, "p_type", sort=True)


@query("category_unique", "SELECT DISTINCT p_brand FROM part")
def category_unique(t):
    return C.fct_unique(t.part, "p_brand")


@query("lump_most_frequent", "SELECT p_name, COUNT(*) AS n FROM (SELECT CASE WHEN r <= 5 THEN part.p_name ELSE 'Other' END AS p_name FROM part JOIN (SELECT p_name, RANK() OVER (ORDER BY COUNT(*) DESC) AS r FROM part GROUP BY 1) c ON c.p_name = part.p_name) GROUP BY 1")
def lump_most_frequent(t):
    return C.fct_count(C.fct_lump(t.part, "p_name", n=5), "p_name")


@query("lump_least_frequent", "SELECT p_name, COUNT(*) AS n FROM (SELECT CASE WHEN r <= 3 THEN part.p_name ELSE 'Other' END AS p_name FROM part JOIN (SELECT p_name, RANK() OVER (ORDER BY COUNT(*)) AS r FROM part GROUP BY 1) c ON c.p_name = part.p_name) GROUP BY 1")
def lump_least_frequent(t):
    return C.fct_count(C.fct_lump(t.part, "p_name", n=-3), "p_name")


@query("lump_by_share", """SELECT k AS p_brand, SUM(w)::BIGINT AS n FROM (SELECT CASE WHEN w > 0.04 * SUM(w) OVER () THEN p_brand ELSE 'Other' END AS k, w FROM (SELECT p_brand, SUM(p_size)::BIGINT AS w FROM part GROUP BY 1)) GROUP BY 1""")
def lump_by_share(t):
    out = C.fct_lump(t.part, "p_brand", prop=0.04, w="p_size")
    return out.groupBy("p_brand").agg(F.sum("p_size").alias("n"))


@query("merge_levels", """SELECT p_partkey, CASE WHEN p_type IN ('LARGE', 'MEDIUM') THEN p_type ELSE 'Other' END AS o, CASE WHEN p_type IN ('LARGE', 'MEDIUM', 'SMALL') THEN 'sized' ELSE p_type END AS c,
CASE WHEN p_type = 'PROMO' THEN 'promotion' ELSE p_type END AS r, lower(p_type) AS l FROM part""")
def merge_levels(t):
    return t.part.select("p_partkey", C.fct_other("p_type", keep=["LARGE", "MEDIUM"]).alias("o"), C.fct_collapse("p_type", {"sized": ["LARGE", "MEDIUM", "SMALL"]}).alias("c"),
                         C.fct_recode("p_type", promotion="PROMO").alias("r"), C.fct_relabel("p_type", F.lower).alias("l"))


@query("reorder_level_list", """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 6 WHEN 'STANDARD' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'LARGE' THEN 4 WHEN 'ECONOMY' THEN 5 END::BIGINT AS p_type_level FROM part""")
def reorder_level_list(t):
    levels = sorted(C.levels_infreq(t.part, "p_type"))
    levels = C.fct_shift(C.fct_rev(C.fct_relevel(levels, "PROMO")), 0)
    return C.level_number(t.part, "p_type", levels).select("p_partkey", "p_type_level")


@query("reorder_by_median", "SELECT p_type, ROUND(m, 4) AS value, ROW_NUMBER() OVER (ORDER BY m, p_type) AS level FROM (SELECT p_type, MEDIAN(p_retailprice) AS m FROM part GROUP BY 1)")
def reorder_by_median(t):
    return C.fct_reorder(t.part, "p_type", "p_retailprice").withColumn("value", F.round("value", 4))


@query("reorder_by_last", "SELECT event_type, value, ROW_NUMBER() OVER (ORDER BY value DESC, event_type) AS level FROM (SELECT event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1)")
def reorder_by_last(t):
    return C.fct_reorder2(t.events, "event_type", "event_id", "value")


@query("explicit_missing_level", "SELECT CASE WHEN l_linenumber = 3 THEN '(Missing)' ELSE l_returnflag END AS f, COUNT(*) AS n FROM lineitem GROUP BY 1")
def explicit_missing_level(t):
    flag = F.when(F.col("l_linenumber") != 3, F.col("l_returnflag"))
    return C.fct_count(t.lineitem.select(C.fct_explicit_na(flag).alias("f")), "f")


@query("drop_unused_levels", "SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 1 WHEN 'LARGE' THEN 2 END::BIGINT AS p_type_level FROM part")
def drop_unused_levels(t):
    levels = C.fct_drop(t.part, "p_type", C.fct_expand(["TINY", "SMALL"], "LARGE", "HUGE"))
    return C.level_number(t.part, "p_type", levels).select("p_partkey", "p_type_level")


@query("combine_categories", "SELECT x, l::BIGINT AS x_level, COUNT(*) AS n FROM (SELECT o_orderstatus AS x FROM orders UNION ALL SELECT l_linestatus FROM lineitem) JOIN (VALUES ('F', 1), ('O', 2), ('P', 3)) v(k, l) ON k = x GROUP BY 1, 2")
def combine_categories(t):
    a, b = t.orders.select(F.col("o_orderstatus").alias("x")), t.lineitem.select(F.col("l_linestatus").alias("x"))
    both, levels = C.fct_c([a, b], "x", [["F", "O"], ["O", "P"]])
    return C.level_number(both, "x", levels).groupBy("x", "x_level").agg(F.count(F.lit(1)).alias("n"))


@query("anonymous_levels", "SELECT p_partkey, 'g' || n AS p_brand FROM part JOIN (SELECT p_brand, ROW_NUMBER() OVER (ORDER BY md5('7:' || p_brand), p_brand) AS n FROM part GROUP BY 1) USING (p_brand)")
def anonymous_levels(t):
    return C.fct_anon(t.part, "p_brand", 7, "g").select("p_partkey", "p_brand")


# ------------------------------------------------- categories with many levels

@query("many_levels_by_frequency", "SELECT o_orderkey, l AS o_custkey_level FROM orders JOIN (SELECT o_custkey AS k, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, o_custkey) AS l FROM orders GROUP BY 1) ON k = o_custkey")
def many_levels_by_frequency(t):
    """Every customer is a level."""
    return C.level_number(t.orders, "o_custkey", C.table_infreq(t.orders, "o_custkey")).select("o_orderkey", "o_custkey_level")


@query("many_levels_reordered", """WITH a AS (SELECT k, ROW_NUMBER() OVER (ORDER BY f, k) AS l, COUNT(*) OVER () AS t FROM (SELECT o_custkey AS k, MIN(o_orderkey) AS f FROM orders GROUP BY 1)),
b AS (SELECT k, (t - l - 3) % t + CASE WHEN (t - l - 3) % t < 0 THEN t ELSE 0 END + 1 AS l FROM a),
u AS (SELECT k, ROW_NUMBER() OVER (ORDER BY i, l) AS level FROM (SELECT k, MIN(i) AS i, MIN(l) AS l FROM (SELECT k, 0 AS i, l FROM b UNION ALL SELECT c_custkey, 1, c_custkey FROM customer WHERE c_custkey NOT IN (SELECT k FROM b)) GROUP BY 1))
SELECT k AS o_custkey, level FROM u""")
def many_levels_reordered(t):
    """Order of first appearance, reversed, shifted by three, with the customers that have no order behind."""
    levels = C.fct_shift(C.fct_rev(C.table_inorder(t.orders, "o_custkey", "o_orderkey")), 3)
    return C.lvls_union(levels, C.table_sorted(t.customer.select(F.col("c_custkey").alias("o_custkey")), "o_custkey"))


@query("long_cross_table", """SELECT o_custkey, o_orderpriority, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY o_custkey), 9) AS "share" FROM orders GROUP BY 1, 2""")
def long_cross_table(t):
    return X.tabyl_long(t.orders, "o_custkey", "o_orderpriority", share="row").withColumn("share", F.round("share", 9))


@query("many_columns_as_map", """SELECT o_orderpriority, COUNT(*) AS n_cells, SUM(k * n)::BIGINT AS mark, MAX(n) AS top FROM (SELECT o_orderpriority, o_custkey AS k, COUNT(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""")
def many_columns_as_map(t):
    """A cross table with a column for every customer: the columns are the keys of a map."""
    wide = R.dcast_map(t.orders, ["o_orderpriority"], "o_custkey", "o_orderkey", F.count)
    cells = F.map_entries("cells")
    total = F.aggregate(cells, F.lit(0).cast("bigint"), lambda a, e: a + e["key"].cast("bigint") * e["value"])
    return wide.select("o_orderpriority", F.size("cells").cast("bigint").alias("n_cells"), total.alias("mark"), F.array_max(F.map_values("cells")).alias("top"))


@query("keys_spread_to_map", """SELECT l_orderkey, COUNT(DISTINCT l_linenumber) AS n_cells, MAX(l_quantity) FILTER (l_linenumber = 2) AS second FROM lineitem GROUP BY 1""")
def keys_spread_to_map(t):
    wide = R.spread_map(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), "l_linenumber", "l_quantity", check=False)
    return wide.select("l_orderkey", F.size("cells").cast("bigint").alias("n_cells"), F.try_element_at("cells", F.lit(2)).alias("second"))
