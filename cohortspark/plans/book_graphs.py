"""Queries: graphs. Edges run from customers to suppliers by their orders."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortspark.operators import graph as G
from cohortspark.plans.registry import query


def trade(t):
    """One edge per line item, suppliers numbered after the customers."""
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("src"))
    l = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_suppkey") + 1000000).alias("dst"), F.col("l_quantity").alias("weight"),
                          F.col("l_discount").alias("residual"))
    return l.join(o, "o_orderkey").select("src", "dst", "weight", "residual")


_TRADE = "(SELECT o_custkey AS src, l_suppkey + 1000000 AS dst, l_quantity AS weight, l_discount AS residual FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def nations(t):
    """Nation to nation: line items sold, from the whole line item table."""
    c = t.customer.select(F.col("c_custkey").alias("src"), F.col("c_nationkey").cast("bigint").alias("a"))
    s = t.supplier.select((F.col("s_suppkey") + 1000000).alias("dst"), F.col("s_nationkey").cast("bigint").alias("b"))
    per = trade(t).groupBy("src", "dst").agg(F.sum("weight").alias("w"))
    return per.join(c, "src").join(s, "dst").groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("w").alias("weight"))


_NATIONS = f"""n AS (SELECT CAST(c_nationkey AS BIGINT) AS src, CAST(s_nationkey AS BIGINT) AS dst, SUM(weight) AS weight FROM {_TRADE} x JOIN customer ON c_custkey = src JOIN supplier ON s_suppkey + 1000000 = dst GROUP BY 1, 2)"""


@query("graph_out_degree", f"SELECT id, COUNT(src) AS degree FROM (SELECT src AS id FROM {_TRADE} UNION SELECT dst FROM {_TRADE}) LEFT JOIN {_TRADE} e ON e.src = id GROUP BY 1")
def graph_out_degree(t):
    return G.degree(trade(t))


@query("graph_in_degree", f"SELECT id, COUNT(dst) AS degree FROM (SELECT c_custkey AS id FROM customer UNION SELECT s_suppkey + 1000000 FROM supplier) LEFT JOIN {_TRADE} e ON e.dst = id GROUP BY 1")
def graph_in_degree(t):
    v = t.customer.select(F.col("c_custkey").alias("id")).unionByName(t.supplier.select((F.col("s_suppkey") + 1000000).alias("id")))
    return G.degree(trade(t), v, "in")


@query("graph_degree_distribution", f"SELECT degree, COUNT(*) AS n_vertices, ROUND(AVG(w), 6) AS mean_weight FROM (SELECT src, COUNT(*) AS degree, SUM(weight) AS w FROM {_TRADE} GROUP BY 1) GROUP BY 1")
def graph_degree_distribution(t):
    return G.degree_dist(trade(t), "weight").withColumn("mean_weight", F.round("mean_weight", 6))


@query("graph_duplicate_edges", f"SELECT SUM(c - 1)::BIGINT AS n_duplicates FROM (SELECT COUNT(*) AS c FROM {_TRADE} GROUP BY src, dst)")
def graph_duplicate_edges(t):
    return G.dup_edges(trade(t))


@query("graph_duplicate_distribution", f"SELECT repeats::BIGINT AS repeats, COUNT(*) AS n_vertices FROM (SELECT src, SUM(c - 1) AS repeats FROM (SELECT src, COUNT(*) AS c FROM {_TRADE} GROUP BY src, dst) GROUP BY 1) GROUP BY 1")
def graph_duplicate_distribution(t):
    return G.dup_edge_dist(trade(t))


@query("graph_transpose", f"SELECT dst AS src, src AS dst, weight FROM {_TRADE}")
def graph_transpose(t):
    return G.transpose(trade(t)).select("src", "dst", "weight")


@query("graph_lookup_edge", f"SELECT src, dst, COUNT(*) AS n FROM {_TRADE} WHERE src = 7 AND dst = 1000011 GROUP BY 1, 2 UNION ALL SELECT NULL, NULL, 0")
def graph_lookup_edge(t):
    found = G.lookup_edge(trade(t), 7, 1000011).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    none = t.region.agg(F.lit(None).cast("bigint").alias("src"), F.lit(None).cast("bigint").alias("dst"), F.lit(0).cast("bigint").alias("n"))
    return found.unionByName(none)


@query("graph_bandwidth", f"SELECT MAX(ABS(src - dst)) AS bandwidth FROM {_TRADE}")
def graph_bandwidth(t):
    return G.bandwidth(trade(t))


@query("graph_flow_cost", f"SELECT ROUND(SUM((1 - residual) * weight), 3) AS cost FROM {_TRADE}")
def graph_flow_cost(t):
    return G.flow_cost(trade(t).withColumn("capacity", F.lit(1.0))).select(F.round("cost", 3).alias("cost"))


@query("graph_components", f"""SELECT id, 0::BIGINT AS component FROM (SELECT src AS id FROM {_TRADE} UNION SELECT dst FROM {_TRADE})""")
def graph_components(t):
    return G.components(trade(t))


def text_links(t):
    """Each document linked to the first one with the same text."""
    d = t.documents.select("doc_id", F.sha2("text", 256).alias("sig"))
    first = d.groupBy("sig").agg(F.min("doc_id").alias("dst"))
    return d.join(first, "sig").where("doc_id <> dst").select(F.col("doc_id").alias("src"), "dst")


@query("graph_sparse_components", "SELECT doc_id AS id, MIN(doc_id) OVER (PARTITION BY text) AS component FROM documents")
def graph_sparse_components(t):
    return G.components(text_links(t), t.documents.select(F.col("doc_id").alias("id")))


@query("graph_link_components", """SELECT k AS src, dst FROM (SELECT k, LEAD(k) OVER (ORDER BY k) AS dst FROM (SELECT MIN(doc_id) AS k FROM documents GROUP BY text)) WHERE dst IS NOT NULL""")
def graph_link_components(t):
    return G.link_components(G.components(text_links(t), t.documents.select(F.col("doc_id").alias("id")))).select("src", "dst")


def sales_tree(t):
    """Region to nation to customer to order, over the whole tables; an order weighs its price, a customer 1.5, a nation 1."""
    key = lambda c, base: (F.col(c).cast("bigint") + base)
    link = lambda df, a, a0, b, b0, w: df.select(key(a, a0).alias("src"), key(b, b0).alias("dst"), w.cast("double").alias("weight"))
    return (link(t.nation, "n_regionkey", 0, "n_nationkey", 100, F.lit(1.0))
            .unionByName(link(t.customer, "c_nationkey", 100, "c_custkey", 10**9, F.lit(1.5)))
            .unionByName(link(t.orders, "o_custkey", 10**9, "o_orderkey", 10**12, F.col("o_totalprice"))))


_TREE = """a AS (SELECT CAST(r_regionkey AS BIGINT) AS id, r_regionkey AS r, 0 AS hops, 0.0::DOUBLE AS d FROM region
UNION ALL SELECT n_nationkey + 100, n_regionkey, 1, 1.0 FROM nation
UNION ALL SELECT c_custkey + 1000000000, n_regionkey, 2, 2.5 FROM customer JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT o_orderkey + 1000000000000, n_regionkey, 3, 2.5 + o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""


@query("graph_shortest_paths", f"WITH {_TREE} SELECT id, CASE WHEN r = 0 THEN ROUND(d, 2) ELSE CAST('inf' AS DOUBLE) END AS distance FROM a")
def graph_shortest_paths(t):
    return G.shortest_paths(sales_tree(t), 0).withColumn("distance", F.round("distance", 2))


@query("graph_hops", f"WITH {_TREE} SELECT id, CASE WHEN r = 0 THEN hops::DOUBLE ELSE CAST('inf' AS DOUBLE) END AS distance FROM a")
def graph_hops(t):
    return G.shortest_paths(sales_tree(t), 0, weight=None)


@query("graph_reachable", """SELECT (SELECT n_regionkey = 0 FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey = 7) AS ahead, FALSE AS back,
(SELECT COUNT(*) FROM nation) + (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM orders) AS n_edges""")
def graph_reachable(t):
    e = sales_tree(t)
    there, back = G.st_connected(e, 0, 10**9 + 7), G.st_connected(e, 10**9 + 7, 0)
    return e.agg(F.lit(there).alias("ahead"), F.lit(back).alias("back"), F.count(F.lit(1)).alias("n_edges"))


@query("graph_topological_levels", f"WITH {_TREE} SELECT id, hops::BIGINT AS level FROM a")
def graph_topological_levels(t):
    return G.topo_levels(sales_tree(t)).select("id", F.col("level").cast("bigint").alias("level"))


# farthest vertex of the sales tree, edges both ways: down its own branches (h), or up and into another branch (u)
_FAR = """c AS (SELECT c_custkey, n_regionkey AS r, n_nationkey AS n, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 1 ELSE 0 END AS h
  FROM customer JOIN nation ON n_nationkey = c_nationkey),
n AS (SELECT n_nationkey AS n, n_regionkey AS r, COALESCE(MAX(1 + h), 0) AS h FROM nation LEFT JOIN c ON c.n = n_nationkey GROUP BY 1, 2),
nu AS (SELECT *, 1 + COALESCE(MAX(1 + h) OVER (PARTITION BY r ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW), 0) AS u FROM n),
cu AS (SELECT c.*, 1 + GREATEST(nu.u, COALESCE(MAX(1 + c.h) OVER (PARTITION BY c.n ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW), 0)) AS u FROM c JOIN nu USING (n)),
far AS (SELECT CAST(r_regionkey AS BIGINT) AS id, r_regionkey AS r, COALESCE((SELECT MAX(1 + h) FROM n WHERE n.r = r_regionkey), 0) AS e FROM region WHERE EXISTS (SELECT 1 FROM nation WHERE n_regionkey = r_regionkey)
UNION ALL SELECT n + 100, r, GREATEST(h, u) FROM nu
UNION ALL SELECT c_custkey + 1000000000, r, GREATEST(h, u) FROM cu
UNION ALL SELECT o_orderkey + 1000000000000, r, 1 + GREATEST(u, CASE WHEN COUNT(*) OVER (PARTITION BY o_custkey) > 1 THEN 1 ELSE 0 END) FROM orders JOIN cu ON c_custkey = o_custkey)"""


@query("graph_eccentricity", f"WITH {_FAR} SELECT id, e::BIGINT AS eccentricity FROM far")
def graph_eccentricity(t):
    return G.eccentricities(sales_tree(t)).select("id", "eccentricity")


@query("graph_radius_diameter", f"WITH {_FAR} SELECT r::BIGINT AS component, MIN(e)::BIGINT AS radius, MAX(e)::BIGINT AS diameter FROM far GROUP BY 1")
def graph_radius_diameter(t):
    found = G.eccentricities(sales_tree(t))
    return found.groupBy("component").agg(F.min("eccentricity").alias("radius"), F.max("eccentricity").alias("diameter"))


@query("graph_distance_table", f"WITH {_TREE} SELECT MIN(e) AS radius, MAX(e) AS diameter FROM (SELECT r, MAX(d) AS e FROM a GROUP BY r)")
def graph_distance_table(t):
    """Eccentricity from a table of distances: from each region to all that is sold in it."""
    down = sales_tree(t)
    nations = down.where("weight = 1.0 AND src < 100").select(F.col("src").alias("a"), F.col("dst").alias("n"))
    customers = down.where("src >= 100 AND src < 1000000000").select(F.col("src").alias("n"), F.col("dst").alias("c"), F.col("weight").alias("w1"))
    orders = down.where("src >= 1000000000").select(F.col("src").alias("c"), F.col("dst").alias("b"), F.col("weight").alias("w2"))
    dist = nations.join(customers, "n").join(orders, "c").select("a", "b", (F.col("w1") + F.col("w2") + 1.0).alias("distance"))
    return G.radius_diameter(dist)
