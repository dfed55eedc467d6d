"""Queries: reshaping, splitting, completing, nesting."""

from pyspark.sql import functions as F

from cohortspark.operators import reshape as R
from cohortspark.operators import verbs as V
from cohortspark.plans.book_tables import LINE, Q_NA, line_na
from cohortspark.plans.registry import query

_NA = f"(SELECT *, {Q_NA} AS q FROM lineitem)"


@query("gather_measures", f"""SELECT l_returnflag, measure, COUNT(*) AS n, ROUND(SUM(value), 4) AS total FROM
(SELECT l_returnflag, 'q' AS measure, q AS value FROM {_NA} WHERE q IS NOT NULL UNION ALL SELECT l_returnflag, 'l_discount', l_discount FROM lineitem
UNION ALL SELECT l_returnflag, 'l_tax', l_tax FROM lineitem) GROUP BY 1, 2""")
def gather_measures(t):
    base = line_na(t).select("l_returnflag", "q", "l_discount", "l_tax")
    long = R.gather(base, "measure", "value", ["-l_returnflag"], na_rm=True)
    return long.groupBy("l_returnflag", "measure").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("gather_number_keys", """SELECT c_custkey, CAST(k AS INT) AS k, v FROM (SELECT c_custkey, '1' AS k, c_acctbal AS v FROM customer UNION ALL SELECT c_custkey, '2', CAST(c_nationkey AS DOUBLE) FROM customer)""")
def gather_number_keys(t):
    base = t.customer.select("c_custkey", F.col("c_acctbal").alias("1"), F.col("c_nationkey").cast("double").alias("2"))
    return R.gather(base, "k", "v", ["1", "2"], convert=True)


@query("spread_levels", """SELECT user_id, MAX(v) FILTER (event_type = 'click') AS click, MAX(v) FILTER (event_type = 'error') AS error, MAX(v) FILTER (event_type = 'purchase') AS purchase,
MAX(v) FILTER (event_type = 'signup') AS signup, MAX(v) FILTER (event_type = 'view') AS view FROM (SELECT user_id, event_type, MAX(value) AS v FROM events GROUP BY 1, 2) GROUP BY 1""")
def spread_levels(t):
    cells = t.events.groupBy("user_id", "event_type").agg(F.max("value").alias("v"))
    return R.spread(cells, "event_type", "v")


@query("spread_fill", """SELECT s_nationkey::BIGINT AS s_nationkey, COUNT(*) FILTER (b) AS "true", COUNT(*) FILTER (NOT b) AS "false" FROM (SELECT s_nationkey, s_acctbal < 1000 AS b FROM supplier) GROUP BY 1""")
def spread_fill(t):
    cells = t.supplier.groupBy(F.col("s_nationkey").cast("bigint").alias("s_nationkey"), (F.col("s_acctbal") < 1000).cast("string").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return R.spread(cells, "b", "n", fill=0, levels=["true", "false"])


@query("gather_spread_identity", "SELECT s_suppkey, s_acctbal, CAST(s_nationkey AS DOUBLE) AS s_nationkey FROM supplier")
def gather_spread_identity(t):
    base = t.supplier.select("s_suppkey", "s_acctbal", F.col("s_nationkey").cast("double").alias("s_nationkey"))
    return R.spread(R.gather(base, "k", "v", ["s_acctbal", "s_nationkey"]), "k", "v", levels=["s_acctbal", "s_nationkey"])


@query("separate_by_regex", """SELECT o_orderkey, split_part(o_orderpriority, '-', 1)::INT AS rank, substr(o_orderpriority, instr(o_orderpriority, '-') + 1) AS word FROM orders""")
def separate_by_regex(t):
    return R.separate(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["rank", "word"], "-", convert=True)


@query("separate_by_position", """SELECT c_custkey, substr(c_name, 1, 8) AS a, substr(c_name, 9, length(c_name) - 11) AS b, substr(c_name, length(c_name) - 2) AS c FROM customer""")
def separate_by_position(t):
    return R.separate(t.customer.select("c_custkey", "c_name"), "c_name", ["a", "b", "c"], [8, -3])


@query("separate_rows_words", "SELECT p_partkey, UNNEST(string_split(p_name, ' ')) AS p_name FROM part")
def separate_rows_words(t):
    return R.separate_rows(t.part.select("p_partkey", "p_name"), "p_name", " ")


@query("extract_groups", r"""SELECT page_id, regexp_extract(url, '^(https?)://([^/]+)', 1) AS scheme, regexp_extract(url, '^(https?)://([^/]+)', 2) AS host FROM pages""")
def extract_groups(t):
    return R.extract(t.pages.select("page_id", "url"), "url", ["scheme", "host"], "^(https?)://([^/]+)")


@query("unite_columns", f"""SELECT l_orderkey, l_returnflag || '/' || l_linestatus || '/' || COALESCE(CAST(CAST(q AS BIGINT) AS VARCHAR), 'NA') AS code FROM {_NA}""")
def unite_columns(t):
    base = line_na(t).select("l_orderkey", "l_returnflag", "l_linestatus", F.col("q").cast("bigint").alias("q"))
    return R.unite(base, "code", ["l_returnflag", "l_linestatus", "q"], "/")


@query("parse_number_text", """SELECT c_custkey, CAST(substr(c_name, 10) AS DOUBLE) AS id, c_acctbal AS bal FROM customer""")
def parse_number_text(t):
    money = F.concat(F.lit("USD "), F.format_number("c_acctbal", 2), F.lit(" in all"))
    return t.customer.select("c_custkey", R.parse_number("c_name").alias("id"), R.parse_number(money).alias("bal"))


@query("complete_grid", """SELECT y, p.o_orderpriority, COALESCE(n, 0) AS n FROM (SELECT DISTINCT o_custkey AS y FROM orders) CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p
LEFT JOIN (SELECT o_custkey, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2) c ON c.o_custkey = y AND c.o_orderpriority = p.o_orderpriority""")
def complete_grid(t):
    counts = t.orders.groupBy(F.col("o_custkey").alias("y"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return R.complete(counts, "y", "o_orderpriority", fill={"n": 0})


@query("expand_nesting", """SELECT f, s, p FROM (SELECT DISTINCT l_returnflag AS f, l_linestatus AS s FROM lineitem) CROSS JOIN (SELECT DISTINCT o_orderpriority AS p FROM orders)""")
def expand_nesting(t):
    base = t.lineitem.select(F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s"))
    return V.crossing(R.nesting(base, "f", "s"), t.orders.select(F.col("o_orderpriority").alias("p")))


@query("full_sequence", """SELECT p_brand, CAST(UNNEST(range(MIN(p_size), MAX(p_size) + 1, 5)) AS BIGINT) AS p_size FROM part GROUP BY 1""")
def full_sequence(t):
    return R.full_seq(t.part, "p_size", 5, ["p_brand"]).withColumn("p_size", F.col("p_size").cast("bigint"))


@query("full_sequence_dates", """SELECT strftime(UNNEST(range(MIN(d), MAX(d) + INTERVAL 1 DAY, INTERVAL 7 DAY)), '%Y-%m-%d') AS d FROM (SELECT o_orderdate AS d FROM orders)""")
def full_sequence_dates(t):
    days = t.orders.select(F.to_date("o_orderdate").alias("d"))
    return R.full_seq(days, "d", "INTERVAL 7 DAY").withColumn("d", F.date_format("d", "yyyy-MM-dd"))


@query("nest_rows", """SELECT o_custkey, chunk, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS keys, COUNT(*) AS n FROM (SELECT o_custkey, o_orderkey, (ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 500 + 1 AS chunk FROM orders) GROUP BY 1, 2""")
def nest_rows(t):
    cells = R.nest(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "data", ["o_orderkey"], rows_per_cell=500)
    return cells.select("o_custkey", "chunk", F.array_join(F.transform("data", lambda s: s["o_orderkey"].cast("string")), ",").alias("keys"), F.size("data").cast("bigint").alias("n"))


@query("nest_in_chunks", """SELECT o_orderstatus, (r - 1) // 1000 + 1 AS chunk, COUNT(*) AS n, MIN(o_orderkey) AS first FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS r FROM orders) GROUP BY 1, 2""")
def nest_in_chunks(t):
    cells = R.nest(t.orders.select("o_orderstatus", "o_orderkey"), ["o_orderstatus"], "data", ["o_orderkey"], rows_per_cell=1000)
    return cells.select("o_orderstatus", "chunk", F.size("data").cast("bigint").alias("n"), F.get("data", F.lit(0))["o_orderkey"].alias("first"))


@query("unnest_cells", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def unnest_cells(t):
    return R.unnest(R.nest(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "data", ["o_orderkey"], rows_per_cell=500), "data").drop("chunk")


@query("uncount_rows", "SELECT p_partkey, CAST(UNNEST(range(1, p_size + 1)) AS BIGINT) AS id FROM part")
def uncount_rows(t):
    return R.uncount(t.part.select("p_partkey", "p_size"), "p_size", id="id").withColumn("id", F.col("id").cast("bigint"))


@query("row_to_header", """SELECT pos, a AS "URGENT", b AS n FROM (SELECT ROW_NUMBER() OVER (ORDER BY o_orderkey) + 1 AS pos, o_orderstatus AS a, CAST(o_custkey AS VARCHAR) AS b FROM orders)""")
def row_to_header(t):
    from cohortspark.operators.ordered import row_number
    body = row_number(t.orders, "r", ["o_orderkey"]).select((F.col("r") + 1).alias("pos"), F.col("o_orderstatus").alias("x1"), F.col("o_custkey").cast("string").alias("x2"))
    head = t.region.agg(F.lit(1).cast("bigint").alias("pos"), F.lit("URGENT").alias("x1"), F.lit("n").alias("x2"))
    return R.row_to_names(head.unionByName(body), 1, ["pos"])


@query("remove_empty_rows_cols", f"""SELECT q, l_tax FROM (SELECT CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS q, CASE WHEN l_linenumber IN (3, 4) THEN NULL ELSE l_tax END AS l_tax FROM lineitem) WHERE q IS NOT NULL OR l_tax IS NOT NULL""")
def remove_empty_rows_cols(t):
    base = line_na(t).select("q", F.when(~F.col("l_linenumber").isin(3, 4), F.col("l_tax")).alias("l_tax"), F.lit(None).cast("string").alias("empty"))
    return R.remove_empty(base)


@query("cleaned_names", 'SELECT r_regionkey::BIGINT AS first_name, r_name AS abc, r_name AS percent_successful_2009, r_name AS repeat_value, r_name AS repeat_value_2, r_name AS x FROM region')
def cleaned_names(t):
    n = F.col("r_name")
    raw = t.region.select(F.col("r_regionkey").cast("bigint"), n, n.alias("b"), n.alias("c"), n.alias("d"), n.alias("e")).toDF(
        "firstName", "ábc@!*", "% successful (2009)", "REPEAT VALUE", "REPEAT VALUE", "")
    return R.clean_names(raw)


@query("cube_to_rows", """SELECT label::BIGINT AS label, j, ROUND(SUM(x), 4) AS total FROM (SELECT label, UNNEST(range(1, 65)) AS j, UNNEST(embedding)::DOUBLE AS x FROM embeddings) GROUP BY 1, 2""")
def cube_to_rows(t):
    long = R.cube_to_long(t.embeddings.select("label", F.col("embedding").cast("array<double>").alias("embedding")), "embedding", ["j"], "x")
    return long.groupBy(F.col("label").cast("bigint").alias("label"), F.col("j").cast("bigint").alias("j")).agg(F.round(F.sum("x"), 4).alias("total"))


@query("outer_product_triangle", """WITH v AS (SELECT p_size::BIGINT AS i, COUNT(*) AS x FROM part GROUP BY 1) SELECT a.i, b.i AS j, a.x * b.x AS v FROM v a CROSS JOIN v b WHERE a.i > b.i""")
def outer_product_triangle(t):
    v = t.part.groupBy(F.col("p_size").cast("bigint").alias("i")).agg(F.count(F.lit(1)).alias("x"))
    grid = R.outer(v, v.withColumnsRenamed({"i": "j", "x": "y"}), "v", lambda a, b: a * b)
    return R.lower_tri(grid).select("i", "j", "v")
