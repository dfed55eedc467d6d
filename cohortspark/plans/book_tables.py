"""Queries: columns, rows, joins, sorting, set operations."""

from pyspark.sql import functions as F

from cohortspark.functions import dates as D
from cohortspark.operators import joins as J
from cohortspark.operators import ordered as O
from cohortspark.operators import tabyl as X
from cohortspark.operators import verbs as V
from cohortspark.plans.registry import query

# Line items have no single key; these columns together tell rows apart.
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
Q_NA = "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END"


def line_na(t):
    """Line items with a missing quantity in every third line of an order."""
    return t.lineitem.withColumn("q", F.when(F.col("l_linenumber") != 3, F.col("l_quantity")))


@query("growth_quartile_table", """
WITH yr AS (SELECT o_custkey AS student_id, c_mktsegment AS grp,
       year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS academic_year,
       SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS score
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
g AS (SELECT *, score - LAG(score) OVER (PARTITION BY student_id ORDER BY academic_year) AS growth FROM yr),
q AS (SELECT *, NTILE(4) OVER (PARTITION BY academic_year ORDER BY growth, student_id) AS quartile
      FROM g WHERE growth IS NOT NULL)
SELECT grp, quartile, COUNT(*) AS n,
       ROUND(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY grp), 6) AS percent
FROM q GROUP BY grp, quartile""")
def growth_quartile_table(t):
    score = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("score")
    # sum the orders per student and year before the customer join: less to shuffle
    per = t.orders.groupBy(F.col("o_custkey").alias("student_id"), D.academic_year("o_orderdate").alias("academic_year")).agg(score)
    per = per.join(t.customer.select(F.col("c_custkey").alias("student_id"), F.col("c_mktsegment").alias("grp")), "student_id")
    growth = O.diff(per, "score", "growth", ["academic_year"], ["student_id"], small_groups=True).where(F.col("growth").isNotNull())
    parts = O.ntile(growth, "quartile", 4, ["growth", "student_id"], ["academic_year"])
    wide = X.tabyl(parts, "grp", "quartile", levels=[1, 2, 3, 4])
    total = sum(F.col(str(q)) for q in (1, 2, 3, 4))
    cells = F.array(*[F.struct(F.lit(q).cast("bigint").alias("quartile"), F.col(str(q)).alias("n"), F.round(F.col(str(q)) / total, 6).alias("percent"))
                      for q in (1, 2, 3, 4)])
    return wide.select("grp", F.inline(cells))


# ---------------------------------------------------------------- columns

@query("select_rename", "SELECT l_orderkey, l_partkey, l_suppkey, l_tax, l_returnflag AS flag FROM lineitem")
def select_rename(t):
    return V.select(t.lineitem, "l_orderkey:l_suppkey", "l_tax", flag="l_returnflag")


@query("select_helpers", """SELECT l_orderkey, l_partkey, l_suppkey, l_discount, l_linenumber, l_linestatus, l_shipdate::VARCHAR AS l_shipdate
FROM lineitem""")
def select_helpers(t):
    out = V.select(t.lineitem, V.ends_with("key"), V.contains("disc"), V.matches("^l_line"), V.one_of("l_shipdate", "absent"), V.last_col(),
                   "-l_quantity")
    return out.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))


@query("select_if_numeric", "SELECT c_custkey AS C_CUSTKEY, c_nationkey AS C_NATIONKEY, c_acctbal AS C_ACCTBAL FROM customer")
def select_if_numeric(t):
    return V.select_if(t.customer, V.is_numeric, str.upper)


@query("mutate_transmute", """SELECT CAST(net AS DOUBLE) AS net, CAST(net * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) AS gross
FROM (SELECT l_tax, CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net FROM lineitem)""")
def mutate_transmute(t):
    dec = lambda c, p: F.col(c).cast(f"decimal({p},2)")
    return V.transmute(t.lineitem, net=dec("l_extendedprice", 12) * (1 - dec("l_discount", 4)),
                       gross=(F.col("net") * (1 + dec("l_tax", 4))).cast("double")).withColumn("net", F.col("net").cast("double"))


@query("mutate_at_columns", """SELECT p_partkey, p_size * 10 AS p_size, upper(p_name) AS p_name FROM part""")
def mutate_at_columns(t):
    out = V.mutate_at(V.select(t.part, "p_partkey", "p_size", "p_name"), ["p_size"], lambda c: c * 10)
    return V.mutate_at(out, V.is_string, F.upper)


@query("filter_rows", "SELECT o_orderkey FROM orders WHERE o_totalprice > 250000 AND o_orderstatus = 'F'")
def filter_rows(t):
    return V.filter(t.orders, F.col("o_totalprice") > 250000, F.col("o_orderstatus") == "F").select("o_orderkey")


@query("filter_by_group_mean", """SELECT o_orderkey FROM (SELECT o_orderkey, o_totalprice,
AVG(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderpriority) AS m FROM orders) WHERE o_totalprice > m""")
def filter_by_group_mean(t):
    mean = F.avg(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return V.filter(t.orders, F.col("o_totalprice") > F.col("m"), by=["o_orderpriority"], m=mean).select("o_orderkey")


@query("filter_at_any", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount >= 0.09 OR l_tax >= 0.09")
def filter_at_any(t):
    out = V.filter_at(t.lineitem, ["l_discount", "l_tax"], lambda c: c >= 0.09, "any")
    return out.select("l_orderkey", F.col("l_linenumber"))


@query("membership_never_na", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, COALESCE(({Q_NA}) IN (1, 2, 3), FALSE) AS hit FROM lineitem""")
def membership_never_na(t):
    return line_na(t).select(*LINE[:4], V.is_in("q", [1, 2, 3]).alias("hit"))


@query("membership_in_table", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def membership_in_table(t):
    return V.in_table(t.customer, "c_custkey", t.orders, "o_custkey").select("c_custkey")


@query("between_near", """SELECT l_orderkey, l_quantity BETWEEN 10 AND 20 AS mid,
ABS(l_discount + l_tax - 0.1) < 1.5e-8 AS tenth FROM lineitem""")
def between_near(t):
    return t.lineitem.select("l_orderkey", V.between("l_quantity", 10, 20).alias("mid"),
                             V.near(F.col("l_discount") + F.col("l_tax"), F.lit(0.1)).alias("tenth"))


@query("case_when_if_else", f"""SELECT l_orderkey, CASE WHEN q < 10 THEN 'low' WHEN q < 40 THEN 'mid' ELSE 'other' END AS size,
CASE WHEN q > 25 THEN 'yes' WHEN NOT q > 25 THEN 'no' ELSE 'unknown' END AS big FROM (SELECT l_orderkey, {Q_NA} AS q FROM lineitem)""")
def case_when_if_else(t):
    q = F.col("q")
    return line_na(t).select("l_orderkey", V.case_when((q < 10, "low"), (q < 40, "mid"), default="other").alias("size"),
                             V.if_else(q > 25, F.lit("yes"), F.lit("no"), F.lit("unknown")).alias("big"))


@query("coalesce_na_if", f"""SELECT l_orderkey, COALESCE({Q_NA}, l_tax * 100, 0) AS first_known, NULLIF(l_linestatus, 'F') AS open_only,
CASE WHEN l_returnflag IN ('N') THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem""")
def coalesce_na_if(t):
    from cohortspark.functions import na
    out = line_na(t).select("l_orderkey", na.coalesce("q", F.col("l_tax") * 100, F.lit(0.0)).alias("first_known"),
                            na.na_if("l_linestatus", "F").alias("open_only"), "l_returnflag")
    flags = V.convert_to_na(out.select("l_orderkey", "first_known", "open_only", "l_returnflag"), ["N"])
    return flags


@query("recode_values", """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'rest' END AS status,
CASE o_orderpriority WHEN '1-URGENT' THEN 'now' ELSE o_orderpriority END AS priority FROM orders""")
def recode_values(t):
    return t.orders.select("o_orderkey", V.recode("o_orderstatus", {"F": "final", "O": "open"}, default="rest").alias("status"),
                           V.recode("o_orderpriority", {"1-URGENT": "now"}).alias("priority"))


@query("recode_from_table", "SELECT c_custkey, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey")
def recode_from_table(t):
    c = t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    return V.recode_from(c, "nation", t.nation.select(F.col("n_nationkey").cast("string").alias("k"), "n_name"), "k", "n_name")


@query("replace_drop_na", f"""SELECT l_returnflag, COUNT(*) AS n, SUM(COALESCE(q, 0)) AS total, COUNT(q) AS known
FROM (SELECT l_returnflag, {Q_NA} AS q FROM lineitem) GROUP BY 1""")
def replace_drop_na(t):
    base = line_na(t).select("l_returnflag", "q")
    known = V.drop_na(base, ["q"]).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("known"))
    full = V.replace_na(base, {"q": 0}).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("total"))
    return full.join(known, "l_returnflag")


@query("rowwise_over_columns", f"""SELECT l_orderkey, l_linenumber, l_partkey, GREATEST(l_discount, l_tax) AS hi, LEAST(l_discount, l_tax) AS lo,
ROUND((l_discount + l_tax) / 2, 6) AS mean FROM lineitem""")
def rowwise_over_columns(t):
    cols = ["l_discount", "l_tax"]
    out = V.rowwise_agg(V.rowwise_agg(V.rowwise_agg(t.lineitem, "hi", cols, "max"), "lo", cols, "min"), "mean", cols, "mean")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "hi", "lo", F.round("mean", 6).alias("mean"))


@query("translated_operators", """SELECT p_partkey, (p_size % 7)::BIGINT AS rest, ROUND(POWER(p_size, 2), 6) AS square, ROUND(LN(p_size) / LN(2), 6) AS log2_size,
SUBSTRING(p_name, 1, 3) AS head, p_name LIKE '%ring' AS is_ring, (p_size > 10 AND p_size < 20) OR p_size = 1 AS pick FROM part""")
def translated_operators(t):
    s = F.col("p_size")
    return t.part.select("p_partkey", (s % 7).cast("bigint").alias("rest"), F.round(F.pow(s, F.lit(2)), 6).alias("square"),
                         F.round(F.log(2.0, s), 6).alias("log2_size"), F.substring("p_name", 1, 3).alias("head"),
                         F.col("p_name").like("%ring").alias("is_ring"), (((s > 10) & (s < 20)) | (s == 1)).alias("pick"))


# ------------------------------------------------------------ rows, edits

@query("slice_positions", """SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey,
ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r IN (1, 3)""")
def slice_positions(t):
    return V.slice(t.orders, [1, 3], ["o_orderdate", "o_orderkey"], ["o_custkey"]).select("o_custkey", "o_orderkey")


@query("slice_drop", """SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey,
ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r NOT IN (1, 2)""")
def slice_drop(t):
    return V.slice(t.orders, [-1, -2], ["o_orderdate", "o_orderkey"], ["o_custkey"]).select("o_custkey", "o_orderkey")


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t):
    return V.distinct(t.lineitem, ["l_returnflag", "l_linestatus"])


@query("distinct_keep_all", """SELECT user_id, event_type, event_id, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type
ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""")
def distinct_keep_all(t):
    return V.distinct(t.events, ["user_id", "event_type"], True, ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("match_rows", """SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA')""")
def match_rows(t):
    asia = t.nation.join(t.region.where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return V.match_rows(t.supplier, asia.select(F.col("n_nationkey").alias("s_nationkey")), ["s_nationkey"]).select("s_suppkey")


@query("sample_rows_per_group", "SELECT o_orderpriority, 100::BIGINT AS n FROM orders GROUP BY 1 HAVING COUNT(*) >= 100")
def sample_rows_per_group(t):
    drawn = V.sample_n(t.orders, 100, ["o_orderpriority"], seed=7)
    return drawn.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("sample_weighted")
def sample_weighted(t):
    return V.sample_n(t.orders, 50, ["o_orderstatus"], weight="o_totalprice", seed=3).select("o_orderstatus", "o_orderkey")


@query("sample_replace")
def sample_replace(t):
    return V.sample_n(t.customer, 40, ["c_mktsegment"], seed=3, replace=True).select("c_mktsegment", "c_custkey")


@query("sample_draw_shares", """SELECT o_orderstatus, o_orderpriority, 30000 AS draws, TRUE AS holds FROM orders GROUP BY 1, 2""")
def sample_draw_shares(t):
    """Whether weighted draws give each priority its share of the price, give or take five standard errors."""
    n = 30_000
    drawn = V.sample_n(t.orders, n, ["o_orderstatus"], weight="o_totalprice", seed=11, replace=True)
    group = ["o_orderstatus", "o_orderpriority"]
    got = drawn.groupBy(*group).agg(F.count(F.lit(1)).alias("got"))
    got = O.recycle(got, ["o_orderstatus"], draws=F.sum("got"))
    want = t.orders.groupBy(*group).agg(F.sum("o_totalprice").alias("w"))
    want = O.recycle(want, ["o_orderstatus"], all=F.sum("w")).withColumn("p", F.col("w") / F.col("all"))
    off = 5 * F.sqrt(F.col("p") * (1 - F.col("p")) / n)
    return want.join(got, group, "left").select(*group, F.col("draws").cast("int").alias("draws"), (F.abs(F.col("got") / n - F.col("p")) <= off).alias("holds"))


@query("sample_fraction", "SELECT o_orderpriority, CAST(ROUND(COUNT(*) * 0.1) AS BIGINT) AS n FROM orders GROUP BY 1")
def sample_fraction(t):
    return V.sample_frac(t.orders, 0.1, ["o_orderpriority"], seed=3).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("pull_column", "SELECT c_name FROM customer")
def pull_column(t):
    return V.pull(t.customer, "c_name")


@query("add_rows_columns", """SELECT r_regionkey::BIGINT AS r_regionkey, r_name, length(r_name) AS width FROM
(SELECT r_regionkey, r_name FROM region UNION ALL SELECT 99, 'ATLANTIS')""")
def add_rows_columns(t):
    out = V.add_row(t.region, r_regionkey=99, r_name="ATLANTIS")
    return V.add_column(out, "width", F.length("r_name").cast("bigint")).withColumn("r_regionkey", F.col("r_regionkey").cast("bigint"))


@query("rowid_column", "SELECT ROW_NUMBER() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rowid, c_custkey FROM customer")
def rowid_column(t):
    return V.rowid_to_column(t.customer.select("c_custkey", "c_acctbal"), ["-c_acctbal", "c_custkey"]).select("rowid", "c_custkey")


@query("repaired_names", "SELECT r_regionkey AS x, r_name AS x_1, r_name AS a, r_name AS a_1 FROM region")
def repaired_names(t):
    return t.region.select("r_regionkey", "r_name", F.col("r_name").alias("a1"), F.col("r_name").alias("a2")).toDF(
        *V.repair_names(["", "", "a", "a"]))


@query("upsert_by_key", """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer
UNION ALL SELECT s_suppkey + 10000000, s_acctbal FROM supplier""")
def upsert_by_key(t):
    base = t.customer.select("c_custkey", "c_acctbal")
    fixed = base.where("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0))
    new = t.supplier.select((F.col("s_suppkey") + 10000000).alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return V.upsert_rows(base, fixed.unionByName(new), "c_custkey")


@query("append_next_ids", """SELECT c_custkey, c_name FROM customer UNION ALL
SELECT (SELECT MAX(c_custkey) FROM customer) + ROW_NUMBER() OVER (ORDER BY s_suppkey), s_name FROM supplier""")
def append_next_ids(t):
    rows = t.supplier.select(F.col("s_name").alias("c_name"), "s_suppkey")
    return V.append_with_id(t.customer.select("c_custkey", "c_name"), rows, "c_custkey", ["s_suppkey"])


@query("delete_by_key", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def delete_by_key(t):
    keys = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return V.delete_rows(t.orders.select("o_orderkey"), keys, "o_orderkey")


@query("keyed_lookup", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation WHERE n_name = 'NATION_7'")
def keyed_lookup(t):
    return V.lookup(t.nation, "n_name", "NATION_7").select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name")


@query("required_fields", f"""SELECT errors, COUNT(*) AS n FROM (SELECT CONCAT_WS(',', CASE WHEN q IS NULL THEN 'q' END,
CASE WHEN l_tax = 0 THEN 'l_tax' END) AS errors FROM (SELECT l_tax, {Q_NA} AS q FROM lineitem)) GROUP BY 1""")
def required_fields(t):
    out = V.validate_required(line_na(t), ["q", "l_tax"])
    return out.groupBy(F.array_join("errors", ",").alias("errors")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ joins

@query("inner_join", """SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def inner_join(t):
    return J.inner_join(t.orders, t.customer, {"o_custkey": "c_custkey"}).select("o_orderkey", "c_name")


@query("left_join", """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey""")
def left_join(t):
    return J.left_join(t.customer, t.orders, {"c_custkey": "o_custkey"}).select("c_custkey", "o_orderkey")


@query("right_join", "SELECT l_linenumber, o_orderkey FROM lineitem RIGHT JOIN orders ON l_orderkey = o_orderkey")
def right_join(t):
    return J.right_join(t.lineitem, t.orders, {"l_orderkey": "o_orderkey"}).select("l_linenumber", F.col("l_orderkey").alias("o_orderkey"))


@query("full_join", """SELECT COALESCE(a.k, b.k) AS k, a.n AS "n.x", b.n AS "n.y" FROM
(SELECT l_orderkey AS k, COUNT(*) AS n FROM lineitem GROUP BY 1) a FULL JOIN
(SELECT o_custkey AS k, COUNT(*) AS n FROM orders GROUP BY 1) b ON a.k = b.k""")
def full_join(t):
    side = lambda df, c: df.groupBy(F.col(c).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return J.full_join(side(t.lineitem, "l_orderkey"), side(t.orders, "o_custkey"), ["k"])


@query("semi_join", "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def semi_join(t):
    return J.semi_join(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"}).select("o_orderkey")


@query("anti_join", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_join(t):
    return J.anti_join(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"}).select("o_orderkey")


@query("natural_join", """SELECT label::BIGINT AS label, COUNT(*) AS n FROM (SELECT label, vec_id AS doc_id FROM embeddings) JOIN labels USING (doc_id) GROUP BY 1""")
def natural_join(t):
    e = t.embeddings.select("label", F.col("vec_id").alias("doc_id"))
    return J.inner_join(e, t.labels).groupBy(F.col("label").cast("bigint").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("join_na_matches_na", f"""WITH a AS (SELECT q, COUNT(*) AS n FROM (SELECT {Q_NA} AS q FROM lineitem) GROUP BY q),
b AS (SELECT q, SUM(p) AS p FROM (SELECT {Q_NA} AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem) GROUP BY q)
SELECT a.q, n, CAST(p AS DOUBLE) AS p FROM a JOIN b ON a.q IS NOT DISTINCT FROM b.q""")
def join_na_matches_na(t):
    base = line_na(t)
    a = base.groupBy("q").agg(F.count(F.lit(1)).alias("n"))
    b = base.groupBy("q").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("p"))
    return J.inner_join(a, b, ["q"])


@query("join_na_never_matches", f"""WITH a AS (SELECT q, COUNT(*) AS n FROM (SELECT {Q_NA} AS q FROM lineitem) GROUP BY q)
SELECT a.q, a.n AS "n.x", b.n AS "n.y" FROM a LEFT JOIN a b ON a.q = b.q""")
def join_na_never_matches(t):
    a = line_na(t).groupBy("q").agg(F.count(F.lit(1)).alias("n"))
    return J.left_join(a, a, ["q"], na_matches="never")


@query("join_factor_with_string", "SELECT p_partkey, s AS type_n, level FROM part JOIN (SELECT p_type AS ty, COUNT(*) AS s, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, p_type) AS level FROM part GROUP BY 1) ON ty = p_type")
def join_factor_with_string(t):
    from cohortspark.operators import factors as C
    typed = C.level_number(t.part, "p_type", C.levels_infreq(t.part, "p_type"))
    counts = C.fct_count(t.part, "p_type").withColumnRenamed("n", "type_n")
    return J.inner_join(typed, counts, ["p_type"]).select("p_partkey", "type_n", F.col("p_type_level").alias("level"))


@query("crossing_values", """SELECT * FROM (SELECT DISTINCT l_returnflag FROM lineitem) CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders)
CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer)""")
def crossing_values(t):
    return V.crossing(t.lineitem.select("l_returnflag"), t.orders.select("o_orderpriority"), t.customer.select("c_mktsegment"))


@query("join_all_first", """SELECT c_custkey, o_orderkey, event_id FROM customer
LEFT JOIN (SELECT o_custkey, o_orderkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) r FROM orders) WHERE r = 1) ON o_custkey = c_custkey
LEFT JOIN (SELECT user_id, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) r FROM events) WHERE r = 1) ON user_id = c_custkey""")
def join_all_first(t):
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderkey").alias("pick"))
    e = t.events.select(F.col("user_id").alias("c_custkey"), "event_id", F.col("event_id").alias("pick"))
    out = J.join_all([t.customer.select("c_custkey"), o, e], ["c_custkey"], "left", "first", ["pick"])
    return out.select("c_custkey", "o_orderkey", "event_id")


@query("nearest_score", """WITH x AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'view'),
y AS (SELECT user_id, value AS v, MIN(event_id) AS e FROM events WHERE event_type = 'click' GROUP BY 1, 2),
c AS (SELECT x.event_id, y.e AS near_id, ROW_NUMBER() OVER (PARTITION BY x.event_id ORDER BY
  CASE WHEN y.e IS NULL THEN 1 ELSE 0 END, ABS(y.v - x.value), y.v) AS r FROM x LEFT JOIN y ON x.user_id = y.user_id)
SELECT event_id, near_id FROM c WHERE r = 1""")
def nearest_score(t):
    x = t.events.where("event_type = 'view'").select("event_id", "user_id", "value")
    y = t.events.where("event_type = 'click'").select("user_id", F.col("value").alias("v"), F.col("event_id").alias("near_id"))
    return J.nearest_join(x, y, ["user_id"], "value", y_on="v", order=["near_id"]).select("event_id", "near_id")


@query("asof_previous_purchase", """SELECT a.event_id, b.event_id AS last_purchase FROM (SELECT * FROM events WHERE event_type = 'error') a
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') b ON a.user_id = b.user_id AND a.ts >= b.ts""")
def asof_previous_purchase(t):
    x = t.events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    y = t.events.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("last_purchase"))
    return J.asof_last(x, y, ["user_id"], "ts").select("event_id", "last_purchase")


@query("band_lookup", """WITH n AS (SELECT o_orderpriority AS subject, CAST(FLOOR(o_totalprice / 20000) AS BIGINT) AS band, COUNT(*) AS norm_n
FROM orders WHERE o_totalprice BETWEEN 60000 AND 400000 GROUP BY 1, 2),
e AS (SELECT subject, MIN(band) AS lo, MAX(band) AS hi FROM n GROUP BY 1),
x AS (SELECT o_orderkey, o_orderpriority AS subject, CAST(FLOOR(o_totalprice / 20000) AS BIGINT) AS band FROM orders)
SELECT o_orderkey, x.band, norm_n FROM x JOIN e USING (subject) LEFT JOIN n ON n.subject = x.subject AND n.band = LEAST(GREATEST(x.band, lo), hi)""")
def band_lookup(t):
    x = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("subject"), F.floor(F.col("o_totalprice") / 20000).alias("band"), "o_totalprice")
    norms = x.where(F.col("o_totalprice").between(60000, 400000)).groupBy("subject", "band").agg(F.count(F.lit(1)).alias("norm_n"))
    return J.norm_lookup(x, norms, ["subject"], "band").select("o_orderkey", "band", "norm_n")


# shipping spans per order: first to last ship date
_SPAN = "SELECT l_orderkey, l_suppkey AS s, MIN(l_shipdate) AS a, MAX(l_shipdate) + INTERVAL 3 DAY AS b FROM lineitem GROUP BY 1, 2"


def _spans(t):
    return t.lineitem.groupBy("l_orderkey", F.col("l_suppkey").alias("s")).agg(
        F.min("l_shipdate").alias("a"), (F.max("l_shipdate") + F.expr("INTERVAL 3 DAY")).alias("b"))


@query("within_interval_join", f"""SELECT l_orderkey, s, COUNT(*) AS n FROM ({_SPAN}) i JOIN
(SELECT DISTINCT l_suppkey, l_shipdate AS d FROM lineitem WHERE l_returnflag = 'R') p ON p.l_suppkey = i.s AND d BETWEEN a AND b GROUP BY 1, 2""")
def within_interval_join(t):
    p = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("s"), F.col("l_shipdate").alias("d")).distinct()
    return J.within_join(p, _spans(t), "d", "a", "b", ["s"]).groupBy("l_orderkey", "s").agg(F.count(F.lit(1)).alias("n"))


@query("overlap_interval_join", """WITH x AS (SELECT o_custkey AS k, o_orderkey AS xo, o_orderdate AS a, o_orderdate + INTERVAL 30 DAY AS b FROM orders WHERE o_orderstatus = 'F'),
y AS (SELECT o_custkey AS k, o_orderkey AS yo, o_orderdate AS c, o_orderdate + INTERVAL 45 DAY AS d FROM orders WHERE o_orderstatus = 'O')
SELECT x.k, xo, yo FROM x JOIN y ON x.k = y.k AND a <= d AND c <= b""")
def overlap_interval_join(t):
    x = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("xo"), F.col("o_orderdate").alias("a"),
                                                     F.expr("o_orderdate + INTERVAL 30 DAY").alias("b"))
    y = t.orders.where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("yo"), F.col("o_orderdate").alias("c"),
                                                     F.expr("o_orderdate + INTERVAL 45 DAY").alias("d"))
    return J.overlap_join(x, y, ("a", "c"), ("b", "d"), ["k"]).select("k", "xo", "yo")


def _interval_sets(t):
    days = lambda status, n: t.orders.where(F.col("o_orderstatus") == status).select(
        "o_custkey", F.datediff("o_orderdate", F.lit("1995-01-01")).cast("bigint").alias("start"),
        (F.datediff("o_orderdate", F.lit("1995-01-01")) + n).cast("bigint").alias("end"))
    return days("F", 20), days("O", 40)


# day by day: a day belongs to a set when one of its intervals covers it
_DAYS = """WITH f AS (SELECT DISTINCT o_custkey, UNNEST(range(d, d + 20)) AS day FROM (SELECT o_custkey, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS d FROM orders WHERE o_orderstatus = 'F')),
o AS (SELECT DISTINCT o_custkey, UNNEST(range(d, d + 40)) AS day FROM (SELECT o_custkey, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS d FROM orders WHERE o_orderstatus = 'O'))
"""


@query("interval_setdiff", _DAYS + """, k AS (SELECT * FROM f EXCEPT SELECT * FROM o),
g AS (SELECT *, day - ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY day) AS run FROM k)
SELECT o_custkey, MIN(day) AS "start", MAX(day) + 1 AS "end" FROM g GROUP BY o_custkey, run""")
def interval_setdiff(t):
    x, y = _interval_sets(t)
    return J.interval_setdiff(x, y, ["o_custkey"])


@query("interval_intersect", _DAYS + """, k AS (SELECT * FROM f INTERSECT SELECT * FROM o),
g AS (SELECT *, day - ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY day) AS run FROM k)
SELECT o_custkey, MIN(day) AS "start", MAX(day) + 1 AS "end" FROM g GROUP BY o_custkey, run""")
def interval_intersect(t):
    x, y = _interval_sets(t)
    return J.interval_intersect(x, y, ["o_custkey"])


@query("interval_contained", _DAYS + "SELECT DISTINCT o_custkey FROM f WHERE o_custkey NOT IN (SELECT o_custkey FROM (SELECT * FROM f EXCEPT SELECT * FROM o))")
def interval_contained(t):
    x, y = _interval_sets(t)
    return J.interval_contained(x, y, ["o_custkey"])


@query("interval_bound_kinds", """SELECT l_returnflag, COUNT(*) FILTER (l_quantity >= 10 AND l_quantity <= 20) AS closed, COUNT(*) FILTER (l_quantity >= 10 AND l_quantity < 20) AS right_open,
COUNT(*) FILTER (l_quantity > 10 AND l_quantity <= 20) AS left_open, COUNT(*) FILTER (l_quantity > 10 AND l_quantity < 20) AS open_both FROM lineitem GROUP BY 1""")
def interval_bound_kinds(t):
    q = F.col("l_quantity")
    test = lambda b: F.count_if(J.in_bounds(q, F.lit(10), F.lit(20), b))
    return t.lineitem.groupBy("l_returnflag").agg(test("[]").alias("closed"), test("[)").alias("right_open"), test("(]").alias("left_open"), test("()").alias("open_both"))


# ------------------------------------------------------------- sort, top-k

@query("arrange_na_last", f"""SELECT l_orderkey, ROW_NUMBER() OVER (ORDER BY q DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS r
FROM (SELECT *, {Q_NA} AS q FROM lineitem)""")
def arrange_na_last(t):
    ordered = V.arrange(line_na(t), "-q", *LINE)
    return O.row_number(ordered, "r", ["-q", *LINE]).select("l_orderkey", "r")


@query("arrange_nan_after_na", f"""SELECT l_orderkey, ROW_NUMBER() OVER (ORDER BY CASE WHEN l_linenumber = 5 THEN 2 WHEN l_linenumber = 3 THEN 1 ELSE 0 END,
CASE WHEN l_linenumber IN (3, 5) THEN 0 ELSE l_quantity END, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS r FROM lineitem""")
def arrange_nan_after_na(t):
    x = t.lineitem.withColumn("q", F.when(F.col("l_linenumber") == 5, F.lit(float("nan"))).when(F.col("l_linenumber") == 3, None).otherwise(F.col("l_quantity")))
    return O.row_number(x, "r", ["q", *LINE]).select("l_orderkey", "r")


@query("arrange_at_columns", "SELECT s_suppkey, ROW_NUMBER() OVER (ORDER BY s_suppkey, s_nationkey, s_acctbal) AS r FROM supplier")
def arrange_at_columns(t):
    out = V.arrange_at(t.supplier, V.is_numeric)
    return O.row_number(out, "r", ["s_suppkey", "s_nationkey", "s_acctbal"]).select("s_suppkey", "r")


@query("top_n_ties_kept", """SELECT l_returnflag, l_orderkey, l_quantity FROM (SELECT *, RANK() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS r FROM lineitem) WHERE r <= 2""")
def top_n_ties_kept(t):
    return V.top_n(t.lineitem, 2, "l_quantity", ["l_returnflag"]).select("l_returnflag", "l_orderkey", "l_quantity")


@query("bottom_n", """SELECT o_orderpriority, o_orderkey FROM (SELECT *, RANK() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS r FROM orders) WHERE r <= 3""")
def bottom_n(t):
    return V.top_n(t.orders, -3, "o_totalprice", ["o_orderpriority"]).select("o_orderpriority", "o_orderkey")


@query("head_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def head_rows(t):
    return V.head(t.orders, 10, ["-o_totalprice", "o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("tail_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def tail_rows(t):
    return V.tail(t.orders, 10, ["o_totalprice", "-o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("str_sort_bytes", "SELECT p_name, ROW_NUMBER() OVER (ORDER BY p_name) AS r FROM (SELECT DISTINCT p_name FROM part)")
def str_sort_bytes(t):
    names = V.str_sort(t.part.select("p_name").distinct(), "p_name", "UTF8_BINARY")
    return V.str_order(names, "p_name", "r", "UTF8_BINARY")


@query("str_sort_locale")
def str_sort_locale(t):
    return V.str_order(t.part.select("p_name", "p_partkey"), "p_name", "r", "lt")


@query("merge_sorted_tables", """SELECT k, ROW_NUMBER() OVER (ORDER BY k, src) AS r FROM (SELECT c_acctbal AS k, 'c' || c_custkey AS src FROM customer
UNION ALL SELECT s_acctbal, 's' || s_suppkey FROM supplier)""")
def merge_sorted_tables(t):
    c = t.customer.select(F.col("c_acctbal").alias("k"), F.concat(F.lit("c"), F.col("c_custkey")).alias("src"))
    s = t.supplier.select(F.col("s_acctbal").alias("k"), F.concat(F.lit("s"), F.col("s_suppkey")).alias("src"))
    return O.row_number(V.merge_sorted([c, s], "k", "src"), "r", ["k", "src"]).select("k", "r")


# ---------------------------------------------------------------- set ops

_A = "SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 49"
_B = "SELECT DISTINCT l_partkey FROM lineitem WHERE l_discount = 0.1"


def _sets(t):
    return (t.lineitem.where("l_quantity > 49").select("l_partkey"), t.lineitem.where("l_discount = 0.1").select("l_partkey"))


@query("set_intersect", f"{_A} INTERSECT {_B}")
def set_intersect(t):
    return V.intersect(*_sets(t))


@query("set_union", f"{_A} UNION {_B}")
def set_union(t):
    return V.union(*_sets(t))


@query("set_difference", f"{_A} EXCEPT {_B}")
def set_difference(t):
    return V.setdiff(*_sets(t))


@query("union_all_rows", "SELECT l_partkey FROM lineitem WHERE l_quantity > 49 UNION ALL SELECT l_partkey FROM lineitem WHERE l_discount = 0.1")
def union_all_rows(t):
    return V.union_all(*_sets(t))


@query("bind_rows_id", """SELECT 'cust' AS src, c_custkey AS k, c_acctbal AS bal, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'supp', s_suppkey, s_acctbal, NULL FROM supplier""")
def bind_rows_id(t):
    return V.bind_rows({"cust": t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("segment")),
                        "supp": t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("bal"))}, "src")


@query("bind_cols_by_position", """SELECT c_custkey, s_suppkey FROM (SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_custkey) r FROM customer)
FULL JOIN (SELECT s_suppkey, ROW_NUMBER() OVER (ORDER BY s_suppkey DESC) r FROM supplier) USING (r)""")
def bind_cols_by_position(t):
    return V.bind_cols(t.customer.select("c_custkey"), t.supplier.select("s_suppkey"), ["c_custkey"], ["-s_suppkey"])


@query("duplicated_flag", """SELECT event_id, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) > 1 AS duplicated,
COUNT(*) OVER (PARTITION BY user_id, event_type) > 1 AS tied FROM events""")
def duplicated_flag(t):
    out = V.duplicated(t.events, ["user_id", "event_type"], ["ts", "event_id"])
    return V.tied(out, ["user_id", "event_type"]).select("event_id", "duplicated", "tied")


@query("asof_missing_times_and_ties", """SELECT a.event_id, b.e AS last_purchase FROM (SELECT event_id, user_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts FROM events WHERE event_type = 'error') a
ASOF LEFT JOIN (SELECT user_id, date_trunc('day', ts) AS ts, MAX(event_id) AS e FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) b ON a.user_id = b.user_id AND a.ts >= b.ts""")
def asof_missing_times_and_ties(t):
    ts = F.col("ts").cast("timestamp")
    x = t.events.where("event_type = 'error'").select("event_id", "user_id", F.when(F.col("event_id") % 7 != 0, ts).alias("ts"))
    y = t.events.where("event_type = 'purchase'").select("user_id", F.date_trunc("day", ts).alias("ts"), F.col("event_id").alias("last_purchase"))
    return J.asof_last(x, y, ["user_id"], "ts", ties=["last_purchase"]).select("event_id", "last_purchase")


@query("sample_skips_zero_weight", "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 1")
def sample_skips_zero_weight(t):
    weight = F.when(F.col("o_orderkey") % 3 == 1, F.col("o_totalprice")).when(F.col("o_orderkey") % 3 == 2, 0.0)
    return V.sample_n(t.orders.select("o_orderkey", weight.alias("w")), 10_000_000, weight="w").select("o_orderkey")
