"""Queries: list columns and JSON."""

from pyspark.sql import functions as F

from cohortspark.functions import arrays as A
from cohortspark.functions import jsons as Z
from cohortspark.plans.registry import query


def emb(t):
    return t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("e"))


_E = "(SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


def total(c):
    return F.round(F.reduce(c, F.lit(0.0), lambda a, x: a + x), 6)


@query("list_map_sum", f"SELECT vec_id, ROUND(list_sum(list_transform(e, lambda x : x * 2)), 6) AS s, ROUND(list_sum(list_transform(e, lambda x, i : x * i)), 6) AS w FROM {_E}")
def list_map_sum(t):
    return emb(t).select("vec_id", total(A.arr_map("e", lambda x: x * 2)).alias("s"), total(A.arr_imap("e", lambda x, i: x * i)).alias("w"))


@query("list_map_pairs", f"SELECT vec_id, ROUND(list_dot_product(e, e), 6) AS d, ROUND(list_sum(list_transform(list_zip(e, list_reverse(e)), lambda p : p[1] * p[2])), 6) AS r FROM {_E}")
def list_map_pairs(t):
    base = emb(t).withColumn("rev", F.reverse("e"))
    return base.select("vec_id", total(A.arr_map2("e", "e", lambda a, b: a * b)).alias("d"), total(A.arr_pmap(["e", "rev"], lambda a, b: a * b)).alias("r"))


@query("list_modify", f"SELECT vec_id, ROUND(list_sum(list_transform(e, lambda x : CASE WHEN x < 0 THEN -x ELSE x END)), 6) AS a, ROUND(list_sum(list_transform(e, lambda x, i : CASE WHEN i IN (1, 3) THEN x + 1 ELSE x END)), 6) AS b FROM {_E}")
def list_modify(t):
    return emb(t).select("vec_id", total(A.arr_modify_if("e", lambda x: x < 0, lambda x: -x)).alias("a"), total(A.arr_modify_at("e", [1, 3], lambda x: x + 1)).alias("b"))


@query("list_modify_depth", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w : upper(w)), ' ') AS x FROM part")
def list_modify_depth(t):
    nested = F.array(F.split("p_name", " "))
    return t.part.select("p_partkey", F.array_join(F.flatten(A.arr_modify_depth(nested, 2, F.upper)), " ").alias("x"))


@query("list_keep_discard", f"SELECT vec_id, len(list_filter(e, lambda x : x > 0)) AS pos, len(list_filter(e, lambda x : NOT x > 0.1)) AS low FROM {_E}")
def list_keep_discard(t):
    return emb(t).select("vec_id", F.size(A.arr_keep("e", lambda x: x > 0)).cast("bigint").alias("pos"), F.size(A.arr_discard("e", lambda x: x > 0.1)).cast("bigint").alias("low"))


@query("list_compact", f"SELECT vec_id, len(list_filter(e, lambda x : x >= 0)) AS n FROM {_E}")
def list_compact(t):
    return emb(t).select("vec_id", F.size(A.arr_compact(A.arr_map("e", lambda x: F.when(x >= 0, x)))).cast("bigint").alias("n"))


@query("list_reduce_accumulate", "SELECT p_partkey, array_to_string(string_split(p_name, ' '), '>') AS f, array_to_string(list_reverse(string_split(p_name, ' ')), '>') AS r, len(string_split(p_name, ' ')) AS steps, length(replace(p_name, ' ', '')) AS last FROM part")
def list_reduce_accumulate(t):
    w = F.split("p_name", " ")
    join = lambda a, x: F.when(a == "", x).otherwise(F.concat(a, F.lit(">"), x))
    acc = A.arr_accumulate(w, F.lit(0), lambda a, x: a + F.length(x), "bigint")
    return t.part.select("p_partkey", A.arr_reduce(w, "", join).alias("f"), A.arr_reduce_right(w, "", join).alias("r"), F.size(acc).cast("bigint").alias("steps"), F.element_at(acc, -1).alias("last"))


@query("list_quantifiers", f"SELECT vec_id, len(list_filter(e, lambda x : x < 0.25)) = len(e) AS every, len(list_filter(e, lambda x : x > 0.3)) > 0 AS some, list_contains(e, e[1]) AS has FROM {_E}")
def list_quantifiers(t):
    return emb(t).select("vec_id", A.arr_every("e", lambda x: x < 0.25).alias("every"), A.arr_some("e", lambda x: x > 0.3).alias("some"), A.arr_has("e", F.get("e", F.lit(0))).alias("has"))


@query("list_detect", f"SELECT vec_id, list_filter(e, lambda x : x > 0.1)[1] AS v, COALESCE(list_position(list_transform(e, lambda x : x > 0.1), TRUE), 0)::BIGINT AS i FROM {_E}")
def list_detect(t):
    return emb(t).select("vec_id", A.arr_detect("e", lambda x: x > 0.1).alias("v"), A.arr_detect_index("e", lambda x: x > 0.1).alias("i"))


@query("list_head_tail_while", f"SELECT vec_id, (COALESCE(NULLIF(list_position(list_transform(e, lambda x : x < 0.1), FALSE), 0), 65) - 1)::BIGINT AS h, (COALESCE(NULLIF(list_position(list_transform(list_reverse(e), lambda x : x < 0.1), FALSE), 0), 65) - 1)::BIGINT AS t FROM {_E}")
def list_head_tail_while(t):
    return emb(t).select("vec_id", F.size(A.arr_head_while("e", lambda x: x < 0.1)).cast("bigint").alias("h"), F.size(A.arr_tail_while("e", lambda x: x < 0.1)).cast("bigint").alias("t"))


@query("list_flatten_insert", "SELECT p_partkey, 'A ' || replace(p_name, ' ', ' ') || ' ' || p_name || ' Z' AS x, split_part(p_name, ' ', 1) || ' mid ' || split_part(p_name, ' ', 2) AS y FROM part")
def list_flatten_insert(t):
    w = F.split("p_name", " ")
    return t.part.select("p_partkey", F.array_join(A.arr_append(A.arr_prepend(A.arr_flatten(F.array(w, w)), "A"), "Z"), " ").alias("x"), F.array_join(A.arr_insert(w, 2, "mid"), " ").alias("y"))


_CHUNKS = "(SELECT *, (ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 500 + 1 AS chunk FROM orders)"


def order_cells(t):
    from cohortspark.operators.reshape import nest
    return nest(t.orders.select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], "rows", ["o_orderkey"], rows_per_cell=500)


@query("list_transpose", f"SELECT o_custkey, chunk, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS keys, string_agg(o_orderstatus, ',' ORDER BY o_orderkey) AS states FROM {_CHUNKS} GROUP BY 1, 2")
def list_transpose(t):
    s = order_cells(t).select("o_custkey", "chunk", A.arr_transpose("rows", ["o_orderkey", "o_orderstatus"]).alias("s"))
    return s.select("o_custkey", "chunk", F.array_join(F.col("s.o_orderkey").cast("array<string>"), ",").alias("keys"), F.array_join("s.o_orderstatus", ",").alias("states"))


@query("list_pluck", f"SELECT o_custkey, chunk, MIN(o_orderkey) AS first, COALESCE(LIST(o_orderkey ORDER BY o_orderkey)[15], -1) AS fifteenth FROM {_CHUNKS} GROUP BY 1, 2")
def list_pluck(t):
    return order_cells(t).select("o_custkey", "chunk", A.pluck("rows", 1, "o_orderkey").alias("first"), A.pluck("rows", 15, "o_orderkey", default=-1).alias("fifteenth"))


@query("list_cross", "SELECT p_partkey, len(string_split(p_name, ' ')) * len(string_split(p_type, 'A')) AS n FROM part")
def list_cross(t):
    return t.part.select("p_partkey", F.size(A.arr_cross(F.split("p_name", " "), F.split("p_type", "A"))).cast("bigint").alias("n"))


@query("list_vector_helpers", "SELECT p_partkey, array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS rev, array_to_string(range(1, len(string_split(p_name, ' ')) + 1), ',') AS seq, COALESCE(list_position(['red', 'hot', 'old'], split_part(p_name, ' ', 1)), 0)::BIGINT AS m FROM part")
def list_vector_helpers(t):
    w = F.split("p_name", " ")
    return t.part.select("p_partkey", F.array_join(A.arr_rev(w), " ").alias("rev"), F.array_join(A.arr_seq_along(w).cast("array<string>"), ",").alias("seq"),
                         F.coalesce(F.get(A.arr_match(w, ["red", "hot", "old"]), F.lit(0)), F.lit(0)).cast("bigint").alias("m"))


@query("list_unique", "SELECT doc_id, len(list_distinct(string_split(text, ' '))) AS n FROM documents")
def list_unique(t):
    return t.documents.select("doc_id", F.size(A.arr_unique(F.split("text", " "))).cast("bigint").alias("n"))


# ------------------------------------------------------------------- JSON

@query("json_parse_column", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.absent') AS BIGINT) AS absent FROM events")
def json_parse_column(t):
    return t.events.select("event_id", Z.parse_json_col("props", "k bigint, absent bigint").alias("p")).select("event_id", "p.k", "p.absent")


@query("json_matrix", "SELECT vec_id, (i // 8)::INT AS i, (i % 8)::INT AS j, ROUND(embedding[i + 1]::DOUBLE, 6) AS cell FROM embeddings, range(0, 64) r(i)")
def json_matrix(t):
    v = F.col("embedding").cast("array<double>")
    text = F.to_json(F.array(*[F.slice(v, 8 * i + 1, 8) for i in range(8)]))
    m = t.embeddings.select("vec_id", Z.parse_json_col(text, "array<array<double>>").alias("m"))
    rows = m.select("vec_id", F.posexplode("m").alias("i", "row"))
    return rows.select("vec_id", "i", F.posexplode("row").alias("j", "cell")).withColumn("cell", F.round("cell", 6))


@query("json_flatten", """SELECT event_id, event_type AS "row.type", value AS "row.at.value", user_id AS "row.at.user_id" FROM events""")
def json_flatten(t):
    nested = t.events.select("event_id", F.struct(F.col("event_type").alias("type"), F.struct("value", "user_id").alias("at")).alias("row"))
    return Z.flatten_struct(nested)


@query("json_valid_minify", """SELECT event_id, event_type <> 'error' AS ok, CASE WHEN event_type <> 'error' THEN replace(props, ' ', '') END AS small FROM events""")
def json_valid_minify(t):
    text = F.when(F.col("event_type") == "error", F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    return t.events.select("event_id", Z.json_valid(text).alias("ok"), Z.json_minify(text).alias("small"))


@query("json_round_trip", "SELECT TRUE AS same, COUNT(*) AS n FROM customer")
def json_round_trip(t):
    return t.customer.groupBy(Z.round_trip_equal(t.customer).alias("same")).agg(F.count(F.lit(1)).alias("n"))


@query("json_to_columns", "SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, CAST(NULL AS VARCHAR) AS c FROM part")
def json_to_columns(t):
    return A.to_columns(t.part.select("p_partkey", F.split("p_name", " ").alias("w")), "w", ["a", "b", "c"])


@query("json_unbox", "SELECT p_partkey, p_type AS one, CAST(NULL AS VARCHAR) AS two FROM part")
def json_unbox(t):
    return t.part.select("p_partkey", A.unbox(F.array("p_type")).alias("one"), A.unbox(F.split("p_name", " ")).alias("two"))


@query("json_schema_merged", "SELECT COUNT(*) AS n, SUM(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS total FROM events")
def json_schema_merged(t):
    found = Z.json_schema(t.events, "props")
    ddl = found.replace("OBJECT", "STRUCT")
    return t.events.select(Z.parse_json_col("props", ddl).alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum("p.k").cast("bigint").alias("total"))


@query("json_schema_late_key", """SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE late) AS n_late, SUM(event_id) FILTER (WHERE late)::BIGINT AS total
FROM (SELECT event_id, event_id >= 0.9 * (SELECT MAX(event_id) FROM events) AS late FROM events)""")
def json_schema_late_key(t):
    last = t.events.agg(F.max("event_id")).scalar()
    late = F.when(F.col("event_id") >= 0.9 * last, F.col("event_id"))
    texts = t.events.select(F.to_json(F.struct(F.col("user_id").alias("a"), late.alias("late"))).alias("j"))
    x = texts.select(Z.parse_json_col("j", Z.json_schema(texts, "j")).alias("x"))
    return x.agg(F.count(F.lit(1)).alias("n"), F.count("x.late").alias("n_late"), F.sum("x.late").alias("total"))
