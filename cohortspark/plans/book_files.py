"""Queries: files, tables, metadata and streams.

Files are written below the shared folder and read back, so the rows that come
out must be the rows of the input tables.
"""

import pandas as pd
from pyspark.sql import functions as F

from cohortspark.operators import apply as P
from cohortspark.operators import tabyl as X
from cohortspark.operators import verbs as V
from cohortspark.plans.registry import query
from cohortspark.session import scratch_path
from cohortspark.sources import files as I
from cohortspark.sources import types as K
from cohortspark.sources import warehouse as W
from cohortspark.streaming import streams as S

CUSTOMER = "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _big(df, *cols):
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


def _written_csv(t, df, label, **kw):
    path = scratch_path(t.spark, label)
    I.write_csv(df, path, **kw)
    return path


@query("csv_round_trip", CUSTOMER)
def csv_round_trip(t):
    return _big(I.read_csv(t.spark, _written_csv(t, t.customer, "csv")), "c_custkey", "c_nationkey")


@query("csv_decimal_comma", "SELECT c_custkey, c_acctbal FROM customer")
def csv_decimal_comma(t):
    path = scratch_path(t.spark, "csv2")
    text = t.customer.select("c_custkey", F.replace(F.format_number("c_acctbal", 2), F.lit(","), F.lit("_")).alias("b"))
    text = text.select("c_custkey", F.replace(F.replace("b", F.lit("."), F.lit(",")), F.lit("_"), F.lit(".")).alias("c_acctbal"))
    I.write_delim(text, path, ";")
    return I.read_csv2(t.spark, path, col_types="Ld")


@query("tsv_compact_types", "SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders")
def tsv_compact_types(t):
    path = scratch_path(t.spark, "tsv")
    I.write_tsv(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate")), path)
    return I.read_tsv(t.spark, path, col_types="L_cD").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("excel_csv_mark", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation")
def excel_csv_mark(t):
    path = scratch_path(t.spark, "xcsv")
    I.write_excel_csv(t.nation.select("n_nationkey", "n_name"), path)
    return _big(I.read_csv(t.spark, path).toDF("n_nationkey", "n_name"), "n_nationkey")


@query("fixed_width_fields", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def fixed_width_fields(t):
    line = F.concat(F.lpad(F.col("c_custkey").cast("string"), 10, " "), F.lit(" "), F.rpad("c_mktsegment", 12, " "), F.lit(" "), F.lpad(F.format_string("%.2f", "c_acctbal"), 12, " "))
    path = scratch_path(t.spark, "fwf")
    I.write_lines(t.customer.select(line.alias("value")), path)
    return _big(I.read_fwf(t.spark, path, I.fwf_widths([11, 13, 12], ["c_custkey", "c_mktsegment", "c_acctbal"])), "c_custkey")


@query("fixed_width_found", "SELECT n_nationkey::BIGINT AS k, n_name AS name FROM nation")
def fixed_width_found(t):
    line = F.concat(F.lpad(F.col("n_nationkey").cast("string"), 4, " "), F.lit("   "), F.rpad("n_name", 12, " "))
    path = scratch_path(t.spark, "fwf")
    I.write_lines(t.nation.select(line.alias("value")), path)
    return _big(I.read_fwf(t.spark, path, ["k", "name"]), "k")


@query("white_space_table", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def white_space_table(t):
    path = scratch_path(t.spark, "table")
    I.write_lines(t.supplier.select(F.concat_ws("   ", "s_suppkey", F.regexp_replace("s_name", " ", "_"), F.format_string("%.2f", "s_acctbal")).alias("value")), path)
    return _big(I.read_table(t.spark, path, ["s_suppkey", "s_name", "s_acctbal"]), "s_suppkey")


@query("web_log_lines", "SELECT 'host' || user_id AS host, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, 'GET /' || event_type || ' HTTP/1.1' AS request, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END::BIGINT AS status, event_id AS bytes FROM events")
def web_log_lines(t):
    line = F.format_string('host%d - - [%s] "GET /%s HTTP/1.1" %d %d', "user_id", F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss '+0000'"), "event_type",
                           F.when(F.col("event_type") == "error", 500).otherwise(200), "event_id")
    path = scratch_path(t.spark, "log")
    I.write_lines(t.events.select(line.alias("value")), path)
    out = I.read_log(t.spark, path)
    return out.select("host", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "request", F.col("status").cast("bigint").alias("status"), "bytes")


@query("lines_and_whole_files", "SELECT (SELECT COUNT(*) FROM customer) AS n_lines, (SELECT SUM(length(c_name) + 1)::BIGINT FROM customer) AS n_chars, (SELECT SUM(length(c_name) + 1)::BIGINT FROM customer) AS n_bytes")
def lines_and_whole_files(t):
    path = scratch_path(t.spark, "lines")
    I.write_lines(t.customer, path, "c_name")
    lines = I.read_lines(t.spark, path).agg(F.count(F.lit(1)).alias("n_lines"))
    whole = I.read_files(t.spark, path + "/*.txt").agg(F.sum(F.char_length("value")).alias("n"))
    raw = I.read_files(t.spark, path + "/*.txt", raw=True).agg(F.sum(F.length("content")).alias("n"))
    return lines.withColumn("n_chars", whole.scalar()).withColumn("n_bytes", raw.scalar())


@query("fields_per_line", "SELECT 3::BIGINT AS fields, COUNT(*) AS n FROM customer")
def fields_per_line(t):
    lines = t.customer.select(F.concat(F.lit('"'), "c_name", F.lit(', x",'), "c_mktsegment", F.lit(",1")).alias("value"))
    return lines.groupBy(I.count_fields(lines).cast("bigint").alias("fields")).agg(F.count(F.lit(1)).alias("n"))


@query("guessed_specification", """SELECT UNNEST(['c_custkey', 'c_name', 'c_acctbal', 'day', 'flag', 'clock', 'money']) AS "column", UNNEST(['integer', 'character', 'double', 'date', 'logical', 'time', 'number']) AS type""")
def guessed_specification(t):
    c = t.customer
    base = c.select("c_custkey", "c_name", "c_acctbal", F.lit("2020-01-31").alias("day"), (F.col("c_acctbal") > 0).cast("string").alias("flag"), F.lit("10:30:00").alias("clock"), F.format_number(F.abs("c_acctbal") + 1000, 2).alias("money"))
    spec = K.guess_types(I.read_delim(t.spark, _written_csv(t, base, "spec"), col_types={".default": "character"}))
    return t.spark.createDataFrame(list(spec.items()), "column string, type string")


@query("reinferred_types", "SELECT SUM(c_custkey)::BIGINT AS keys, ROUND(SUM(c_acctbal), 2) AS bal, COUNT(*) FILTER (c_acctbal > 0) AS pos FROM customer")
def reinferred_types(t):
    text = t.customer.select(*[F.col(c).cast("string") for c in t.customer.columns]).withColumn("pos", F.when(F.col("c_acctbal").cast("double") > 0, "TRUE").otherwise("FALSE"))
    typed = K.type_convert(text)
    return typed.agg(F.sum("c_custkey").alias("keys"), F.round(F.sum("c_acctbal"), 2).alias("bal"), F.count_if("pos").alias("pos"))


@query("parse_problems", """SELECT c_custkey, 'bal' AS "column", 'double' AS expected, 'owes ' || printf('%.2f', -c_acctbal) AS actual FROM customer WHERE c_acctbal < 0""")
def parse_problems(t):
    text = t.customer.select("c_custkey", F.when(F.col("c_acctbal") < 0, F.concat(F.lit("owes "), F.format_string("%.2f", -F.col("c_acctbal")))).otherwise(F.format_string("%.2f", "c_acctbal")).alias("bal"))
    return K.problems(text, {"bal": "double"}, ["c_custkey"])


@query("typed_column_parsers", "SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN p_type END AS f, p_retailprice AS m, p_size % 2 = 0 AS l FROM part")
def typed_column_parsers(t):
    money = F.replace(F.replace(F.replace(F.format_number("p_retailprice", 2), F.lit(","), F.lit("_")), F.lit("."), F.lit(",")), F.lit("_"), F.lit("."))
    return t.part.select("p_partkey", K.parse_col("p_type", "factor", ["SMALL", "LARGE"]).alias("f"), K.parse_col(money, "double", decimal_mark=",", grouping_mark=".").alias("m"),
                         K.parse_col(F.when(F.col("p_size") % 2 == 0, "T").otherwise("F"), "logical").alias("l"))


@query("folder_of_layouts", "SELECT c_custkey AS id, c_acctbal AS bal, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier")
def folder_of_layouts(t):
    base = scratch_path(t.spark, "folder")
    I.write_csv(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("segment")), base + "/a")
    I.write_csv(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal")), base + "/b")
    return _big(I.read_assessment_files(t.spark, base), "id")


@query("many_files_with_name", "SELECT c_mktsegment AS segment, COUNT(*) AS n, TRUE AS named FROM customer GROUP BY 1")
def many_files_with_name(t):
    path = _written_csv(t, t.customer.repartition(4, "c_mktsegment"), "many")
    out = I.read_many(t.spark, [path])
    return out.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("filename").endswith(".csv")).alias("named"))


@query("formatted_csv_lines", "SELECT c_custkey || ',' || c_mktsegment AS value FROM customer")
def formatted_csv_lines(t):
    return I.format_csv(t.customer.select("c_custkey", "c_mktsegment"))


@query("json_lines_round_trip", "SELECT o_orderkey, o_totalprice, o_custkey AS \"who.key\", o_orderstatus AS \"who.status\" FROM orders")
def json_lines_round_trip(t):
    path = scratch_path(t.spark, "json")
    I.write_json(t.orders.select("o_orderkey", "o_totalprice", F.struct(F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("status")).alias("who")), path)
    return I.read_json(t.spark, path, "o_orderkey bigint, o_totalprice double, who struct<key:bigint,status:string>", flatten=True)


@query("json_record_arrays", "SELECT c_custkey AS k, c_name AS name FROM customer")
def json_record_arrays(t):
    from cohortspark.operators.reshape import nest
    path = scratch_path(t.spark, "records")
    rows = t.customer.select("c_mktsegment", F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    cells = nest(rows, ["c_mktsegment"], "data", ["k"], rows_per_cell=100)
    I.write_lines(cells.select(F.to_json("data").alias("value")), path)
    # each line is an array of records and becomes as many rows
    return I.read_json(t.spark, path, "k bigint, name string")


@query("bound_pages", "SELECT c_custkey AS k, c_name AS a, CAST(NULL AS DOUBLE) AS b FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier")
def bound_pages(t):
    return I.rbind_pages([t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("a")), t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("b"))])


# ------------------------------------------------------------------- tables

@query("named_source", "SELECT c_custkey, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey")
def named_source(t):
    W.register_source("school_files", "parquet", {"path": t.folder + "/{table}.parquet"})
    get = W.source_loader("school_files")
    return get(t.spark, "customer").join(get(t.spark, "orders"), F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "o_orderkey")


@query("warehouse_read_write", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation")
def warehouse_read_write(t):
    a, b = scratch_path(t.spark, "wh"), scratch_path(t.spark, "wh")
    W.write_warehouse(t.nation.select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name"), a, fmt="parquet")
    W.copy_table(t.spark, a, b, fmt="parquet")
    return W.read_warehouse(t.spark, b, fmt="parquet")


@query("table_metadata", "SELECT COUNT(*) AS n_rows, 5::BIGINT AS n_cols, 'c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string' AS fields FROM customer")
def table_metadata(t):
    return _big(W.table_meta(t.customer), "n_cols")


@query("column_metadata", """SELECT v.*, n_known FROM (VALUES (1, 'event_id', 'bigint'), (2, 'ts', 'timestamp_ntz'), (3, 'user_id', 'bigint'), (4, 'event_type', 'string'), (5, 'value', 'double'), (6, 'props', 'string')) v(position, name, type)
JOIN (UNPIVOT (SELECT COUNT(event_id) AS event_id, COUNT(ts) AS ts, COUNT(user_id) AS user_id, COUNT(event_type) AS event_type, COUNT(value) AS value, COUNT(props) AS props FROM events) ON COLUMNS(*) INTO NAME name VALUE n_known) USING (name)""")
def column_metadata(t):
    known = t.events.agg(*[F.count(c).alias(c) for c in t.events.columns]).unpivot([], t.events.columns, "name", "n_known")
    return W.catalog_fields(t.events).join(known, "name")


@query("catalog_listing", "SELECT 'customer_listed' AS name, TRUE AS temporary, TRUE AS found, COUNT(*) AS n_rows, FALSE AS after_drop FROM customer")
def catalog_listing(t):
    t.customer.createOrReplaceTempView("customer_listed")
    out = W.catalog_tables(t.spark).where("name = 'customer_listed'").select("name", "temporary", F.lit(W.table_exists(t.spark, "customer_listed")).alias("found"),
                                                                              t.spark.table("customer_listed").agg(F.count(F.lit(1))).scalar().alias("n_rows"))
    W.drop_table(t.spark, "customer_listed")
    return out.withColumn("after_drop", F.lit(W.table_exists(t.spark, "customer_listed")))


@query("object_listing", "SELECT 'customer' AS name, COUNT(*) AS n_rows, TRUE AS sized FROM customer UNION ALL SELECT 'orders', COUNT(*), TRUE FROM orders")
def object_listing(t):
    found = W.list_objects(t.spark, t.folder, "*.parquet")
    # the rows that each listed object of two tables holds
    held = lambda name: getattr(t, name).groupBy(F.col("_metadata.file_path").alias("at")).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("name", F.lit(name))
    rows = held("customer").unionByName(held("orders"))
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    return rows.join(found, plain("at") == plain("path")).groupBy("name").agg(F.sum("n_rows").alias("n_rows"), F.bool_and(F.col("length") > 0).alias("sized"))


@query("object_read_write", "SELECT s_suppkey, s_name FROM supplier")
def object_read_write(t):
    path = scratch_path(t.spark, "objects")
    W.write_objects(t.supplier.select("s_suppkey", "s_name"), path, "orc")
    return W.read_objects(t.spark, path, "orc", "*.orc")


@query("version_swap", "SELECT c_custkey, c_acctbal * 2 AS c_acctbal FROM customer")
def version_swap(t):
    base = scratch_path(t.spark, "versions")
    W.replace_atomic(t.customer.select("c_custkey", "c_acctbal"), base)
    newest = W.replace_atomic(t.customer.select("c_custkey", (F.col("c_acctbal") * 2).alias("c_acctbal")), base)
    return t.spark.read.parquet(newest)


@query("computed_table", "SELECT l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY 1")
def computed_table(t):
    stored = W.compute(t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n")), "line_counts")
    return t.spark.table("line_counts").groupBy("l_returnflag").agg(F.sum("n").alias("n")) if stored.columns else stored


@query("glimpse_columns", """WITH h AS (SELECT * FROM customer ORDER BY c_custkey LIMIT 5)
SELECT position, "column", type, "values" FROM (VALUES (1, 'c_custkey', 'bigint'), (2, 'c_name', 'string'), (3, 'c_nationkey', 'int'), (4, 'c_acctbal', 'double'), (5, 'c_mktsegment', 'string')) v(position, "column", type)
JOIN (SELECT 1 AS p, string_agg(c_custkey::VARCHAR, ', ' ORDER BY c_custkey) AS "values" FROM h UNION ALL SELECT 2, string_agg(c_name, ', ' ORDER BY c_custkey) FROM h
UNION ALL SELECT 3, string_agg(c_nationkey::VARCHAR, ', ' ORDER BY c_custkey) FROM h UNION ALL SELECT 4, string_agg(c_acctbal::VARCHAR, ', ' ORDER BY c_custkey) FROM h
UNION ALL SELECT 5, string_agg(c_mktsegment, ', ' ORDER BY c_custkey) FROM h) ON p = position""")
def glimpse_columns(t):
    return W.glimpse(t.customer, order=["c_custkey"])


@query("frame_summary", "SELECT COUNT(c_acctbal)::VARCHAR AS n, MIN(c_acctbal)::VARCHAR AS lo, MAX(c_acctbal)::VARCHAR AS hi FROM customer")
def frame_summary(t):
    s = W.summary_table(t.customer.select("c_acctbal"))
    pick = lambda k: F.max(F.when(F.col("summary") == k, F.col("c_acctbal")))
    return s.agg(pick("count").alias("n"), pick("min").alias("lo"), pick("max").alias("hi"))


@query("small_literal_tables", "SELECT o_orderpriority, COUNT(*) AS n, SUM(w * 2)::BIGINT AS w2 FROM orders JOIN (VALUES ('1-URGENT', 3), ('2-HIGH', 2)) v(p, w) ON p = o_orderpriority GROUP BY 1")
def small_literal_tables(t):
    weights = W.tibble(t.spark, o_orderpriority=["1-URGENT", "2-HIGH"], w=[3, 2], w2=F.col("w") * 2)
    return t.orders.join(weights, "o_orderpriority").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("w2").alias("w2"))


@query("row_wise_literal_table", "SELECT c_mktsegment AS name, COUNT(*) AS n, MAX(v)::BIGINT AS value FROM customer JOIN (VALUES ('BUILDING', 1), ('MACHINERY', 2)) x(k, v) ON k = c_mktsegment GROUP BY 1")
def row_wise_literal_table(t):
    named = W.enframe(t.spark, {r["k"]: r["v"] for r in W.tribble(t.spark, ["k", "v"], "BUILDING", 1, "MACHINERY", 2).collect()})
    return t.customer.join(named, F.col("c_mktsegment") == F.col("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("value"))


@query("rows_one_partition_at_a_time", "SELECT n_regionkey::BIGINT AS k, COUNT(*) AS n FROM nation GROUP BY 1")
def rows_one_partition_at_a_time(t):
    rows = [(r["k"], r["n"]) for r in P.iterate(t.nation.groupBy(F.col("n_regionkey").cast("bigint").alias("k")).agg(F.count(F.lit(1)).alias("n")))]
    return t.spark.createDataFrame(rows, "k bigint, n bigint")


@query("csv_late_text_cell", """SELECT CASE WHEN event_id < 0.9 * (SELECT MAX(event_id) FROM events) THEN CAST(event_id AS VARCHAR) ELSE 'late ' || event_id END AS cell FROM events""")
def csv_late_text_cell(t):
    cell = F.when(F.col("event_id") < 0.9 * t.events.agg(F.max("event_id")).scalar(), F.col("event_id").cast("string")).otherwise(F.concat(F.lit("late "), "event_id"))
    path = scratch_path(t.spark, "late")
    # sorted over all files, so the late cells lie in the last ones
    t.events.select("event_id", cell.alias("cell")).repartitionByRange("event_id").sortWithinPartitions("event_id").write.option("header", True).csv(path)
    return I.read_csv(t.spark, path, col_types=I.infer_schema(t.spark, path)).select("cell")


@query("many_files_with_reader_options", """SELECT c_mktsegment AS segment, COUNT(*) AS n, SUM(c_custkey)::BIGINT AS keys, COUNT(DISTINCT c_nationkey % 2) AS files FROM customer GROUP BY 1""")
def many_files_with_reader_options(t):
    paths = []
    for odd, order in ((0, ["c_custkey", "c_mktsegment"]), (1, ["c_mktsegment", "c_custkey"])):
        paths.append(scratch_path(t.spark, "layout"))
        t.customer.where(f"c_nationkey % 2 = {odd}").select(*order).write.option("header", True).option("sep", "|").csv(paths[-1])
    out = I.read_many(t.spark, paths, reader=I.read_delim, sep="|")
    return out.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"), F.count_distinct(F.regexp_replace("filename", "/[^/]*$", "")).alias("files"))




# ------------------------------------------------------------------ streams

def _events(t, **options):
    return S.stream_files(t.spark, t.folder, t.events.schema, pathGlobFilter="events.parquet", **options)


@query("stream_csv_chunks", "SELECT c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1")
def stream_csv_chunks(t):
    path = scratch_path(t.spark, "in")
    t.customer.repartition(3, "c_custkey").write.csv(path)
    out = S.stream_csv(t.spark, path, t.customer.schema, lambda chunk, i: chunk.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")), "c_mktsegment string, n bigint")
    return out.groupBy("c_mktsegment").agg(F.sum("n").alias("n"))


@query("stream_json_chunks", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def stream_json_chunks(t):
    path = scratch_path(t.spark, "in")
    t.orders.select("o_orderkey", "o_totalprice").repartition(3, "o_orderkey").write.json(path)
    out = S.stream_json(t.spark, path, "o_orderkey bigint, o_totalprice double", lambda chunk, i: chunk.where("o_totalprice > 400000"), "o_orderkey bigint, o_totalprice double")
    return out.drop("chunk")


@query("stream_line_chunks", "SELECT COUNT(*) AS n FROM customer WHERE c_name LIKE '%9'")
def stream_line_chunks(t):
    path = scratch_path(t.spark, "in")
    I.write_lines(t.customer.repartition(3, "c_custkey"), path, "c_name")
    out = S.stream_lines(t.spark, path, "value string", lambda chunk, i: chunk.where(F.col("value").endswith("9")), "value string")
    return out.agg(F.count(F.lit(1)).alias("n"))


@query("stream_new_files", "SELECT event_id, value FROM events")
def stream_new_files(t):
    path = S.run_stream(_events(t).select("event_id", "value"))
    return t.spark.read.schema("event_id bigint, value double").parquet(path)


@query("stream_counts", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def stream_counts(t):
    return S.latest_table(S.stream_tabyl(_events(t), "event_type"), "event_type string, n bigint", ["event_type"])


_WIN = """SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS "start", event_type, COUNT(*) AS n FROM {0} GROUP BY 1, 2"""


@query("stream_tumbling_windows", _WIN.format("(SELECT time_bucket(INTERVAL 6 HOUR, ts) AS s, event_type FROM events)"))
def stream_tumbling_windows(t):
    agg = S.stream_window_agg(_events(t), "ts", "6 hours", by=["event_type"], n=F.count(F.lit(1)))
    out = S.latest_table(agg, "start timestamp, end timestamp, event_type string, n bigint", ["start", "event_type"])
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


@query("stream_sliding_windows", _WIN.format("(SELECT time_bucket(INTERVAL 6 HOUR, ts) AS s, event_type FROM events UNION ALL SELECT time_bucket(INTERVAL 6 HOUR, ts - INTERVAL 3 HOUR) + INTERVAL 3 HOUR, event_type FROM events)"))
def stream_sliding_windows(t):
    agg = S.stream_window_agg(_events(t), "ts", "6 hours", "3 hours", by=["event_type"], n=F.count(F.lit(1)))
    out = S.latest_table(agg, "start timestamp, end timestamp, event_type string, n bigint", ["start", "event_type"])
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


@query("stream_session_windows", """SELECT user_id, COUNT(*) AS n FROM (SELECT user_id, s FROM (SELECT user_id, ts, event_id, SUM(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM
(SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 5 HOUR THEN 0 ELSE 1 END AS new FROM events)) GROUP BY 1, 2) GROUP BY 1""")
def stream_session_windows(t):
    agg = S.stream_window_agg(_events(t), "ts", "5 hours", by=["user_id"], session=True, n=F.count(F.lit(1)))
    out = S.final_table(agg, "start timestamp, end timestamp, user_id bigint, n bigint")
    return out.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("stream_dedupe", "SELECT DISTINCT event_id FROM events")
def stream_dedupe(t):
    path = scratch_path(t.spark, "in")
    twice = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    twice.unionByName(twice).repartition(4, "event_id").write.parquet(path)
    sdf = S.stream_files(t.spark, path, twice.schema)
    out = S.run_stream(S.stream_dedupe(sdf, ["event_id"], "ts", "60 days").select("event_id"))
    return t.spark.read.schema("event_id bigint").parquet(out)


@query("stream_dedupe_with_late_rows", "SELECT event_id, TRUE AS once FROM events GROUP BY 1")
def stream_dedupe_with_late_rows(t):
    """Every event twice, the latest in the first files: most rows come late, and no key is lost."""
    path = scratch_path(t.spark, "in")
    events = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    events.unionByName(events).repartitionByRange(5, F.desc("ts")).write.parquet(path)
    kept, late = S.dedupe_with_late(S.stream_files(t.spark, path, events.schema, files_per_chunk=1), ["event_id"], "ts", "1 day")
    both = kept.select("event_id", F.lit(1).alias("n")).unionByName(late.select("event_id", F.lit(0).alias("n")))
    return both.groupBy("event_id").agg((F.sum("n") <= 1).alias("once"))


@query("stream_windows_in_many_chunks", _WIN.format("(SELECT time_bucket(INTERVAL 6 HOUR, ts) AS s, event_type FROM events)"))
def stream_windows_in_many_chunks(t):
    path = scratch_path(t.spark, "in")
    # the latest events come in the first files, one file is one chunk
    t.events.repartitionByRange(5, F.desc("ts")).write.parquet(path)
    agg = S.stream_window_agg(S.stream_files(t.spark, path, t.events.schema, files_per_chunk=1), "ts", "6 hours", by=["event_type"], n=F.count(F.lit(1)))
    out = S.latest_table(agg, "start timestamp, end timestamp, event_type string, n bigint", ["start", "event_type"])
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")
