"""One query for each operator, with production parameters, and SQL for the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm import alignment, compact_windows, decontaminate, host_trust, lexical, licenses, line_dedup, packing, quality_gam, simhash, suffixes, vptree, warc_bundles
from cohortspark.session import tune

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register fn(spark, read), where read(table) gives an input table."""
    def add(fn):
        _QUERIES[name] = lambda spark, folder: fn(tune(spark), lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))
        if sql:
            _ORACLES[name] = sql
        return fn
    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


LINE_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS key
  FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS drop FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drop) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT drop), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op1_line_dedup", LINE_SQL)
def op1(spark, read):
    docs = read("documents").select("doc_id", "text")
    marks = line_dedup.line_bitmaps(docs, keep="none", min_documents=10)
    return line_dedup.apply_bitmaps(docs, marks).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.array_join("__lines", "\n"), 256).alias("kept_sha256"))


@query("op7_simhash")
def op7(spark, read):
    prints = simhash.fingerprints(read("documents"), width=3, seed=42)
    return simhash.groups(prints, max_bits=2).select(
        F.col("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


LEAK_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
v AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
p AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM d, (SELECT DISTINCT n FROM v))),
h AS (SELECT DISTINCT p.doc_id, v.item_id, p.i, p.n FROM p JOIN v USING (n, s)),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query("op8_decontaminate", LEAK_SQL)
def op8(spark, read):
    found = decontaminate.scan(read("documents"), read("benchmark"), window=10, carry=["doc_id"])
    items = F.array_sort(F.transform("__items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"), F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("__n_hit") > 0).alias("contaminated"))


@query("op5_pack")
def op5(spark, read):
    import public_tokenizers

    placed = packing.pack(read("documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)
    return placed.select(F.col("doc").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


@query("op3_quality")
def op3(spark, read):
    docs = read("documents")
    model = quality_gam.learn(docs, read("labels"), label_col="quality", sample=20_000)
    return quality_gam.score(docs, model, carry=["doc_id"]).select(
        "doc_id", quality_gam.held_out().alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= 0.3).cast("int").alias("predicted"))


WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN top <> page_id THEN top END AS refers_to
FROM p LEFT JOIN m USING (payload_digest)
"""


@query("op4_warc", WARC_SQL)
def op4(spark, read):
    index = warc_bundles.write_bundles(read("pages"), least=1000)
    return warc_bundles.read_bundles(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


@query("op2_url_filter")
def op2(spark, read):
    return host_trust.judge(read("pages"), URL_RULES).select(F.col("page").alias("page_id"), "host", "path", "rule", "verdict", "trust", "distrust")


@query("op6_nearest")
def op6(spark, read):
    rows = read("embeddings")
    shards = vptree.index(rows, k=5)
    return vptree.nearest(shards, rows.where("vec_id % 50 = 0"), k=5, factor=1.0)


@query("op10_license_scan")
def op10(spark, read):
    return licenses.licenses(read("documents")).select(
        F.col("doc").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


@query("op9_repeats")
def op9(spark, read):
    found, _ = compact_windows.repeated(read("documents"), words=50, similarity=0.8)
    return found.select(
        F.col("doc").alias("doc_id"), F.col("class").alias("class_id"), "n_links", F.size("spans").alias("n_passages"),
        F.array_join(F.transform("spans", lambda s: F.concat(s["start"], F.lit("-"), s["stop"])), ",").alias("passages"))


@query("op11_align")
def op11(spark, read):
    import public_tokenizers

    found, _ = alignment.align(read("documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(F.col("doc").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


SEARCH_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
p AS (SELECT doc_id, size, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS size, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
i AS (
  SELECT doc_id, term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * size * n) // l)))) AS impact
  FROM p JOIN f USING (term), s),
r AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 50
"""


@query("op12_search", SEARCH_SQL)
def op12(spark, read):
    return lexical.search(read("documents"), read("benchmark"), k=50).select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


@query("op13_suffix_dedup")
def op13(spark, read):
    return suffixes.remove_repeats(read("documents"), length=200, carry=["doc_id"]).select(
        "doc_id", F.col("__n_bytes").alias("n_bytes"), F.col("__n_removed").alias("n_removed"), F.size("__spans").cast("long").alias("n_spans"),
        F.sha2("__kept", 256).alias("kept_sha256"))
