"""Line dedup: sorted line hashes, first occurrences, keep bitmaps per document.

Line hashes are range-partitioned and sorted by document and position, so that
one pass over a partition meets the first occurrence of a line in each document
and all its later ones. What leaves the operator is no text but a bitmap for
each document that loses a line: 64-bit words, only those with a dropped line.

Keys with more than ``hot_rows`` lines (and a ten thousandth of all) do not go through the sort. Their
documents and their first line are aggregated, which combines before the
shuffle, and no task holds such a key.

Defined cases: null text is one empty line, as empty text is. A document is a
pair of id and text; rows that repeat both are one document and get the same
bitmap. Null ids are ids of their own. Keys shorter than ``min_chars`` are never
dropped. Other columns of the input are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import ascii_lower, store

BLANKS = " \t\n\x0b\x0c\r"
HOT_ROWS = 5_000
DOC = ["doc", "sig"]
KEY = ["h1", "h2"]


def body(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """doc, sig, pos and a 128-bit key hash for every line that can be dropped."""
    lines = docs.select(F.col(id_col).alias("doc"), F.xxhash64(body(text_col)).alias("sig"), body(text_col).alias("text")).select(
        "doc", "sig", F.posexplode(F.split(ascii_lower(F.col("text")), "\n")).alias("pos", "line"))
    key = F.btrim("line", F.lit(BLANKS))
    return lines.where(F.char_length(key) >= min_chars).select(
        "doc", "sig", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "none", min_documents: int = 2,
                 min_chars: int = 1, hot_rows: int = HOT_ROWS) -> DataFrame:
    """doc, sig, n_dropped, words: one row for each document that loses lines.

    ``words`` lists (word, keep): bit i of ``keep`` is line 64 * word + i, 1 if
    it stays; words that are not listed stay whole. ``sig`` is the hash of the
    text. Keys that at least ``min_documents`` documents hold are dropped:
    ``keep="none"`` drops all their lines, ``keep="first"`` all but the first
    one by document, text hash and position.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep must be none or first, not {keep}")
    lines = store(line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    # At most 10,000 keys are hot, whatever the size. Buckets of keys find them without a row for every key.
    limit = max(hot_rows, lines.count() // 10_000)
    bucketed = lines.withColumn("bucket", F.pmod("h1", F.lit(65536)))
    full = bucketed.groupBy("bucket").count().where(F.col("count") > limit).select("bucket")
    hot = bucketed.join(F.broadcast(full), "bucket", "left_semi").groupBy(*KEY).count().where(F.col("count") > limit).select(*KEY)
    hot = F.broadcast(store(hot, "hot-lines"))

    # one streaming pass over the sorted hashes
    held = Window.partitionBy(*KEY)
    order = held.orderBy(*DOC, "pos")
    fresh = F.coalesce((F.lag("sig").over(order) == F.col("sig")) & F.lag("doc").over(order).eqNullSafe(F.col("doc")), F.lit(False))
    cold = lines.join(hot, KEY, "left_anti").repartitionByRange(*KEY).sortWithinPartitions(*KEY, *DOC, "pos") \
        .withColumn("rank", F.row_number().over(order)).withColumn("fresh", (~fresh).cast("int")) \
        .withColumn("n", F.sum("fresh").over(held)).where(F.col("n") >= min_documents)
    some = lines.join(hot, KEY, "left_semi")
    spread = some.groupBy(*KEY, *DOC).agg(F.min("pos").alias("pos")).groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*DOC, "pos")).alias("first")).where(F.col("n") >= min_documents)
    warm = some.join(F.broadcast(spread), KEY)
    if keep == "first":
        cold = cold.where("rank > 1")
        warm = warm.where(~F.struct(*DOC, "pos").eqNullSafe(F.col("first")))
    bit = F.expr("shiftleft(1L, pos % 64)")
    dropped = cold.select(*DOC, "pos").unionByName(warm.select(*DOC, "pos")).groupBy(
        *DOC, F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(bit).alias("drop"))
    return dropped.groupBy(*DOC).agg(
        F.sum(F.bit_count("drop")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("drop").alias("keep")))).alias("words"))


def kept_lines(text: Column, words: Column) -> Column:
    """The lines of a text that its bitmap keeps, as a list; null words keep all."""
    # dense words, so that each line costs one look-up
    last = F.element_at(words, -1)["word"]
    held = F.map_from_entries(words)
    dense = F.transform(F.sequence(F.lit(0), last), lambda w: F.coalesce(F.try_element_at(held, w), F.lit(-1).cast("long")))
    lines = F.split(text, "\n")
    kept = lambda w: F.filter(lines, lambda x, i: F.coalesce(
        F.getbit(F.get(w, F.floor(i / 64).cast("int")), i % 64), F.lit(1)) == 1)
    return F.when(words.isNull(), lines).otherwise(F.element_at(F.transform(F.array(dense), kept), 1))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus __lines (kept lines), __n_lines and __n_dropped."""
    b = bitmaps.select(F.col("doc").alias("__doc"), F.col("sig").alias("__sig"), F.col("n_dropped").alias("__n"), F.col("words").alias("__words"))
    d = docs.withColumn("__key", F.xxhash64(body(text_col)))
    return d.join(b.hint("shuffle_hash"), d[id_col].eqNullSafe(b["__doc"]) & (d["__key"] == b["__sig"]), "left").withColumn(
        "__lines", kept_lines(body(text_col), F.col("__words"))).withColumn(
        "__n_lines", F.size(F.split(body(text_col), "\n")).cast("long")).withColumn(
        "__n_dropped", F.coalesce("__n", F.lit(0).cast("long"))).drop("__key", "__doc", "__sig", "__n", "__words")
