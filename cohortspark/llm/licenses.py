"""License scans: ordered signature rules behind a keyword gate.

Texts become words with one blank between them. A rule of ``license_rules`` is
tried where one of its keywords is among the words of the text; most texts pass
no gate and meet no pattern. Matches are intervals of the joined words. One is
suppressed if an interval of the same or a better level holds all of it; of
equal ones the better level, then the earlier rule stays. Intervals are resolved
by one sorted pass over the matches of a text, with the furthest end so far for
each level, so their number may be large.

Phrases that must be counted whatever the rules say (``base``) are found beside
them; their labels stay in any case.

Texts are read once and never shuffled; matches are, by document. Only columns of
Spark SQL are used.

Defined cases: null text is empty text, which has no words, no places and score
0. A document is a pair of id and text; rows that repeat both get the same
labels, once each. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import ascii_lower, store
from cohortspark.llm.license_rules import RULES

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
WEIGHTS = {1: 1.0, 2: 0.9, 3: 0.7, 4: 0.3}
BASE_WEIGHT = 0.7
DOC = ["doc", "sig"]


def pattern(p: str) -> str:
    """From the blank before the first word to the end of the last one."""
    return f" (?:{p})(?= )"


def rule_list(rules) -> Column:
    return F.array(*[F.struct(F.array(*map(F.lit, k.split(","))).alias("keywords"), F.lit(n).alias("no"), F.lit(level).alias("level"),
                              F.lit(pattern(p)).alias("pattern")) for n, (k, level, _, p) in enumerate(rules, 1)])


def blanks(x: Column) -> Column:
    return F.char_length(x) - F.char_length(F.replace(x, F.lit(" "), F.lit("")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=tuple(RULES), base=BASE) -> DataFrame:
    """Stored: doc, sig, n_words, n_base, first_word, last_word, base_labels, and the raw matches of the rules by their lengths."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("sig"), F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)).alias("words"))
    keywords = sorted({k for r in rules for k in r[0].split(",")})
    flat = words.select(*DOC, F.size("words").cast("long").alias("n_words"), F.array_intersect("words", F.array(*map(F.lit, keywords))).alias("keys"),
                        F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("flat"))
    line = F.col("flat")
    parts = {f"p{i}": F.when(line.contains(f" {phrase} "), F.split(line, pattern(phrase), -1)) for i, (phrase, _) in enumerate(base)}
    tried = F.filter(rule_list(rules), lambda r: F.arrays_overlap(r["keywords"], F.col("keys")))
    lengths = lambda x: F.transform(x, lambda y: F.char_length(y))
    hits = F.filter(F.transform(tried, lambda r: F.struct(r["no"].alias("no"), r["level"].alias("level"), lengths(F.split(line, r["pattern"], -1)).alias("gaps"),
                                                          lengths(F.regexp_extract_all(line, r["pattern"], F.lit(0))).alias("marks"))),
                    lambda h: F.size(h["marks"]) > 0)
    found = flat.select(*DOC, "n_words", *(c.alias(n) for n, c in parts.items()), F.when(F.size("keys") > 0, hits).alias("hits"))
    names = list(parts)
    count = sum((F.coalesce(F.size(n) - 1, F.lit(0)) for n in names), F.lit(0)) if names else F.lit(0)
    long = lambda c: c.cast("long")
    first = [F.when(F.col(n).isNotNull(), long(blanks(F.get(n, F.lit(0))))) for n in names]
    last = [F.when(F.col(n).isNotNull(), F.col("n_words") - long(blanks(F.element_at(n, -1)) - 1) - len(phrase.split()))
            for n, (phrase, _) in zip(names, base)]
    labels = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.col(n).isNotNull(), F.lit(label)) for n, (_, label) in zip(names, base)]))))
    none = F.lit(None).cast("long")
    return store(found.select(*DOC, "n_words", long(count).alias("n_base"), F.array_min(F.array(*first, none)).alias("first_word"),
                              F.array_max(F.array(*last, none)).alias("last_word"), labels.alias("base_labels"), "hits"), "license-scan")


def detections(scanned: DataFrame, rules=tuple(RULES)) -> DataFrame:
    """doc, sig, rule, level, label, start, stop, stays: every match as an interval of the joined words, and whether it is not suppressed."""
    one = scanned.where("hits IS NOT NULL").select(*DOC, F.explode("hits").alias("h")).select(
        *DOC, "h.no", "h.level", F.posexplode(F.arrays_zip(F.slice("h.gaps", F.lit(1), F.size("h.marks")).alias("gap"), F.col("h.marks").alias("mark"))).alias("nth", "x"))
    one = one.select(*DOC, "no", "level", "nth", "x.gap", "x.mark").distinct().repartition(*DOC)
    along = Window.partitionBy(*DOC, "no").orderBy("nth")
    stop = F.sum(F.col("gap") + F.col("mark")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    at = one.withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("mark"))
    before = Window.partitionBy(*DOC).orderBy("start", F.col("stop").desc(), "level", "no").rowsBetween(Window.unboundedPreceding, -1)
    reach = [F.max(F.when(F.col("level") <= n, F.col("stop"))).over(before) for n in sorted(WEIGHTS)]
    covered = F.get(F.array(*reach), F.col("level") - 1)
    label = F.get(F.array(*[F.lit(r[2]) for r in rules]), F.col("no") - 1)
    return at.select(*DOC, F.col("no").alias("rule"), "level", label.alias("label"), "start", "stop", F.coalesce(covered < F.col("stop"), F.lit(True)).alias("stays"))


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=tuple(RULES), base=BASE) -> DataFrame:
    """doc, sig, n_words, n_base, first_word, last_word, base_labels, labels, score for every row."""
    scanned = scan(docs, id_col, text_col, rules, base)
    weight = F.get(F.array(*[F.lit(WEIGHTS[n]) for n in sorted(WEIGHTS)]), F.col("level") - 1)
    own = detections(scanned, rules).where("stays").groupBy(*DOC).agg(F.collect_set("label").alias("own"), F.max(weight).alias("weight"))
    own = own.select(F.col("doc").alias("d"), F.col("sig").alias("s"), "own", "weight")
    joined = scanned.join(own, scanned.doc.eqNullSafe(own.d) & (scanned.sig == own.s), "left")
    empty = F.array().cast("array<string>")
    return joined.select(*DOC, "n_words", "n_base", "first_word", "last_word", "base_labels",
                         F.array_sort(F.array_union("base_labels", F.coalesce("own", empty))).alias("labels"),
                         F.greatest(F.coalesce("weight", F.lit(0.0)), F.when(F.col("n_base") > 0, BASE_WEIGHT).otherwise(0.0)).alias("score"))
