"""Queries: assessment analytics on scores derived from the orders.

A customer is a student, an order a test event, the market segment the school.
Norm tables are aggregates of the same data, so they grow with it.
"""

from pyspark.sql import functions as F

from cohortspark.functions import dates as D
from cohortspark.operators import joins as J
from cohortspark.operators import ordered as O
from cohortspark.operators import verbs as V
from cohortspark.plans import assessment as A
from cohortspark.plans.registry import query
from cohortspark.sources import warehouse as W

# ------------------------------------------------------------ derived input


def raw_scores(t):
    m = F.month("o_orderdate")
    season = F.when(m.between(7, 10), "Fall").when(m.isin(11, 12, 1, 2), "Winter").otherwise("Spring")
    subject = V.recode("o_orderstatus", {"F": "Reading", "O": "Mathematics"}, default="Science")
    c = t.customer.select(F.col("c_custkey").alias("student_id"), (F.col("c_nationkey") % 9).cast("bigint").alias("grade"), F.col("c_mktsegment").alias("school"))
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("student_id"), subject.alias("subject"), season.alias("season"),
                        D.academic_year("o_orderdate").cast("bigint").alias("academic_year"), F.round(F.col("o_totalprice") / 1000).alias("score"),
                        F.col("o_orderdate").alias("start_ts"))
    return o.join(c, "student_id")


def scores(t):
    return A.dedupe_scores(raw_scores(t), method="highest", ties=["o_orderkey"])


def score_pairs(t):
    """Scores of two terms side by side, stored: norm tables and joins below read them several times."""
    return W.compute(A.growth_pairs(W.compute(scores(t)), WINDOWS))


def status_norms(df):
    keys = ["subject", "grade", "season"]
    # one row per whole score, and scores have an upper end, so the groups stay small
    counts = df.groupBy(*keys, "score").agg(F.count(F.lit(1)).alias("c"))
    run = O.attach(O.cumulate(counts, "c", "sum", "upto", ["score"], keys, small_groups=True), counts.groupBy(*keys).agg(F.sum("c").alias("total")), keys)
    pct = F.greatest(F.least(F.expr("100 * upto div total"), F.lit(99)), F.lit(1))
    return run.select(*keys, "score", pct.alias("percentile"))


def ranked_scores(t):
    s = W.compute(scores(t))
    return O.attach(s, status_norms(s), ["subject", "grade", "season", "score"])


WINDOWS = [("Fall", "Winter", 0), ("Fall", "Spring", 0), ("Spring", "Spring", 1)]
GROWTH_KEYS = ["subject", "start_grade", "start_season", "end_season"]


def growth_norms(pairs):
    ends = pairs.groupBy(*GROWTH_KEYS).agg(F.avg("end_score").alias("m"), F.stddev_samp("end_score").alias("sd"))
    starts = pairs.select(*GROWTH_KEYS, "start_score").distinct()
    out = O.attach(starts, ends, GROWTH_KEYS)
    return out.select(F.col("subject"), F.col("start_grade").alias("grade"), "start_season", "end_season", "start_score",
                      F.round(F.col("m") - F.col("start_score"), 4).alias("expected_growth"), F.round("sd", 4).alias("sd_growth"))


def growth(t):
    pairs = score_pairs(t)
    return A.normed_growth(pairs, growth_norms(pairs))


def school_status_norms(df):
    keys = ["subject", "grade", "season"]
    means = df.groupBy(*keys, "school").agg(F.round(F.avg("score")).alias("score"))
    table = means.groupBy(*keys, "score").agg(F.count(F.lit(1)).alias("c"))
    run = O.attach(O.cumulate(table, "c", "sum", "upto", ["score"], keys, small_groups=True), table.groupBy(*keys).agg(F.sum("c").alias("total")), keys)
    return run.select(*keys, "score", F.expr("100 * upto div total").alias("percentile"))


def school_growth_norms(t, pairs):
    school = pairs.join(t.customer.select(F.col("c_custkey").alias("student_id"), F.col("c_mktsegment").alias("school")), "student_id")
    per = school.groupBy(*GROWTH_KEYS, "school").agg(F.round(F.avg("start_score")).cast("bigint").alias("start_mean"), F.avg(F.col("end_score") - F.col("start_score")).alias("g"))
    whole = per.groupBy(*GROWTH_KEYS).agg(F.round(F.avg("g"), 4).alias("expected_growth"), F.round(F.stddev_samp("g"), 4).alias("sd_growth"))
    starts = per.select(*GROWTH_KEYS, "start_mean").distinct()
    return school, O.attach(starts, whole, GROWTH_KEYS).withColumnRenamed("start_grade", "grade")


RAW_SQL = """raw AS (SELECT o_orderkey, o_custkey AS student_id, CASE o_orderstatus WHEN 'F' THEN 'Reading' WHEN 'O' THEN 'Mathematics' ELSE 'Science' END AS subject,
 CAST(c_nationkey % 9 AS BIGINT) AS grade, CASE WHEN month(o_orderdate) IN (7, 8, 9, 10) THEN 'Fall' WHEN month(o_orderdate) IN (11, 12, 1, 2) THEN 'Winter' ELSE 'Spring' END AS season,
 year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS academic_year, ROUND(o_totalprice / 1000) AS score, o_orderdate AS start_ts, c_mktsegment AS school
 FROM orders JOIN customer ON o_custkey = c_custkey)"""
SCORES_SQL = "WITH " + RAW_SQL + """, scores AS (SELECT * EXCLUDE r FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id, subject, academic_year, season
 ORDER BY score DESC, start_ts DESC, o_orderkey) AS r FROM raw) WHERE r = 1)
"""
RANKED_SQL = SCORES_SQL + """, norms AS (SELECT subject, grade, season, score, GREATEST(LEAST(100 * SUM(c) OVER (PARTITION BY subject, grade, season ORDER BY score)::BIGINT // SUM(c) OVER (PARTITION BY subject, grade, season)::BIGINT, 99), 1) AS percentile
 FROM (SELECT subject, grade, season, score, COUNT(*) AS c FROM scores GROUP BY ALL)), ranked AS (SELECT scores.*, percentile FROM scores JOIN norms USING (subject, grade, season, score))
"""
PAIRS_SQL = SCORES_SQL + """, w AS (SELECT * FROM (VALUES ('Fall', 'Winter', 0), ('Fall', 'Spring', 0), ('Spring', 'Spring', 1)) v(s, e, gap)),
pairs AS (SELECT a.student_id, a.subject, a.school, a.season AS start_season, a.academic_year AS start_year, a.grade AS start_grade, a.score AS start_score, b.season AS end_season, b.academic_year AS end_year,
 b.grade AS end_grade, b.score AS end_score FROM scores a JOIN w ON a.season = s JOIN scores b ON b.student_id = a.student_id AND b.subject = a.subject AND b.season = e AND b.academic_year = a.academic_year + gap)
"""
GROWTH_SQL = PAIRS_SQL + """, gn AS (SELECT subject, start_grade, start_season, end_season, AVG(end_score) AS m, STDDEV_SAMP(end_score) AS sd FROM pairs GROUP BY ALL),
growth AS (SELECT p.*, ROUND(m - start_score, 4) AS expected_growth, ROUND(sd, 4) AS sd_growth, end_score - start_score AS growth, end_score - start_score >= ROUND(m - start_score, 4) AS met
 FROM pairs p JOIN gn USING (subject, start_grade, start_season, end_season))
"""
SCHOOL_SQL = PAIRS_SQL + """, per AS (SELECT subject, start_grade, start_season, end_season, school, COUNT(*) AS n, AVG(start_score) AS start_mean, AVG(end_score) AS end_mean, AVG(end_score - start_score) AS g FROM pairs GROUP BY ALL),
sn AS (SELECT subject, start_grade, start_season, end_season, ROUND(AVG(g), 4) AS expected_growth, ROUND(STDDEV_SAMP(g), 4) AS sd_growth FROM per GROUP BY ALL)
"""

# ----------------------------------------------------------------- preparing


@query("detect_migrate_layout", "SELECT o_orderkey, o_custkey AS student_id, o_totalprice AS score, 'Survey' AS test_type, 'old' AS layout FROM orders")
def detect_migrate_layout(t):
    old = t.orders.select("o_orderkey", F.col("o_custkey").alias("StudentID"), F.col("o_totalprice").alias("TestScore"))
    layouts = {"new": {"student_id", "score", "test_type"}, "old": {"StudentID", "TestScore"}}
    found = A.detect_layout(old, layouts)
    return A.migrate_layout(old, {"StudentID": "student_id", "TestScore": "score"}, {"test_type": "Survey"}).withColumn("layout", F.lit(found))


@query("check_score_table", "WITH " + RAW_SQL + """ SELECT 'student_id present' AS rule, 0::BIGINT AS n_bad, TRUE AS ok UNION ALL SELECT 'subject present', 0, TRUE UNION ALL SELECT 'known season', 0, TRUE
UNION ALL SELECT 'grade in range', 0, TRUE UNION ALL SELECT 'score present', COUNT(*), COUNT(*) = 0 FROM raw WHERE score > 490""")
def check_score_table(t):
    s = raw_scores(t)
    return A.check_scores(s.withColumn("score", F.when(F.col("score") <= 490, F.col("score"))))


@query("prepared_scores", """SELECT student_id, season, academic_year, grade, ROUND(score, 2) AS score FROM (SELECT o_custkey AS student_id, CASE WHEN month(o_orderdate) < 7 THEN 'Spring' ELSE 'Fall' END AS season,
year(o_orderdate)::BIGINT AS academic_year, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS grade, o_totalprice AS score FROM orders)""")
def prepared_scores(t):
    y = F.year("o_orderdate").cast("string")
    term = F.concat(F.when(F.month("o_orderdate") < 7, "SPRING ").otherwise("Fall "), y, F.lit("-"), (F.year("o_orderdate") + 1).cast("string"))
    grade = F.when(F.col("o_orderpriority") == "5-LOW", "Kinder").otherwise(F.substring("o_orderpriority", 1, 1))
    raw = t.orders.select(F.col("o_custkey").cast("string").alias("Student ID"), term.alias("TermName"), grade.alias("Grade"), F.col("o_totalprice").cast("string").alias("Score"))
    out = A.prep_scores(raw)
    return out.select("student_id", "season", F.col("academic_year").cast("bigint").alias("academic_year"), F.col("grade").cast("bigint").alias("grade"), F.round("score", 2).alias("score"))


@query("prepared_roster", "WITH " + RAW_SQL + """ SELECT student_id, academic_year, season, CASE WHEN grade = 0 THEN 0 ELSE grade END AS grade, school, n_rows FROM (SELECT student_id, academic_year, season, grade, school, COUNT(*) AS n_rows FROM raw GROUP BY ALL)""")
def prepared_roster(t):
    raw = raw_scores(t)
    r = raw.select("student_id", "academic_year", "season", F.when(F.col("grade") == 0, "K").otherwise(F.col("grade").cast("string")).alias("grade"), "school")
    one = A.prep_roster(r)
    n = raw.groupBy("student_id", "academic_year", "season").agg(F.count(F.lit(1)).alias("n_rows"))
    return O.attach(one, n, ["student_id", "academic_year", "season"]).withColumn("grade", F.col("grade").cast("bigint"))


@query("dedupe_highest", SCORES_SQL + "SELECT o_orderkey, score FROM scores")
def dedupe_highest(t):
    return scores(t).select("o_orderkey", "score")


@query("dedupe_latest", "WITH " + RAW_SQL + """ SELECT o_orderkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id, subject, academic_year, season ORDER BY start_ts DESC, score DESC, o_orderkey) AS r FROM raw) WHERE r = 1""")
def dedupe_latest(t):
    return A.dedupe_scores(raw_scores(t), method="latest", ties=["o_orderkey"]).select("o_orderkey")


@query("roster_attached", SCORES_SQL + """SELECT o_orderkey, n_tests FROM scores JOIN (SELECT student_id, academic_year, season, COUNT(*) AS n_tests FROM raw GROUP BY ALL) USING (student_id, academic_year, season)""")
def roster_attached(t):
    roster = raw_scores(t).groupBy("student_id", "academic_year", "season").agg(F.count(F.lit(1)).alias("n_tests"))
    return A.attach_roster(scores(t), roster).select("o_orderkey", "n_tests")


@query("roster_attached_growth", PAIRS_SQL + """SELECT student_id, subject, start_season, start_year, end_season, n_tests FROM pairs LEFT JOIN (SELECT student_id, academic_year AS end_year, season AS end_season, COUNT(*) AS n_tests FROM raw GROUP BY ALL) USING (student_id, end_year, end_season)""")
def roster_attached_growth(t):
    roster = raw_scores(t).groupBy("student_id", "academic_year", "season").agg(F.count(F.lit(1)).alias("n_tests"))
    pairs = score_pairs(t)
    return A.attach_roster_growth(pairs, roster).select("student_id", "subject", "start_season", "start_year", "end_season", "n_tests")


@query("grade_and_season_number", SCORES_SQL + "SELECT o_orderkey, ROUND(grade + CASE season WHEN 'Fall' THEN 0 WHEN 'Winter' THEN 0.5 ELSE 0.8 END, 2)::DOUBLE AS level FROM scores")
def grade_and_season_number(t):
    return scores(t).select("o_orderkey", F.round(A.grade_level_season("grade", "season"), 2).alias("level"))


@query("collapsed_by_grade", "WITH " + RAW_SQL + """ SELECT student_id, subject, grade, season, score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id, subject, grade, season ORDER BY start_ts DESC, score DESC) AS r FROM raw) WHERE r = 1""")
def collapsed_by_grade(t):
    return A.collapse_by_grade(raw_scores(t)).select("student_id", "subject", "grade", "season", "score")


# ------------------------------------------------------------------- bundle

@query("assessment_set_verbs", RANKED_SQL + "SELECT school, subject, COUNT(*) AS n, MAX(score) AS top FROM ranked WHERE percentile >= 50 GROUP BY 1, 2")
def assessment_set_verbs(t):
    bundle = A.AssessmentSet(ranked_scores(t))
    kept = bundle.filter(F.col("percentile") >= 50).select("school", "subject", "score").group_by("school", "subject")
    return kept.summarise(n=F.count(F.lit(1)), top=F.max("score"))


@query("assessment_set_summary", RANKED_SQL + """SELECT subject, season, academic_year, COUNT(DISTINCT student_id) AS n_students, ROUND(AVG(score), 6) AS mean_score, ROUND(AVG(percentile), 6) AS mean_percentile, ROUND(MEDIAN(score), 6) AS median_score FROM ranked GROUP BY ALL""")
def assessment_set_summary(t):
    out = A.AssessmentSet(ranked_scores(t)).summary()
    return out.withColumns({c: F.round(c, 6) for c in ("mean_score", "mean_percentile", "median_score")})


@query("limited_scores", SCORES_SQL + "SELECT o_orderkey FROM scores WHERE subject = 'Reading' AND academic_year BETWEEN 1996 AND 1999 AND student_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def limited_scores(t):
    rich = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("student_id"))
    return A.limit_scores(scores(t), rich, "Reading", (1996, 1999)).select("o_orderkey")


@query("limited_growth", PAIRS_SQL + "SELECT student_id, start_year, end_score FROM pairs WHERE subject = 'Mathematics' AND start_season = 'Fall' AND end_season = 'Spring'")
def limited_growth(t):
    return A.limit_growth(score_pairs(t), subject="Mathematics", window=("Fall", "Spring")).select("student_id", "start_year", "end_score")


@query("students_with_terms", SCORES_SQL + "SELECT o_orderkey FROM scores WHERE (student_id, subject) IN (SELECT (student_id, subject) FROM scores GROUP BY student_id, subject HAVING COUNT(DISTINCT (academic_year, season)) >= 5)")
def students_with_terms(t):
    return A.min_terms(scores(t), 5).select("o_orderkey")


@query("automatic_window", PAIRS_SQL.replace('FROM raw) WHERE r = 1)', 'FROM raw) WHERE r = 1 AND academic_year BETWEEN 1994 AND 2000)') + """SELECT start_season, end_season, gap, n_students, ROUND(share, 6) AS share FROM (SELECT start_season, end_season, end_year - start_year AS gap, COUNT(DISTINCT student_id) AS n_students,
COUNT(DISTINCT student_id) / (SELECT COUNT(DISTINCT student_id) FROM scores WHERE academic_year = (SELECT MAX(academic_year) FROM scores)) AS share FROM pairs WHERE end_year = (SELECT MAX(academic_year) FROM scores) GROUP BY ALL)
WHERE share >= 0.02 ORDER BY CASE WHEN start_season = 'Fall' AND end_season = 'Winter' THEN 0 WHEN start_season = 'Fall' THEN 1 ELSE 2 END LIMIT 1""")
def automatic_window(t):
    # the year the data ends in is not complete
    done = A.limit_scores(scores(t), years=(1994, 2000))
    out = A.auto_window(done, WINDOWS, 0.02)
    return out.select("start_season", "end_season", "gap", "n_students", F.round("share", 6).alias("share"))


@query("baseline_with_fallback", SCORES_SQL + """SELECT student_id, subject, y AS target_year, season AS base_season, academic_year AS base_year, score AS base_score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY student_id, subject, y ORDER BY p, score) AS r FROM
(SELECT *, academic_year AS y, 0 AS p FROM scores WHERE season = 'Fall' UNION ALL SELECT *, academic_year + 1, 1 FROM scores WHERE season = 'Spring' UNION ALL SELECT *, academic_year, 2 FROM scores WHERE season = 'Winter')) WHERE r = 1""")
def baseline_with_fallback(t):
    return A.preferred_baseline(scores(t), [("Fall", 0), ("Spring", 1), ("Winter", 0)])


# ------------------------------------------------------------------- growth

@query("growth_pairs", PAIRS_SQL + "SELECT student_id, subject, start_season, start_year, start_score, end_season, end_year, end_score, start_grade, end_grade FROM pairs")
def growth_pairs(t):
    return score_pairs(t)


@query("normed_growth", GROWTH_SQL + "SELECT student_id, subject, start_season, start_year, end_season, growth, expected_growth, met, ROUND((growth - expected_growth) / sd_growth, 4) AS z FROM growth")
def normed_growth(t):
    return growth(t).select("student_id", "subject", "start_season", "start_year", "end_season", "growth", "expected_growth", "met", F.round("z", 4).alias("z"))


def _factors(t):
    """Growth factors by start quartile and grade band: an input of the operator, the higher the lower the start."""
    rows = [(q, band, 1.0 + (5 - q) / 10 * k) for q in (1, 2, 3, 4) for band, k in (("lower", 1), ("upper", 2))]
    return t.spark.createDataFrame(rows, "quartile int, band string, factor double")


_FACTOR = "(1.0 + (5 - q) / 10 * CASE WHEN start_grade < 4 THEN 1 ELSE 2 END)"


@query("accelerated_growth", GROWTH_SQL + f"""SELECT student_id, subject, start_season, start_year, end_season, band, ROUND(expected_growth * {_FACTOR}, 3) AS accelerated_growth, end_score >= start_score + expected_growth * {_FACTOR} AS met_accelerated
FROM (SELECT *, CASE WHEN start_grade < 4 THEN 'lower' ELSE 'upper' END AS band, CASE WHEN start_score < 125 THEN 1 WHEN start_score < 250 THEN 2 WHEN start_score < 375 THEN 3 ELSE 4 END AS q FROM growth)""")
def accelerated_growth(t):
    g = growth(t).withColumn("quartile", A.quartile("start_score", (125, 250, 375)))
    out = A.accelerated_growth(g, _factors(t))
    return out.select("student_id", "subject", "start_season", "start_year", "end_season", "band", F.round("accelerated_growth", 3).alias("accelerated_growth"), "met_accelerated")


@query("student_change", PAIRS_SQL + "SELECT student_id, subject, start_year, start_score, end_score, end_score - start_score AS change FROM pairs WHERE start_season = 'Spring'")
def student_change(t):
    return A.student_change(scores(t), ("Spring", "Spring", 1)).select("student_id", "subject", "start_year", "start_score", "end_score", "change")


@query("percentile_quartiles", RANKED_SQL + "SELECT o_orderkey, CASE WHEN percentile < 25 THEN 1 WHEN percentile < 50 THEN 2 WHEN percentile < 75 THEN 3 ELSE 4 END::BIGINT AS q FROM ranked")
def percentile_quartiles(t):
    return ranked_scores(t).select("o_orderkey", A.quartile("percentile").cast("bigint").alias("q"))


@query("adhoc_quartiles", SCORES_SQL + "SELECT o_orderkey, NTILE(4) OVER (PARTITION BY subject, academic_year, season ORDER BY score, o_orderkey) AS quartile FROM scores")
def adhoc_quartiles(t):
    return A.adhoc_quartile(scores(t), "score", ["subject", "academic_year", "season"], ties=["o_orderkey"]).select("o_orderkey", "quartile")


@query("gain_needed", RANKED_SQL + """SELECT o_orderkey, target_score, GREATEST(target_score - score, 0) AS gain_needed FROM scores LEFT JOIN (SELECT subject, grade, season, MIN(score) AS target_score FROM norms WHERE percentile >= 75 GROUP BY ALL) USING (subject, grade, season)""")
def gain_needed(t):
    s = scores(t)
    return A.gain_needed(s, status_norms(s), 75).select("o_orderkey", "target_score", "gain_needed")


@query("estimated_score", SCORES_SQL + """, target AS (SELECT DISTINCT student_id, subject, make_timestamp(academic_year, 10, 1, 0, 0, 0) AS target_ts FROM scores),
near AS (SELECT t.*, s.score, ROW_NUMBER() OVER (PARTITION BY t.student_id, t.subject, target_ts ORDER BY ABS(epoch(start_ts) - epoch(target_ts)), start_ts, score DESC) AS r, ABS(epoch(start_ts) - epoch(target_ts)) / 86400 AS days
FROM target t JOIN scores s USING (student_id, subject)) SELECT student_id, subject, strftime(target_ts, '%Y-%m-%d') AS target, CASE WHEN days <= 120 THEN score END AS score FROM near WHERE r = 1""")
def estimated_score(t):
    s = scores(t)
    targets = s.select("student_id", "subject", F.make_timestamp(F.col("academic_year").cast("int"), F.lit(10), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("target_ts")).distinct()
    out = A.estimate_score(s, targets, 120)
    return out.select("student_id", "subject", F.date_format("target_ts", "yyyy-MM-dd").alias("target"), "score")


@query("imputed_scores", SCORES_SQL + """, n AS (SELECT *, academic_year * 10 + CASE season WHEN 'Fall' THEN 1 WHEN 'Winter' THEN 2 ELSE 3 END AS tn FROM scores), terms AS (SELECT DISTINCT academic_year, season, tn FROM n),
grid AS (SELECT student_id, subject, terms.* FROM (SELECT student_id, subject, MIN(tn) AS a, MAX(tn) AS b FROM n GROUP BY ALL) JOIN terms ON tn BETWEEN a AND b),
f AS (SELECT g.*, n.score FROM grid g LEFT JOIN n USING (student_id, subject, tn))
SELECT student_id, subject, academic_year, season, score IS NULL AS imputed, ROUND(COALESCE(score, (LAST_VALUE(score IGNORE NULLS) OVER (PARTITION BY student_id, subject ORDER BY tn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
 + FIRST_VALUE(score IGNORE NULLS) OVER (PARTITION BY student_id, subject ORDER BY tn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) / 2), 4) AS score FROM f""")
def imputed_scores(t):
    out = A.impute_scores(scores(t))
    return out.select("student_id", "subject", "academic_year", "season", "imputed", F.round("score", 4).alias("score"))


# ------------------------------------------------------------------ cohorts

@query("cohort_percentiles", SCORES_SQL + """, m AS (SELECT subject, grade, season, ROUND(AVG(score)) AS score FROM scores GROUP BY subject, grade, season, school),
sn AS (SELECT subject, grade, season, score, 100 * SUM(c) OVER (PARTITION BY subject, grade, season ORDER BY score)::BIGINT // SUM(c) OVER (PARTITION BY subject, grade, season)::BIGINT AS percentile FROM (SELECT *, COUNT(*) AS c FROM m GROUP BY ALL)),
e AS (SELECT subject, grade, season, MIN(score) AS lo, MAX(score) AS hi FROM sn GROUP BY ALL),
x AS (SELECT academic_year, subject, grade, season, COUNT(*) AS n, AVG(score) AS mean_score FROM scores GROUP BY ALL)
SELECT x.academic_year, x.subject, x.grade, x.season, n, ROUND(mean_score, 6) AS mean_score, percentile FROM x JOIN e USING (subject, grade, season) LEFT JOIN sn ON sn.subject = x.subject AND sn.grade = x.grade AND sn.season = x.season AND sn.score = LEAST(GREATEST(ROUND(mean_score), lo), hi)""")
def cohort_percentiles(t):
    s = scores(t)
    out = A.cohort_percentile(s, school_status_norms(s), ["academic_year"])
    return out.withColumn("mean_score", F.round("mean_score", 6))


@query("cohort_expectations", SCHOOL_SQL + "SELECT school, subject, start_grade, start_season, end_season, n, ROUND(start_mean, 6) AS start_mean, ROUND(start_mean + expected_growth, 3) AS expected_end FROM per JOIN sn USING (subject, start_grade, start_season, end_season)")
def cohort_expectations(t):
    school, norms = school_growth_norms(t, score_pairs(t))
    out = A.cohort_expectation(school, norms, ["school"])
    return out.select("school", *GROWTH_KEYS, "n", F.round("start_mean", 6).alias("start_mean"), F.round("expected_end", 3).alias("expected_end"))


@query("cohort_growth_z", SCHOOL_SQL + "SELECT school, subject, start_grade, start_season, end_season, n, ROUND((end_mean - start_mean - expected_growth) / sd_growth, 3) AS z, (end_mean - start_mean - expected_growth) / sd_growth > 0 AS above FROM per JOIN sn USING (subject, start_grade, start_season, end_season)")
def cohort_growth_z(t):
    school, norms = school_growth_norms(t, score_pairs(t))
    out = A.cohort_growth_percentile(school, norms, ["school"])
    return out.select("school", *GROWTH_KEYS, "n", F.round("z", 3).alias("z"), F.when(F.col("z").isNotNull(), F.col("cgp") > 50).alias("above"))


# the normal quantiles of 0.5, 0.75 and 0.9
@query("cohort_growth_targets", SCHOOL_SQL + """SELECT school, subject, start_grade, start_season, end_season, cgp::DOUBLE AS cgp, ROUND(start_mean + expected_growth + q * sd_growth, 3) AS target_mean
FROM per JOIN sn USING (subject, start_grade, start_season, end_season), (VALUES (50, 0.0::DOUBLE), (75, 0.6744897501960817::DOUBLE), (90, 1.2815515655446004::DOUBLE)) v(cgp, q)""")
def cohort_growth_targets(t):
    school, norms = school_growth_norms(t, score_pairs(t))
    return A.cohort_targets(school, norms, ["school"], [50, 75, 90]).select("school", *GROWTH_KEYS, "cgp", F.round("target_mean", 3).alias("target_mean"))


@query("score_summary", RANKED_SQL + """SELECT school, subject, academic_year, COUNT(DISTINCT student_id) AS n_students, ROUND(AVG(score), 6) AS mean_score, ROUND(AVG(percentile), 6) AS mean_percentile, ROUND(MEDIAN(score), 6) AS median_score FROM ranked GROUP BY ALL""")
def score_summary(t):
    out = A.summarise_scores(ranked_scores(t), ["school", "subject", "academic_year"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean_score", "mean_percentile", "median_score")})


@query("growth_summary", GROWTH_SQL + """SELECT subject, start_season, end_season, start_year, COUNT(*) AS n, ROUND(AVG(met::INT), 6) AS pct_met, ROUND(AVG(growth), 6) AS mean_growth, ROUND(MEDIAN(growth), 6) AS median_growth FROM growth GROUP BY ALL""")
def growth_summary(t):
    out = A.summarise_growth(growth(t), ["subject", "start_season", "end_season", "start_year"])
    return out.withColumns({c: F.round(c, 6) for c in ("pct_met", "mean_growth", "median_growth")})


@query("state_level_link", SCORES_SQL + """, r AS (SELECT subject, grade, season, MIN(score) AS lo, MAX(score) + 1 AS hi, FLOOR((MIN(score) + MAX(score)) / 2) AS mid FROM scores GROUP BY ALL)
SELECT o_orderkey, CASE WHEN score < mid THEN 'below' ELSE 'proficient' END AS level, CASE WHEN score < mid THEN 0.25 ELSE 0.75 END::DOUBLE AS pass_prob FROM scores JOIN r USING (subject, grade, season)""")
def state_level_link(t):
    s = scores(t)
    r = s.groupBy("subject", "grade", "season").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    mid = F.floor((F.col("lo") + F.col("hi")) / 2)
    bands = F.array(F.struct(F.col("lo").alias("score_lo"), mid.cast("double").alias("score_hi"), F.lit("below").alias("level"), F.lit(0.25).alias("pass_prob")),
                    F.struct(mid.cast("double").alias("score_lo"), (F.col("hi") + 1).alias("score_hi"), F.lit("proficient").alias("level"), F.lit(0.75).alias("pass_prob")))
    link = r.select("subject", "grade", "season", F.inline(bands))
    return A.link_to_state(s, link).select("o_orderkey", "level", "pass_prob")


@query("subgroup_statistics", RANKED_SQL + """SELECT 'school' AS subgroup, school AS level, COUNT(*) AS n, ROUND(AVG(score), 6) AS mean FROM ranked GROUP BY school UNION ALL SELECT 'grade', CAST(grade AS VARCHAR), COUNT(*), ROUND(AVG(score), 6) FROM ranked GROUP BY grade
UNION ALL SELECT 'season', season, COUNT(*), ROUND(AVG(score), 6) FROM ranked GROUP BY season UNION ALL SELECT 'all', NULL, COUNT(*), ROUND(AVG(score), 6) FROM ranked""")
def subgroup_statistics(t):
    return A.subgroup_stats(scores(t), ["school", "grade", "season"], {"n": F.count(F.lit(1)), "mean": F.round(F.avg("score"), 6)})


@query("permutation_test", SCORES_SQL + """, sizes AS (SELECT school, COUNT(*) AS n, AVG(score) AS mean, SUM(COUNT(*)) OVER (ORDER BY school) AS hi, AVG(score) - (SELECT AVG(score) FROM scores) AS diff FROM scores GROUP BY school),
placed AS (SELECT p, score, ROW_NUMBER() OVER (PARTITION BY p ORDER BY md5('4:' || p || ':' || o_orderkey), o_orderkey) AS pos FROM scores, range(1, 21) t(p)),
means AS (SELECT p, school, AVG(score) - (SELECT AVG(score) FROM scores) AS d FROM placed JOIN sizes ON pos > hi - n AND pos <= hi GROUP BY 1, 2)
SELECT school, n, ROUND(mean, 6) AS mean, ROUND(diff, 6) AS diff, ROUND(p_value, 6) AS p_value
FROM sizes JOIN (SELECT school, (COUNT(*) FILTER (ABS(d) >= ABS(diff)) + 1) / 21.0::DOUBLE AS p_value FROM means JOIN sizes USING (school) GROUP BY 1) USING (school)""")
def permutation_test(t):
    out = A.permutation_stats(scores(t), "school", "score", "o_orderkey", n=20, seed=4)
    return out.select("school", "n", *[F.round(c, 6).alias(c) for c in ("mean", "diff", "p_value")])


@query("one_way_summary", RANKED_SQL + "SELECT school, subject, COUNT(*) AS n, ROUND(AVG(score), 6) AS mean_score, ROUND(AVG(percentile), 6) AS mean_percentile, ROUND(AVG((percentile >= 50)::INT), 6) AS share_above FROM ranked GROUP BY ALL")
def one_way_summary(t):
    out = A.summary_1d(ranked_scores(t), ["school", "subject"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean_score", "mean_percentile", "share_above")})


@query("band_lists", RANKED_SQL + """SELECT o_orderkey, band::BIGINT AS band, ROW_NUMBER() OVER (PARTITION BY school, band ORDER BY score DESC, student_id, o_orderkey) AS place FROM (SELECT *, CASE WHEN percentile < 25 THEN 1 WHEN percentile < 50 THEN 2 WHEN percentile < 75 THEN 3 ELSE 4 END AS band FROM ranked)""")
def band_lists(t):
    out = A.band_lists(ranked_scores(t), ["school"], ties=["o_orderkey"])
    return out.select("o_orderkey", F.col("band").cast("bigint").alias("band"), "place")


@query("report_by_grouping", SCORES_SQL + """SELECT 'school' AS subgroup, school AS level, COUNT(DISTINCT student_id) AS students, MAX(score) AS top FROM scores GROUP BY school UNION ALL SELECT 'subject', subject, COUNT(DISTINCT student_id), MAX(score) FROM scores GROUP BY subject
UNION ALL SELECT 'all', NULL, COUNT(DISTINCT student_id), MAX(score) FROM scores""")
def report_by_grouping(t):
    return A.report_table(scores(t), {"students": F.count_distinct("student_id"), "top": F.max("score")}, ["school", "subject"])


@query("summary_long_rows", SCORES_SQL + """SELECT academic_year, season, 'n' AS measure, COUNT(*)::DOUBLE AS value FROM scores GROUP BY 1, 2 UNION ALL SELECT academic_year, season, 'top', MAX(score) FROM scores GROUP BY 1, 2""")
def summary_long_rows(t):
    return A.summary_long(scores(t), ["academic_year", "season"], {"n": F.count(F.lit(1)), "top": F.max("score")})


@query("goals_table", GROWTH_SQL + f""", n AS (SELECT DISTINCT subject, start_grade, start_score, expected_growth FROM growth WHERE start_season = 'Fall' AND end_season = 'Spring'), r AS (SELECT subject, start_grade, MIN(start_score) AS lo, MAX(start_score) AS hi FROM n GROUP BY ALL),
s AS (SELECT student_id, subject, academic_year, grade AS start_grade, score AS start_score, CASE WHEN score < 125 THEN 25 ELSE 75 END AS pc FROM scores WHERE season = 'Fall')
SELECT student_id, s.subject, academic_year, ROUND(s.start_score + expected_growth, 3) AS typical_goal, ROUND(s.start_score + expected_growth * (1.0 + (5 - q) / 10 * CASE WHEN s.start_grade < 4 THEN 1 ELSE 2 END), 3) AS goal
FROM (SELECT *, CASE WHEN pc = 25 THEN 2 ELSE 4 END AS q FROM s) s JOIN r USING (subject, start_grade) JOIN n ON n.subject = s.subject AND n.start_grade = s.start_grade AND n.start_score = LEAST(GREATEST(s.start_score, lo), hi)""")
def goals_table(t):
    s = scores(t)
    pairs = A.growth_pairs(s, WINDOWS)
    fall = s.where("season = 'Fall'").withColumn("percentile", F.when(F.col("score") < 125, 25).otherwise(75))
    out = A.goals_table(fall, growth_norms(pairs), _factors(t))
    return out.select("student_id", "subject", "academic_year", F.round("typical_goal", 3).alias("typical_goal"), F.round("goal", 3).alias("goal"))


@query("term_percentiles", SCORES_SQL + "SELECT subject, academic_year, season, ROUND(quantile_cont(score, 0.25), 4) AS p25, ROUND(quantile_cont(score, 0.95), 4) AS p95 FROM scores GROUP BY ALL")
def term_percentiles(t):
    out = A.term_percentile(scores(t), {"p25": 0.25, "p95": 0.95})
    return out.withColumns({c: F.round(c, 4) for c in ("p25", "p95")})


# --------------------------------------------------------------- chart data

@query("growth_histogram", GROWTH_SQL + "SELECT subject, FLOOR(growth / 25) * 25 AS bin, COUNT(*) AS n FROM growth GROUP BY ALL")
def growth_histogram(t):
    return A.histogram(growth(t), "growth", 25, ["subject"])


@query("share_per_quartile", RANKED_SQL + """SELECT school, academic_year, class::BIGINT AS class, n, ROUND(n / SUM(n) OVER (PARTITION BY school, academic_year), 6) AS share FROM (SELECT school, academic_year, CASE WHEN percentile < 25 THEN 1 WHEN percentile < 50 THEN 2 WHEN percentile < 75 THEN 3 ELSE 4 END AS class, COUNT(*) AS n FROM ranked GROUP BY ALL)""")
def share_per_quartile(t):
    out = A.share_by_class(ranked_scores(t), A.quartile("percentile").cast("bigint"), ["school", "academic_year"])
    return out.withColumn("share", F.round("share", 6))


@query("student_points", PAIRS_SQL + "SELECT student_id, subject, start_year, start_score, end_score - start_score AS change, ROW_NUMBER() OVER (PARTITION BY subject ORDER BY start_score, end_score - start_score, student_id, start_year) AS place FROM pairs WHERE start_season = 'Fall' AND end_season = 'Spring'")
def student_points(t):
    return A.student_points(scores(t), ("Fall", "Spring", 0)).select("student_id", "subject", "start_year", "start_score", "change", "place")


@query("cohort_trace", SCORES_SQL + "SELECT school, academic_year, season, COUNT(*) AS n, ROUND(AVG(score), 6) AS mean_score FROM scores GROUP BY ALL")
def cohort_trace(t):
    return A.cohort_trace(scores(t), ["school"]).withColumn("mean_score", F.round("mean_score", 6))


@query("strand_box_statistics", """SELECT l_returnflag, strand, COUNT(*) AS n, MIN(v) AS low, MAX(v) AS high, ROUND(quantile_cont(v, 0.25), 6) AS p25, ROUND(quantile_cont(v, 0.5), 6) AS p50, ROUND(quantile_cont(v, 0.75), 6) AS p75 FROM
(SELECT l_returnflag, 'l_quantity' AS strand, l_quantity AS v FROM lineitem UNION ALL SELECT l_returnflag, 'l_extendedprice', l_extendedprice FROM lineitem) GROUP BY 1, 2""")
def strand_box_statistics(t):
    out = A.strand_stats(t.lineitem, ["l_quantity", "l_extendedprice"], ["l_returnflag"])
    return out.withColumns({c: F.round(c, 6) for c in ("p25", "p50", "p75")})


@query("student_goal_rows")
def student_goal_rows(t):
    s = ranked_scores(t)
    pairs = A.growth_pairs(s, WINDOWS)
    link = s.groupBy("subject", "score").agg(F.count(F.lit(1)).alias("linked"))
    out = A.student_goal_rows(s.where("season = 'Fall'"), link, growth_norms(pairs), _factors(t))
    return out.select("student_id", "subject", "academic_year", F.round("goal", 3).alias("goal"), "linked")


@query("facet_bars", SCORES_SQL + "SELECT 'school' AS subgroup, school AS level, ROUND(AVG(score) - (SELECT AVG(score) FROM scores), 6) AS gap FROM scores GROUP BY school")
def facet_bars(t):
    s = scores(t)
    table = A.subgroup_stats(s, ["school"], {"mean": F.avg("score")})
    whole = s.agg(F.avg("score")).scalar()
    return table.where("subgroup <> 'all'").select("subgroup", "level", F.round(F.col("mean") - whole, 6).alias("gap"))
