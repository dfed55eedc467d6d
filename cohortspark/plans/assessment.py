"""Longitudinal test scores: preparing, growth, norms, cohorts and reports.

Columns: student_id, subject, grade, season, academic_year, score, percentile,
start_ts. Norms, factors, season orders and goals are inputs: no test
publisher's tables are built in, and the rules of this layer are choices of
this library unless a caller passes others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.functions import dates as D
from cohortspark.functions.numbers import norm_cdf, norm_quantile
from cohortspark.operators import ordered as O
from cohortspark.operators import verbs as V
from cohortspark.operators.joins import nearest_join, norm_lookup, overlap_join, within_join
from cohortspark.operators.reshape import clean_names
from cohortspark.session import cut_lineage

STUDENT = ["student_id", "subject"]
TERM = ["academic_year", "season"]

# --------------------------------------------------------------- preparing


def detect_layout(df: DataFrame, layouts: dict[str, set[str]]) -> str | None:
    """Name of the first layout whose columns are all present."""
    names = set(df.columns)
    return next((n for n, cols in layouts.items() if set(cols) <= names), None)


def migrate_layout(df: DataFrame, mapping: dict[str, str], defaults: dict | None = None) -> DataFrame:
    """Old column names to new ones; columns the old layout lacks get a default."""
    out = df.withColumnsRenamed(mapping)
    return out.withColumns({c: F.lit(v) for c, v in (defaults or {}).items() if c not in out.columns})


SCORE_COLUMNS = {"student_id": "bigint", "subject": "string", "grade": "int", "season": "string", "academic_year": "int", "score": "double"}
ROSTER_COLUMNS = {"student_id": "bigint", "academic_year": "int", "season": "string", "grade": "int"}


def check_table(df: DataFrame, rules: dict[str, Column], columns: dict[str, str] | None = None) -> DataFrame:
    """One row per rule: rows that break it, and whether it holds. All rules in one pass."""
    spark = df.sparkSession
    missing = [c for c in (columns or {}) if c not in df.columns]
    if missing:
        return spark.createDataFrame([(f"has {c}", 0, False) for c in missing], "rule string, n_bad bigint, ok boolean")
    counts = df.agg(*[F.count_if(~F.coalesce(cond, F.lit(False))).alias(name) for name, cond in rules.items()])
    long = counts.unpivot([], list(rules), "rule", "n_bad")
    return long.withColumn("ok", F.col("n_bad") == 0)


def check_scores(df: DataFrame) -> DataFrame:
    return check_table(df, {
        "student_id present": F.col("student_id").isNotNull(), "subject present": F.col("subject").isNotNull(),
        "known season": F.col("season").isin(list(D.SEASON_ORDER)), "grade in range": F.col("grade").between(-1, 13),
        "score present": F.col("score").isNotNull()}, SCORE_COLUMNS)


def check_roster(df: DataFrame) -> DataFrame:
    return check_table(df, {"student_id present": F.col("student_id").isNotNull(), "grade in range": F.col("grade").between(-1, 13)}, ROSTER_COLUMNS)


# Codes for kindergarten: a choice of this library.
KINDER = ["K", "KG", "Kinder", "Kindergarten"]


def standardize_kinder(c, codes: list[str] | None = None) -> Column:
    """Grade text to a number, kindergarten is 0."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.upper(F.trim(c.cast("string")))
    return F.when(text.isin([k.upper() for k in (codes or KINDER)]), 0).otherwise(text.try_cast("int"))


def prep_scores(df: DataFrame, names: dict[str, str] | None = None, term: str = "term_name") -> DataFrame:
    """Clean names, split a term such as ``Fall 1998-1999``, type the columns, grade as number."""
    out = clean_names(df).withColumnsRenamed(names or {})
    if term in out.columns:
        out = (out.withColumn("season", D.season_fix(term))
               .withColumn("academic_year", F.regexp_extract(term, r"(\d{4})", 1).try_cast("int")))
    out = out.withColumn("grade", standardize_kinder("grade"))
    return out.withColumns({c: F.col(c).try_cast(k) for c, k in SCORE_COLUMNS.items() if c in out.columns})


def clean_scores(df: DataFrame) -> DataFrame:
    """Rows without student, subject, term or score are dropped."""
    return V.drop_na(df, [c for c in SCORE_COLUMNS if c in df.columns])


def prep_roster(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Grades as numbers, one row per student and term."""
    out = clean_names(df)
    out = out.withColumn("grade", standardize_kinder("grade"))
    keys = ["student_id", *TERM]
    return V.first_rows(out, 1, order or [c for c in out.columns if c not in keys], keys)


DEDUPE = {"highest": ["-score", "-start_ts"], "latest": ["-start_ts", "-score"], "first": ["start_ts", "-score"]}


def dedupe_scores(df: DataFrame, keys: list[str] | None = None, method: str = "highest", ties: list[str] | None = None) -> DataFrame:
    """One row per student, subject and term."""
    return V.first_rows(df, 1, [*DEDUPE[method], *(ties or [])], keys or [*STUDENT, *TERM])


def attach_roster(df: DataFrame, roster: DataFrame) -> DataFrame:
    """Roster columns by student and term."""
    keys = ["student_id", *TERM]
    extra = [c for c in roster.columns if c not in keys and c not in df.columns]
    return O.attach(df, roster.select(*keys, *extra), keys)


def attach_roster_growth(growth: DataFrame, roster: DataFrame) -> DataFrame:
    """Roster columns as of the end term of a growth row."""
    table = roster.withColumnsRenamed({"academic_year": "end_year", "season": "end_season"})
    keys = ["student_id", "end_year", "end_season"]
    extra = [c for c in table.columns if c not in keys and c not in growth.columns]
    return O.attach(growth, table.select(*keys, *extra), keys)


# Part of a grade that has passed in each season: a choice of this library.
SEASON_OFFSETS = {"Fall": 0.0, "Winter": 0.5, "Spring": 0.8}


def grade_level_season(grade, season, offsets: dict[str, float] | None = None) -> Column:
    """Grade and season as one ordered number."""
    out = F
    for name, off in (offsets or SEASON_OFFSETS).items():
        out = out.when(F.col(season) == name, F.lit(off))
    return F.col(grade) + out.otherwise(None)


def collapse_by_grade(df: DataFrame) -> DataFrame:
    """One row per student, subject, grade and season: the latest."""
    return V.first_rows(df, 1, ["-start_ts", "-score"], [*STUDENT, "grade", "season"])


# ------------------------------------------------------------------ bundle

@dataclass(frozen=True)
class AssessmentSet:
    """Scores, roster and growth that belong together; verbs work on the scores."""
    scores: DataFrame
    roster: DataFrame | None = None
    growth: DataFrame | None = None
    groups: tuple[str, ...] = ()

    def filter(self, *conds: Column) -> "AssessmentSet":
        return replace(self, scores=V.filter(self.scores, *conds))

    def mutate(self, **exprs: Column) -> "AssessmentSet":
        return replace(self, scores=V.mutate(self.scores, by=list(self.groups) or None, **exprs))

    def select(self, *specs) -> "AssessmentSet":
        return replace(self, scores=V.select(self.scores, *specs))

    def arrange(self, *order: str) -> "AssessmentSet":
        return replace(self, scores=V.arrange(self.scores, *order))

    def group_by(self, *keys: str) -> "AssessmentSet":
        return replace(self, groups=keys)

    def ungroup(self) -> "AssessmentSet":
        return replace(self, groups=())

    def summarise(self, **aggs: Column) -> DataFrame:
        return self.scores.groupBy(*self.groups).agg(*[a.alias(n) for n, a in aggs.items()])

    def summary(self) -> DataFrame:
        return summarise_scores(self.scores, list(self.groups) or ["subject", "season", "academic_year"])

    def __str__(self) -> str:
        return f"AssessmentSet(scores={len(self.scores.columns)} columns, growth={'yes' if self.growth is not None else 'no'})"


def is_assessment_set(x) -> bool:
    return isinstance(x, AssessmentSet)


def limit_scores(df: DataFrame, students: DataFrame | None = None, subject: str | None = None,
                 years: tuple[int, int] | None = None) -> DataFrame:
    """Rows of the listed students, of a subject, of a span of years."""
    if subject is not None:
        df = df.where(F.col("subject") == subject)
    if years is not None:
        df = df.where(F.col("academic_year").between(*years))
    return df if students is None else df.join(students.select("student_id").distinct(), "student_id", "left_semi")


def limit_growth(growth: DataFrame, students: DataFrame | None = None, subject: str | None = None,
                 window: tuple[str, str] | None = None) -> DataFrame:
    out = limit_scores(growth, students, subject)
    if window:
        out = out.where((F.col("start_season") == window[0]) & (F.col("end_season") == window[1]))
    return out


def min_terms(df: DataFrame, n: int) -> DataFrame:
    """Rows of students with at least n terms in the subject."""
    enough = (df.groupBy(*STUDENT).agg(F.count_distinct(F.struct(*TERM)).alias("__t")).where(F.col("__t") >= n).select(*STUDENT))
    return df.join(enough, STUDENT, "left_semi")


# ------------------------------------------------------------------ growth

Window_ = tuple[str, str, int]  # start season, end season, years between

WINDOWS: list[Window_] = [("Fall", "Winter", 0), ("Fall", "Spring", 0), ("Winter", "Spring", 0), ("Spring", "Spring", 1), ("Fall", "Fall", 1)]


def growth_pairs(df: DataFrame, windows: list[Window_] | None = None, complete: bool = True) -> DataFrame:
    """Start and end score of each student and subject for each window.

    Each start row names the term it looks for, so one equi join on student,
    subject and end term does all windows.
    """
    options = F.array(*[F.struct(F.lit(a).alias("s"), F.lit(b).alias("e"), F.lit(g).alias("gap")) for a, b, g in (windows or WINDOWS)])
    start = (df.withColumn("__w", F.explode(F.filter(options, lambda w: w["s"] == F.col("season"))))
             .select(*STUDENT, F.col("season").alias("start_season"), F.col("academic_year").alias("start_year"),
                     F.col("grade").alias("start_grade"), F.col("score").alias("start_score"),
                     F.col("__w.e").alias("end_season"), (F.col("academic_year") + F.col("__w.gap")).alias("end_year")))
    end = df.select(*STUDENT, F.col("season").alias("end_season"), F.col("academic_year").alias("end_year"),
                    F.col("grade").alias("end_grade"), F.col("score").alias("end_score"))
    return start.join(end, [*STUDENT, "end_season", "end_year"], "inner" if complete else "left")


def auto_window(df: DataFrame, prefs: list[Window_], min_share: float = 0.5) -> DataFrame:
    """First preferred window that enough of the students tested in the last year have."""
    last = df.agg(F.max("academic_year").alias("y")).scalar()
    pairs = growth_pairs(df, prefs).where(F.col("end_year") == last)
    table = pairs.groupBy("start_season", "end_season", (F.col("end_year") - F.col("start_year")).alias("gap")).agg(
        F.count_distinct("student_id").alias("n_students"))
    total = df.where(F.col("academic_year") == last).agg(F.count_distinct("student_id")).scalar()
    rank = F
    for i, (a, b, g) in enumerate(prefs):
        rank = rank.when((F.col("start_season") == a) & (F.col("end_season") == b) & (F.col("gap") == g), i)
    table = table.withColumn("share", F.col("n_students") / total).withColumn("rank", rank.otherwise(len(prefs)))
    return V.head(table.where(F.col("share") >= min_share), 1, ["rank"])


def preferred_baseline(df: DataFrame, prefs: list[tuple[str, int]]) -> DataFrame:
    """Baseline score per student, subject and year: the first term of the list that has one.

    Each preference is (season, years back).
    """
    options = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(b).alias("b"), F.lit(i).alias("i")) for i, (s, b) in enumerate(prefs)])
    offered = (df.withColumn("__p", F.explode(F.filter(options, lambda p: p["s"] == F.col("season"))))
               .withColumn("target_year", F.col("academic_year") + F.col("__p.b")))
    best = F.min_by(F.struct("season", "academic_year", "score"), F.struct(F.col("__p.i"), F.col("score")))
    out = offered.groupBy(*STUDENT, "target_year").agg(best.alias("b"))
    return out.select(*STUDENT, "target_year", F.col("b.season").alias("base_season"),
                      F.col("b.academic_year").alias("base_year"), F.col("b.score").alias("base_score"))


def normed_growth(pairs: DataFrame, norms: DataFrame) -> DataFrame:
    """Growth, expected growth, whether it was met, and z score."""
    keys = ["subject", "start_grade", "start_season", "end_season"]
    table = norms.withColumnsRenamed({"grade": "start_grade"})
    out = norm_lookup(pairs, table, keys, "start_score")
    growth = F.col("end_score") - F.col("start_score")
    return (out.withColumn("growth", growth)
            .withColumn("met", growth >= F.col("expected_growth"))
            .withColumn("z", (growth - F.col("expected_growth")) / F.col("sd_growth")))


def quartile(c, edges: tuple = (25, 50, 75)) -> Column:
    """Quartile of a percentile; a value on an edge belongs to the upper one."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.when(c.isNull(), None).when(c < edges[0], 1).when(c < edges[1], 2).when(c < edges[2], 3).otherwise(4))


def adhoc_quartile(df: DataFrame, c: str, by: list[str], name: str = "quartile", ties: list[str] | None = None) -> DataFrame:
    """Quartile by rank within the data."""
    return O.ntile(df, name, 4, [c, *(ties or [])], by)


def accelerated_growth(df: DataFrame, factors: DataFrame, band_edge: int = 4) -> DataFrame:
    """Expected growth times a factor for start quartile and grade band; goal and whether it was met.

    ``factors`` has quartile, band (``lower`` below the edge grade, else ``upper``) and factor.
    """
    band = F.when(F.col("start_grade") < band_edge, "lower").otherwise("upper")
    out = O.attach(df.withColumn("band", band), factors, ["quartile", "band"])
    target = F.col("expected_growth") * F.col("factor")
    return (out.withColumn("accelerated_growth", target).withColumn("goal", F.col("start_score") + target)
            .withColumn("met_accelerated", F.col("end_score") >= F.col("start_score") + target))


def student_change(df: DataFrame, window: Window_) -> DataFrame:
    """Start, end and change per student and subject."""
    pairs = growth_pairs(df, [window])
    return pairs.withColumn("change", F.col("end_score") - F.col("start_score"))


def gain_needed(df: DataFrame, norms: DataFrame, target: int) -> DataFrame:
    """Points to the lowest score at or above a target percentile."""
    keys = ["subject", "grade", "season"]
    goal = norms.where(F.col("percentile") >= target).groupBy(*keys).agg(F.min("score").alias("target_score"))
    return O.attach(df, goal, keys).withColumn("gain_needed", F.greatest(F.col("target_score") - F.col("score"), F.lit(0)))


def estimate_score(df: DataFrame, targets: DataFrame, max_days: float, order: list[str] | None = None) -> DataFrame:
    """Score nearest to a target date (student_id, subject, target_ts), within some days."""
    return nearest_join(targets, df.select(*STUDENT, "start_ts", "score"), STUDENT, "target_ts", max_days, "start_ts", order or ["-score"])


def imputation_scaffold(df: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Every student and subject in every term between their first and last."""
    terms = (df if terms is None else terms).select(*TERM).distinct()
    term_no = F.col("academic_year") * 10 + D.season_number("season")
    listed = V.collect_list_bounded(terms.select(F.struct(term_no.alias("t"), *TERM).alias("v")), "v")
    spans = df.groupBy(*STUDENT).agg(F.min(term_no).alias("__a"), F.max(term_no).alias("__b"))
    grid = spans.withColumn("__l", listed).withColumn(
        "__t", F.explode(F.filter("__l", lambda v: v["t"].between(F.col("__a"), F.col("__b")))))
    return grid.select(*STUDENT, F.col("__t.academic_year").alias("academic_year"), F.col("__t.season").alias("season"), F.col("__t.t").alias("term_no"))


def impute_scores(df: DataFrame) -> DataFrame:
    """Scores on the scaffold; a missing one is the mean of the previous and next known score."""
    grid = imputation_scaffold(df)
    keys = [*STUDENT, *TERM]
    full = O.attach(grid, df.select(*keys, "score"), keys)
    both = O.neighbours(full, "score", "__before", "__after", ["term_no"], STUDENT, small_groups=True)  # one row per term
    value = F.coalesce(F.col("score"), (F.col("__before") + F.col("__after")) / 2)
    return both.withColumn("imputed", F.col("score").isNull()).withColumn("score", value).drop("__before", "__after")


# ----------------------------------------------------------------- cohorts

def cohort_percentile(df: DataFrame, school_norms: DataFrame, by: list[str], keys: list[str] | None = None) -> DataFrame:
    """Percentile of the mean score of a group in a table of school means (norms: keys, score, percentile)."""
    keys = keys or ["subject", "grade", "season"]
    means = df.groupBy(*dict.fromkeys([*by, *keys])).agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"))
    return norm_lookup(means, school_norms, keys, "mean_score", "score")


def cohort_growth(pairs: DataFrame, by: list[str]) -> DataFrame:
    keys = ["subject", "start_grade", "start_season", "end_season"]
    return pairs.groupBy(*dict.fromkeys([*by, *keys])).agg(
        F.count(F.lit(1)).alias("n"), F.avg("start_score").alias("start_mean"), F.avg("end_score").alias("end_mean"))


def _with_school_norms(cohorts: DataFrame, school_norms: DataFrame) -> DataFrame:
    table = school_norms.withColumnsRenamed({"grade": "start_grade", "start_mean": "__norm_start"})
    return norm_lookup(cohorts, table, ["subject", "start_grade", "start_season", "end_season"], "start_mean", "__norm_start")


def cohort_growth_percentile(pairs: DataFrame, school_norms: DataFrame, by: list[str]) -> DataFrame:
    """Place of a cohort's mean growth among schools that started alike, from 0 to 100."""
    out = _with_school_norms(cohort_growth(pairs, by), school_norms)
    out = out.withColumn("mean_growth", F.col("end_mean") - F.col("start_mean"))
    z = (F.col("mean_growth") - F.col("expected_growth")) / F.col("sd_growth")
    return out.withColumn("z", z).withColumn("cgp", norm_cdf(F.col("z")) * 100)


def cohort_expectation(pairs: DataFrame, school_norms: DataFrame, by: list[str]) -> DataFrame:
    """End mean a cohort is expected to reach."""
    out = _with_school_norms(cohort_growth(pairs, by), school_norms)
    return out.withColumn("expected_end", F.col("start_mean") + F.col("expected_growth"))


def cohort_targets(pairs: DataFrame, school_norms: DataFrame, by: list[str], cgps: list[float]) -> DataFrame:
    """End mean needed for each growth percentile."""
    out = cohort_expectation(pairs, school_norms, by)
    long = out.withColumn("cgp", F.explode(F.array(*[F.lit(float(c)) for c in cgps])))
    return long.withColumn("target_mean", F.col("start_mean") + F.col("expected_growth") + norm_quantile(F.col("cgp") / 100) * F.col("sd_growth"))


def summarise_scores(df: DataFrame, by: list[str], school_norms: DataFrame | None = None) -> DataFrame:
    """Students, mean and median score, mean percentile."""
    out = df.groupBy(*by).agg(F.count_distinct("student_id").alias("n_students"), F.avg("score").alias("mean_score"),
                              F.avg("percentile").alias("mean_percentile"))
    out = O.attach(out, O.quantiles(df, "score", {"median_score": 0.5}, by), by)
    if school_norms is not None:
        out = norm_lookup(out, school_norms.withColumnRenamed("percentile", "cohort_percentile"), ["subject", "grade", "season"], "mean_score", "score")
    return out


def summarise_growth(df: DataFrame, by: list[str]) -> DataFrame:
    """Students, share that met expected growth, mean and median growth."""
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("met").cast("double")).alias("pct_met"), F.avg("growth").alias("mean_growth"))
    return O.attach(out, O.quantiles(df, "growth", {"median_growth": 0.5}, by), by)


def link_to_state(df: DataFrame, link: DataFrame) -> DataFrame:
    """State level and pass probability by score band (link: subject, grade, season, score_lo, score_hi, level, pass_prob)."""
    keys = ["subject", "grade", "season"]
    table = link.withColumnsRenamed({k: f"__{k}" for k in keys})
    cond = O.null_safe(df, table, keys, [f"__{k}" for k in keys]) & (df["score"] >= table["score_lo"]) & (df["score"] < table["score_hi"])
    return df.join(table, cond, "left").drop(*[f"__{k}" for k in keys])


def subgroup_stats(df: DataFrame, cols: list[str], measures: dict[str, Column]) -> DataFrame:
    """Measures for each value of each subgroup column and for the whole, in one aggregation."""
    sets = [[F.col(c)] for c in cols] + [[]]
    ids = [F.grouping(c).alias(f"__g_{c}") for c in cols]
    out = df.groupingSets(sets, *cols).agg(*[m.alias(n) for n, m in measures.items()], *ids)
    which, value = F, F
    for c in cols:
        here = F.col(f"__g_{c}") == 0
        which, value = which.when(here, F.lit(c)), value.when(here, F.col(c).cast("string"))
    return out.select(which.otherwise("all").alias("subgroup"), value.otherwise(None).alias("level"), *measures)


def permutation_stats(df: DataFrame, group: str, measure: str, id_col: str, n: int = 100, seed: int = 0) -> DataFrame:
    """Difference of each group's mean from the whole, with a p-value from n shuffles of the labels.

    A shuffle puts the rows in the order of an MD5 hash of seed, shuffle number
    and id, and gives the first labels to the first group and so on, so group
    sizes stay as they are. No copy of the table is sorted: rows are counted and
    added up by the first digits of their hash while they are read. Where the next
    group starts inside such a bin, and only there, rows are put in order.
    """
    known = df.where(F.col(group).isNotNull() & F.col(measure).isNotNull()).select(group, F.col(measure).cast("double").alias("__m"), id_col)
    sizes = known.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum("__m").alias("__s")).withColumn("mean", F.col("__s") / F.col("n"))
    bands = O.cumulate(sizes, "n", "sum", "__hi", [group]).select(F.col(group).alias("__g"), (F.col("__hi") - F.col("n") + 1).alias("__lo"), "__hi")
    bands = cut_lineage(bands)  # one row per group
    runs = known.select("__m", id_col, F.explode(F.sequence(F.lit(1), F.lit(n))).alias("__p"))
    runs = runs.withColumn("__h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__p").cast("string"), F.col(id_col).cast("string"))))
    runs = runs.withColumn("__bin", F.substring("__h", 1, 3))  # 4,096 bins a shuffle
    bins = runs.groupBy("__p", "__bin").agg(F.count(F.lit(1)).alias("__n"), F.sum("__m").alias("__s"))
    upto = F.sum("__n").over(Window.partitionBy("__p").orderBy("__bin"))
    bins = bins.withColumn("__to", upto).withColumn("__from", F.col("__to") - F.col("__n") + 1)
    met = cut_lineage(overlap_join(bins, bands, ("__from", "__lo"), ("__to", "__hi")))
    whole = (F.col("__from") >= F.col("__lo")) & (F.col("__to") <= F.col("__hi"))
    inside = met.where(whole).select("__p", "__g", "__n", "__s")
    cut = met.where(~whole).select("__p", "__bin", "__from").distinct()
    place = F.col("__from") - 1 + F.row_number().over(Window.partitionBy("__p", "__bin").orderBy("__h", id_col))
    edge = runs.join(cut, ["__p", "__bin"]).withColumn("__pos", place)
    edge = within_join(edge, bands, "__pos", "__lo", "__hi").groupBy("__p", "__g").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("__m").alias("__s"))
    means = inside.unionByName(edge).groupBy("__p", F.col("__g").alias(group)).agg((F.sum("__s") / F.sum("__n")).alias("__pm"))
    seen = O.recycle(sizes, None, __whole=F.sum("__s") / F.sum("n")).withColumn("diff", F.col("mean") - F.col("__whole"))
    joined = means.join(seen.select(group, "diff", "__whole"), group)
    p = joined.groupBy(group).agg(((F.count_if(F.abs(F.col("__pm") - F.col("__whole")) >= F.abs("diff")) + 1) / (n + 1)).alias("p_value"))
    return O.attach(seen.drop("__s", "__whole"), p, [group])


def summary_1d(df: DataFrame, by: list[str], above: int = 50) -> DataFrame:
    """Students, mean score and percentile, share above a percentile."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"), F.avg("percentile").alias("mean_percentile"),
        F.avg((F.col("percentile") >= above).cast("double")).alias("share_above"))


def band_lists(df: DataFrame, by: list[str], bands: Column | None = None, ties: list[str] | None = None) -> DataFrame:
    """Students listed by band, with their place in the list: one row each, so no list cell can outgrow a row."""
    band = quartile("percentile") if bands is None else bands
    return O.row_number(df.withColumn("band", band), "place", ["-score", "student_id", *(ties or [])], [*by, "band"])


def report_table(df: DataFrame, spec: dict[str, Column], by: list[str]) -> DataFrame:
    """The table under a report, for each value of each grouping column, in one job."""
    return subgroup_stats(df, by, spec)


def summary_long(df: DataFrame, by: list[str], measures: dict[str, Column]) -> DataFrame:
    """Group summary as one row per measure."""
    out = df.groupBy(*by).agg(*[m.cast("double").alias(n) for n, m in measures.items()])
    return out.unpivot(by, list(measures), "measure", "value")


def goals_table(df: DataFrame, norms: DataFrame, factors: DataFrame, end_season: str = "Spring") -> DataFrame:
    """Goal per student from a start score: expected and accelerated growth to the end season."""
    start = df.select(*STUDENT, F.col("season").alias("start_season"), F.col("grade").alias("start_grade"), "academic_year",
                      F.col("score").alias("start_score"), F.lit(end_season).alias("end_season"), F.lit(None).cast("double").alias("end_score"),
                      quartile("percentile").alias("quartile"))
    out = norm_lookup(start, norms.withColumnsRenamed({"grade": "start_grade"}), ["subject", "start_grade", "start_season", "end_season"], "start_score")
    return accelerated_growth(out.where(F.col("expected_growth").isNotNull()), factors).withColumn(
        "typical_goal", F.col("start_score") + F.col("expected_growth"))


def term_percentile(df: DataFrame, probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Score percentiles per term."""
    return O.quantiles(df, "score", probs, by or ["subject", *TERM])


# -------------------------------------------------------------- chart data

def histogram(df: DataFrame, c: str, width: float, by: list[str] | None = None) -> DataFrame:
    bin_ = (F.floor(F.col(c) / width) * width).cast("double")
    return df.where(F.col(c).isNotNull()).groupBy(*(by or []), bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def share_by_class(df: DataFrame, cls: Column, by: list[str], name: str = "class") -> DataFrame:
    """Share of the rows of each group that fall in each class."""
    counts = df.groupBy(*by, cls.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return O.recycle(counts, by, __t=F.sum("n")).withColumn("share", F.col("n") / F.col("__t")).drop("__t")


def student_points(df: DataFrame, window: Window_, by: list[str] | None = None) -> DataFrame:
    """Start and end per student with the place in the sorted chart."""
    change = student_change(df, window)
    return O.row_number(change, "place", ["start_score", "change", "student_id", "start_year"], by or ["subject"])


def cohort_trace(df: DataFrame, cohort: list[str], school_norms: DataFrame | None = None) -> DataFrame:
    """Mean score of each cohort per term, with its percentile when norms are given."""
    if school_norms is not None:
        return cohort_percentile(df, school_norms, [*cohort, *TERM])
    return df.groupBy(*cohort, *TERM).agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"))


def strand_stats(df: DataFrame, strands: list[str], by: list[str]) -> DataFrame:
    """Box statistics of each goal strand column."""
    long = df.select(*by, *[F.col(s).cast("double").alias(s) for s in strands]).unpivot(by, strands, "strand", "strand_score")
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    ends = long.groupBy(*by, "strand").agg(F.count("strand_score").alias("n"), F.min("strand_score").alias("low"), F.max("strand_score").alias("high"))
    return O.attach(ends, O.quantiles(long, "strand_score", probs, [*by, "strand"]), [*by, "strand"])


def student_goal_rows(df: DataFrame, link: DataFrame, norms: DataFrame, factors: DataFrame) -> DataFrame:
    """One row per student: one-year goal and the linked scale at the goal (link: subject, score, linked)."""
    goals = goals_table(df, norms, factors)
    return norm_lookup(goals, link, ["subject"], "goal", "score")
