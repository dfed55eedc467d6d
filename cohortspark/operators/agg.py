"""Grouping and aggregation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions import na
from cohortspark.operators import ordered as O
from cohortspark.operators.verbs import _where_fields, first_rows, reverse_order


@dataclass(frozen=True)
class Grouped:
    """A table with its grouping columns."""
    df: DataFrame
    keys: tuple[str, ...]

    def ungroup(self) -> DataFrame:
        return self.df

    def group_size(self) -> DataFrame:
        return count(self.df, *self.keys)

    def n_groups(self) -> DataFrame:
        return self.df.select(*self.keys).distinct().agg(F.count(F.lit(1)).alias("n_groups"))

    def summarise(self, **aggs: Column) -> "Grouped":
        """One row per group; the last grouping level is dropped."""
        return Grouped(summarise(self.df, list(self.keys), **aggs), self.keys[:-1])

    def mutate(self, **aggs: Column) -> "Grouped":
        return Grouped(O.recycle(self.df, list(self.keys), **aggs), self.keys)


def group_by(df: DataFrame, *keys: str, **exprs: Column) -> Grouped:
    """Group by columns and by named expressions."""
    for name, e in exprs.items():
        df = df.withColumn(name, e)
    return Grouped(df, (*keys, *exprs))


def group_by_if(df: DataFrame, which) -> Grouped:
    return Grouped(df, tuple(_where_fields(df, which)))


def summarise(df: DataFrame, by: list[str] | None = None, **aggs: Column) -> DataFrame:
    return df.groupBy(*(by or [])).agg(*[a.alias(n) for n, a in aggs.items()])


def summarise_at(df: DataFrame, by: list[str], which, **fns: Callable[[str], Column]) -> DataFrame:
    """Several functions over chosen columns, named ``column_function``."""
    names = [n for n in _where_fields(df, which) if n not in by]
    return df.groupBy(*by).agg(*[f(n).alias(f"{n}_{s}") for n in names for s, f in fns.items()])


def count(df: DataFrame, *keys: str, wt: str | None = None, sort: bool = False, name: str = "n") -> DataFrame:
    n = F.count(F.lit(1)) if wt is None else F.coalesce(F.sum(wt), F.lit(0))
    out = df.groupBy(*keys).agg(n.alias(name))
    return out.orderBy(F.desc(name), *keys) if sort else out


tally = count


def add_count(df: DataFrame, *keys: str, wt: str | None = None, name: str = "n") -> DataFrame:
    return O.recycle(df, list(keys), **{name: F.count(F.lit(1)) if wt is None else F.coalesce(F.sum(wt), F.lit(0))})


def nth(df: DataFrame, c: str, n: int, order: list[str], by: list[str] | None = None, name: str = "nth", default=None) -> DataFrame:
    """Value at a position per group, from the end for negative n; ``default`` where the group is shorter."""
    order = order if n > 0 else reverse_order(order)
    picked = first_rows(df, abs(n), order, by, "__pos").where(F.col("__pos") == abs(n))
    picked = picked.select(*(by or []), F.col(c).alias(name))
    if not by:
        return picked
    groups = df.select(*by).distinct()
    marked = O.attach(groups, picked.withColumn("__hit", F.lit(True)), by)
    return marked.withColumn(name, F.when(F.col("__hit"), F.col(name)).otherwise(F.lit(default))).drop("__hit")


def first(df, c, order, by=None, name="first", default=None):
    return nth(df, c, 1, order, by, name, default)


def last(df, c, order, by=None, name="last", default=None):
    return nth(df, c, -1, order, by, name, default)


def most_frequent(df: DataFrame, c: str, by: list[str] | None = None, n: int = 1) -> DataFrame:
    """The n most frequent values per group with their share; ties by value."""
    by = list(by or [])
    counts = df.groupBy(*by, c).agg(F.count(F.lit(1)).alias("n"))
    shares = O.recycle(counts, by, __t=F.sum("n")).withColumn("share", F.col("n") / F.col("__t")).drop("__t")
    return first_rows(shares, n, ["-n", c], by)


def get_dupes(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key occurs more than once, with the number of rows.

    Keys are counted first; only repeated keys take part in the join.
    """
    keys = keys or tuple(df.columns)
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dupe_count")).where(F.col("dupe_count") > 1)
    return O.attach(df, repeated, list(keys), "inner")


def all_equal(x: DataFrame, y: DataFrame) -> DataFrame:
    """One row: equal or not, and the first reason why not. Row order does not matter."""
    spark = x.sparkSession
    reason = None
    if set(x.columns) != set(y.columns):
        reason = "columns differ"
    else:
        types = dict(y.dtypes)
        wrong = sorted(c for c, t in x.dtypes if types[c] != t)
        if wrong:
            reason = "types differ: " + ", ".join(wrong)
    if reason:
        return spark.createDataFrame([(False, reason)], "equal boolean, reason string")
    # one count per distinct row on each side instead of two set differences
    y = y.select(*x.columns)
    both = (x.withColumn("__s", F.lit(1)).unionByName(y.withColumn("__s", F.lit(-1)))
            .groupBy(*x.columns).agg(F.sum("__s").alias("__d")).where("__d <> 0"))
    tally_ = both.agg(F.count(F.lit(1)).alias("n"), F.sum(F.greatest("__d", F.lit(0))).alias("extra"),
                      F.sum(F.greatest(-F.col("__d"), F.lit(0))).alias("missing"))
    return tally_.select((F.col("n") == 0).alias("equal"), F.when(F.col("n") > 0, F.format_string(
        "%d rows only in x, %d rows only in y", "extra", "missing")).alias("reason"))


def weighted_mean(x: str, w: str) -> Column:
    known = F.col(x).isNotNull() & F.col(w).isNotNull()
    return F.sum(F.when(known, F.col(x) * F.col(w))) / F.sum(F.when(known, F.col(w)))


def weighted_var(df: DataFrame, x: str, w: str, by: list[str] | None = None, name: str = "variance") -> DataFrame:
    """Second weighted moment about the weighted mean, of the rows where value and weight are known.

    Values are centred before they are squared, so a mean far from zero does not
    cancel the digits. Groups without a known row get NA.
    """
    by = list(by or [])
    mean = df.groupBy(*by).agg(weighted_mean(x, w).alias("__mean"))
    centred = O.attach(df, mean, by) if by else df.withColumn("__mean", mean.scalar())
    off = F.col(x) - F.col("__mean")
    known = F.col(x).isNotNull() & F.col(w).isNotNull()
    return centred.groupBy(*by).agg((F.sum(F.when(known, off * off * F.col(w))) / F.sum(F.when(known, F.col(w)))).alias(name))


def weighted_quantile(df: DataFrame, x: str, w: str, p: float, by: list[str] | None = None, name: str = "quantile") -> DataFrame:
    """Smallest x at which the running share of the weight reaches p."""
    by = list(by or [])
    sums = df.where(F.col(x).isNotNull()).groupBy(*by, x).agg(F.sum(w).alias("__w"))
    run = O.cumulate(sums, "__w", "sum", "__upto", [x], by)
    run = O.attach(run, sums.groupBy(*by).agg(F.sum("__w").alias("__t")), by) if by else run.withColumn(
        "__t", sums.agg(F.sum("__w")).scalar())
    return run.where(F.col("__upto") >= F.col("__t") * p).groupBy(*by).agg(F.min(x).alias(name))


def weighted_shape(df: DataFrame, x: str, w: str, by: list[str] | None = None) -> DataFrame:
    """Weighted mean, variance, skewness and excess kurtosis of the rows where value and weight are known, about the weighted mean."""
    by = list(by or [])
    known = df.where(F.col(x).isNotNull() & F.col(w).isNotNull())
    centred = O.recycle(known, by, __mean=weighted_mean(x, w))
    off, total = F.col(x) - F.col("__mean"), F.sum(w)
    power = lambda n: F.sum(F.pow(off, F.lit(n)) * F.col(w)) / total
    table = centred.groupBy(*by).agg(F.max("__mean").alias("mean"), power(2).alias("variance"), power(3).alias("__m3"), power(4).alias("__m4"))
    spread = F.col("variance") > 0
    return table.select(*by, "mean", "variance", F.when(spread, F.col("__m3") / F.pow("variance", F.lit(1.5))).alias("skewness"),
                        F.when(spread, F.col("__m4") / (F.col("variance") * F.col("variance")) - 3).alias("kurtosis"))


def weighted_tail_mean(df: DataFrame, x: str, w: str, p: float, by: list[str] | None = None, name: str = "tail_mean") -> DataFrame:
    """Weighted mean of the values at or above the weighted p quantile."""
    by = list(by or [])
    cut = weighted_quantile(df, x, w, p, by, "__q")
    marked = O.attach(df, cut, by) if by else df.withColumn("__q", cut.scalar())
    return marked.where(F.col(x) >= F.col("__q")).groupBy(*by).agg(weighted_mean(x, w).alias(name))


def describe_ext(df: DataFrame, c: str, by: list[str] | None = None) -> DataFrame:
    """Count, moments and error of the mean in one pass of mergeable states."""
    x = F.col(c)
    return df.groupBy(*(by or [])).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_samp(x).alias("variance"),
        (F.stddev_samp(x) / F.sqrt(F.count(x))).alias("error_of_mean"),
        F.skewness(x).alias("skewness"), F.kurtosis(x).alias("kurtosis"),
        F.min(x).alias("min"), F.max(x).alias("max"))


def covariance(x: str, y: str) -> Column:
    return F.covar_samp(x, y)


def density(df: DataFrame, c: str, width: float, by: list[str] | None = None) -> DataFrame:
    """Share of rows per bin divided by the bin width."""
    by = list(by or [])
    bins = df.where(F.col(c).isNotNull()).groupBy(*by, (F.floor(F.col(c) / width) * width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return O.recycle(bins, by, __t=F.sum("n")).withColumn("density", F.col("n") / F.col("__t") / width).drop("__t")


def tail_mean(df: DataFrame, c: str, p: float, by: list[str] | None = None, name: str = "tail_mean") -> DataFrame:
    """Mean of the values at or above the p quantile."""
    by = list(by or [])
    cut = O.quantiles(df, c, {"__q": p}, by)
    marked = O.attach(df, cut, by) if by else df.withColumn("__q", cut.scalar())
    return marked.where(F.col(c) >= F.col("__q")).groupBy(*by).agg(F.avg(c).alias(name))


def peaks_over(df: DataFrame, c: str, threshold: float, by: list[str] | None = None) -> DataFrame:
    """Number and mean excess of the values above a threshold."""
    over = F.when(F.col(c) > threshold, F.col(c) - threshold)
    return df.groupBy(*(by or [])).agg(F.count(over).alias("n_peaks"), F.avg(over).alias("mean_excess"))


# Aggregates by name, so that a configuration can choose one.
AGGREGATES: dict[str, Callable[..., Column]] = {
    "n": lambda *_: F.count(F.lit(1)),
    "sum": na.r_sum, "mean": na.r_mean, "var": na.r_var, "sd": na.r_sd, "min": na.r_min, "max": na.r_max,
    "n_distinct": na.n_distinct, "any": na.r_any, "all": na.r_all,
    "median": lambda c, **_: F.median(c),
}


def register_agg(name: str, fn: Callable[..., Column]) -> None:
    AGGREGATES[name] = fn


def named_agg(name: str, *cols: str, **options) -> Column:
    return AGGREGATES[name](*cols, **options)
