"""Streaming statistics as states that can be stored and merged.

A state is one row per group. States of chunks of a table, merged, are the state of
the whole table: counts, extremes and sums exactly, moments up to rounding,
quantiles within the same rank error.

- Sums are kept without rounding: a value is cut into digits of DIGIT bits at fixed
  places, and the digits of a place are added as whole numbers. Their order and
  the chunks do not matter, and nothing cancels; only the last step rounds.
- Moments are counts, means and sums of powers about the mean, merged by the shift
  of the means.
- Quantiles are KLL sketches (built into Spark): ``rank_error`` states how far the
  rank of a returned quantile may be off, with 99 % confidence.

Missing values are left out; NaN and infinite values count in ``n_not_finite`` only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.operators import ordered as O

DIGIT = 20
_LOWEST = -50  # place of the lowest digit; what lies below 2 ** -1000 is left out
_DIGITS = 4  # 61 bits at least, a double has 53


def rank_error(k: int) -> float:
    """Largest difference between the asked and the true rank, as a share of the rows (published for KLL sketches, 99 %)."""
    return 2.296 / k ** 0.9021


def _digits(df: DataFrame, x: str) -> DataFrame:
    """__top, __d0, __d1, ... of the finite values but 0 of a column: the value is the sum of d_n * 2 ** (DIGIT * (top - n))."""
    size = F.floor(F.log2(F.abs(x)) / DIGIT).cast("int")
    df = df.withColumn("__top", F.greatest(size, F.lit(_LOWEST + _DIGITS - 1)))
    df = df.withColumns({"__scale": F.pow(F.lit(2.0), F.col("__top") * DIGIT), "__rest": F.col(x)})
    for n in range(_DIGITS):
        unit = F.col("__scale") * 2.0 ** (-DIGIT * n)  # powers of two: no rounding
        df = df.withColumn(f"__d{n}", (F.col("__rest") / unit).cast("bigint"))
        df = df.withColumn("__rest", F.col("__rest") - F.col(f"__d{n}") * unit)
    return df.drop("__scale", "__rest")


def _total(digits: Column) -> Column:
    """Sum of (place, total) rows with the rounding errors of the additions carried along."""
    def add(acc: Column, v: Column) -> Column:
        s = acc["s"] + v
        lost = F.when(F.abs(acc["s"]) >= F.abs(v), (acc["s"] - s) + v).otherwise((v - s) + acc["s"])
        return F.struct(s.alias("s"), (acc["c"] + lost).alias("c"))

    half = F.lit(1 << 32)
    # a total of more than 53 bits is no double: two parts of 32 bits are
    parts = F.flatten(F.transform(F.reverse(F.sort_array(digits)), lambda d: F.array(*[
        part.cast("double") * F.pow(F.lit(2.0), d["place"] * DIGIT) for part in (d["total"] - d["total"] % half, d["total"] % half)])))
    return F.reduce(parts, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c")), add, lambda acc: acc["s"] + acc["c"])


def _attach(x: DataFrame, y: DataFrame, by: list[str]) -> DataFrame:
    if by:
        return O.attach(x, y, by)
    one = y.select(F.struct("*").alias("s")).scalar()  # without groups there is one row
    return x.withColumn("__s", one).select("*", *[F.col("__s")[c].alias(c) for c in y.columns]).drop("__s")


def exact_digits(df: DataFrame, c: str, by: list[str]) -> DataFrame:
    """by, digits: the sum of a column without rounding, as (place, total)."""
    x = F.col(c).cast("double")
    # a column per digit: a value stays one row, and few rows per group are left to be dealt out by place
    each = _digits(df.where((x != 0) & (F.abs(x) < float("inf"))).select(*by, x.alias("__x")), "__x")
    names = [f"__d{n}" for n in range(_DIGITS)]
    tops = each.groupBy(*by, "__top").agg(*[F.sum(d).alias(d) for d in names], *[F.bool_or(F.col(d) != 0).alias(f"{d}_some") for d in names])
    parts = F.array(*[F.struct((F.col("__top") - n).alias("place"), F.col(d).alias("total"), F.col(f"{d}_some").alias("some")) for n, d in enumerate(names)])
    places = tops.select(*by, F.explode(parts).alias("__d")).where("__d.some")
    totals = places.groupBy(*by, F.col("__d.place").alias("place")).agg(F.sum("__d.total").alias("total"))
    # some 100 places at most
    return totals.groupBy(*by).agg(F.collect_list(F.struct("place", "total")).alias("digits"))


def state(df: DataFrame, c: str, by: list[str] | None = None, k: int = 200) -> DataFrame:
    """by, n, n_not_finite, mean, m2, m3, m4, min, max, sketch, digits: the state of each group."""
    by = list(by or [])
    x = F.col(c).cast("double")
    fine = F.when(F.abs(x) < float("inf"), x)  # NaN is above infinity here
    n = F.count(fine)
    m2 = F.var_pop(fine) * n
    rows = df.groupBy(*by).agg(
        n.alias("n"), (F.count(x) - n).alias("n_not_finite"), F.avg(fine).alias("mean"), m2.alias("m2"),
        F.coalesce(F.skewness(fine) * F.sqrt(m2 * m2 * m2 / n), F.when(n > 0, 0.0)).alias("m3"),
        F.coalesce((F.kurtosis(fine) + 3) * m2 * m2 / n, F.when(n > 0, 0.0)).alias("m4"),
        F.min(fine).alias("min"), F.max(fine).alias("max"), F.kll_sketch_agg_double(fine, k).alias("sketch"))
    rows = rows.withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))
    return _attach(rows, exact_digits(df, c, by), by)


def merge(states: list[DataFrame], by: list[str] | None = None) -> DataFrame:
    """The state of all rows behind some states."""
    by = list(by or [])
    all_ = reduce(lambda a, b: a.unionByName(b), states)
    weight = F.sum("n")
    mean = all_.groupBy(*by).agg((F.sum(F.col("n") * F.col("mean")) / F.nullif(weight, F.lit(0))).alias("__mean"))
    shifted = _attach(all_, mean, by).where("n > 0")
    d, n, m2, m3 = F.col("mean") - F.col("__mean"), F.col("n"), F.col("m2"), F.col("m3")
    moments = shifted.groupBy(*by).agg(
        F.sum(m2 + n * d * d).alias("m2"), F.sum(m3 + 3 * d * m2 + n * d * d * d).alias("m3"),
        F.sum(F.col("m4") + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d).alias("m4"))
    rows = all_.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("n_not_finite").alias("n_not_finite"), F.min("min").alias("min"), F.max("max").alias("max"),
                                 F.kll_merge_agg_double("sketch").alias("sketch"))
    totals = all_.select(*by, F.explode("digits").alias("d")).groupBy(*by, F.col("d.place").alias("place")).agg(F.sum("d.total").alias("total"))
    digits = totals.groupBy(*by).agg(F.collect_list(F.struct("place", "total")).alias("digits"))
    out = rows
    for part in (mean.withColumnRenamed("__mean", "mean"), moments, digits):
        out = _attach(out, part, by)
    names = [*by, "n", "n_not_finite", "mean", "m2", "m3", "m4", "min", "max", "sketch", "digits"]
    return out.withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch"))).select(*names)


def describe(states: DataFrame, by: list[str] | None = None, probs: dict[str, float] | None = None, k: int = 200) -> DataFrame:
    """Count, compensated sum and mean, moments, extremes and quantiles from states; groups without a value get NA."""
    n, m2 = F.col("n"), F.col("m2")
    some = lambda c: F.when(n > 0, c)
    total = some(F.coalesce(_total(F.col("digits")), F.lit(0.0)))
    variance = F.when(n > 1, m2 / (n - 1))
    quantiles = [some(F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(name) for name, p in (probs or {}).items()]
    return states.select(
        *(by or []), "n", "n_not_finite", total.alias("sum"), (total / F.nullif(n, F.lit(0))).alias("mean"), variance.alias("variance"),
        (F.sqrt(variance) / F.sqrt(n)).alias("error_of_mean"),
        F.when(m2 > 0, F.col("m3") / n / F.pow(m2 / n, 1.5)).alias("skewness"), F.when(m2 > 0, F.col("m4") * n / (m2 * m2) - 3).alias("kurtosis"),
        "min", "max", *quantiles, *([F.lit(rank_error(k)).alias("rank_error")] if probs else []))
