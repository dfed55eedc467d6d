"""Rounding, ranges, scales, bins, distributions and random columns."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.na import bind, col
from cohortspark.operators import ordered as O


def r_round(c, digits: int = 0) -> Column:
    """Half to even on the decimal value."""
    return F.bround(col(c), digits)


def round_half_up(c, digits: int = 0) -> Column:
    return F.round(col(c), digits)


def signif(c, digits: int = 6) -> Column:
    c = col(c).cast("double")
    power = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs(c))))
    return F.when(c == 0, F.lit(0.0)).otherwise(F.rint(c * power) / power)


def trunc(c) -> Column:
    c = col(c)
    return F.when(c < 0, F.ceil(c)).otherwise(F.floor(c))


def round_any(c, accuracy: float, how: str = "round") -> Column:
    q = col(c) / accuracy
    return {"round": F.bround, "half_up": F.round, "floor": F.floor, "ceiling": F.ceil}[how](q) * accuracy


def clamp(c, lo, hi) -> Column:
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


squish = clamp


def censor(c, lo, hi) -> Column:
    c = col(c)
    return F.when(c.between(lo, hi), c)


def discard(df: DataFrame, c: str, lo, hi) -> DataFrame:
    return df.where(F.col(c).between(lo, hi))


def rescale(df: DataFrame, c: str, name: str, to: tuple = (0.0, 1.0), by: list[str] | None = None) -> DataFrame:
    """Linear map of the range of the group to ``to``; the middle of ``to`` when the range is zero."""
    x = F.col(c)
    out = O.recycle(df, by, __lo=F.min(x), __hi=F.max(x))
    lo, hi = F.col("__lo"), F.col("__hi")
    value = F.when(x.isNull(), None).when(hi == lo, F.lit(sum(to) / 2)).otherwise(F.lit(to[0]) + (x - lo) / (hi - lo) * (to[1] - to[0]))
    return out.withColumn(name, value).drop("__lo", "__hi")


def rescale_mid(df: DataFrame, c: str, name: str, mid: float = 0.0, to: tuple = (0.0, 1.0), by: list[str] | None = None) -> DataFrame:
    """Map so that ``mid`` goes to the middle of ``to`` and the farther end to its edge."""
    x = F.col(c)
    out = O.recycle(df, by, __reach=F.max(F.abs(x - mid)))
    half = (to[1] - to[0]) / 2
    value = F.when(F.col("__reach") == 0, F.lit(sum(to) / 2)).otherwise((x - mid) / F.col("__reach") * half + sum(to) / 2)
    return out.withColumn(name, value).drop("__reach")


def rescale_max(df: DataFrame, c: str, name: str, to: tuple = (0.0, 1.0), by: list[str] | None = None) -> DataFrame:
    out = O.recycle(df, by, __hi=F.max(F.col(c)))
    return out.withColumn(name, F.col(c) / F.col("__hi") * to[1]).drop("__hi")


def zero_range(lo, hi, tol: float = 1e-12) -> Column:
    lo, hi = col(lo), col(hi)
    return (lo == hi) | (F.abs(hi - lo) < tol * F.least(F.abs(lo), F.abs(hi)))


def _probit(p: Column) -> Column:
    return norm_quantile(p)


def _float_log(fn, pole: float = 0.0):
    """A logarithm that is -Inf at its pole and NaN below it, where Spark's gives NA."""
    return lambda c: F.when(c < pole, float("nan")).when(c == pole, float("-inf")).otherwise(fn(c))


_log = _float_log(F.log)


def _reciprocal(c: Column) -> Column:
    """1 / c, infinite at 0, where Spark's division is an error."""
    c = c.cast("double")
    return F.when(c == 0, F.pow(c, F.lit(-1.0))).otherwise(F.try_divide(F.lit(1.0), c))


def _logit(c: Column) -> Column:
    return F.when(c == 1, float("inf")).otherwise(_log(F.try_divide(c, 1 - c)))


# Forward and inverse of each scale; outside its range a scale gives Inf or NaN, as floating-point numbers do.
_SCALES = {
    "identity": (lambda c: c, lambda c: c),
    "log": (_log, F.exp),
    "log2": (_float_log(F.log2), lambda c: F.pow(F.lit(2.0), c)),
    "log10": (_float_log(F.log10), lambda c: F.pow(F.lit(10.0), c)),
    "log1p": (_float_log(F.log1p, -1.0), F.expm1),
    "exp": (F.exp, _log),
    "sqrt": (F.sqrt, lambda c: c * c),
    "asn": (lambda c: 2 * F.asin(F.sqrt(c)), lambda c: F.pow(F.sin(c / 2), 2)),
    "atanh": (F.atanh, F.tanh),
    "reciprocal": (_reciprocal, _reciprocal),
    "reverse": (lambda c: -c, lambda c: -c),
    "logit": (_logit, lambda c: 1 / (1 + F.exp(-c))),
    "probit": (lambda c: norm_quantile(c), lambda c: norm_cdf(c)),
}


def transform_scale(c, name: str, inverse: bool = False) -> Column:
    return _SCALES[name][1 if inverse else 0](col(c))


def boxcox(c, p: float) -> Column:
    c = col(c)
    return _log(c) if p == 0 else (F.pow(c, p) - 1) / p


def bin(c, breaks: list[float], right: bool = False) -> Column:
    """1-based bin between neighbouring breaks; NA outside. The outer edge is included."""
    c = col(c)
    out = F
    last = len(breaks) - 1
    for i in range(last):
        lo, hi = breaks[i], breaks[i + 1]
        inside = ((c > lo) & (c <= hi)) if right else ((c >= lo) & (c < hi))
        if right and i == 0:
            inside = inside | (c == lo)
        if not right and i == last - 1:
            inside = inside | (c == hi)
        out = out.when(inside, i + 1)
    return out.otherwise(None)


def breaks_width(lo: float, hi: float, width: float) -> list[float]:
    first = math.floor(lo / width) * width
    return [first + i * width for i in range(math.ceil((hi - first) / width) + 1)]


def quantile_bin(df: DataFrame, c: str, n: int, name: str) -> DataFrame:
    """Bin 1..n between exact quantiles of the column."""
    cuts = O.quantiles(df, c, {f"q{i}": i / n for i in range(1, n)}).first()
    out = F.when(F.col(c).isNull(), None)
    for i in range(1, n):
        out = out.when(F.col(c) < cuts[f"q{i}"], i)
    return df.withColumn(name, out.otherwise(n))


def norm_cdf(c, mean: float = 0.0, sd: float = 1.0) -> Column:
    """Normal distribution function: power series near the middle, continued fraction in the tails."""
    steps = F.sequence(F.lit(1), F.lit(80))

    def grow(a):
        def step(s, k):
            return bind(s["term"] * a * a / (2 * k + 1), lambda term: F.struct(term.alias("term"), (s["total"] + term).alias("total")))
        return step

    def value(z):
        a = F.abs(z)
        phi = F.exp(-a * a / 2) / math.sqrt(2 * math.pi)
        middle = 0.5 - phi * F.aggregate(steps, F.struct(a.alias("term"), a.alias("total")), grow(a), lambda s: s["total"])
        tail = phi / F.aggregate(F.reverse(steps), a, lambda x, k: a + k / x)
        upper = F.when(a < 4, middle).otherwise(tail)
        return F.when(F.isnan(z), z).otherwise(bind(upper, lambda u: F.when(z < 0, u).otherwise(1 - u)))

    return bind((col(c).cast("double") - mean) / sd, value)


def norm_density(c, mean: float = 0.0, sd: float = 1.0) -> Column:
    z = (col(c) - mean) / sd
    return F.exp(-z * z / 2) / (sd * math.sqrt(2 * math.pi))


# Coefficients of algorithm AS 241 for normal quantiles, numerators and denominators, highest power first.
_MIDDLE = ([2.5090809287301226727e+3, 3.3430575583588128105e+4, 6.7265770927008700853e+4, 4.5921953931549871457e+4, 1.3731693765509461125e+4,
            1.9715909503065514427e+3, 1.3314166789178437745e+2, 3.3871328727963666080e+0],
           [5.2264952788528545610e+3, 2.8729085735721942674e+4, 3.9307895800092710610e+4, 2.1213794301586595867e+4, 5.3941960214247511077e+3,
            6.8718700749205790830e+2, 4.2313330701600911252e+1, 1.0])
_NEAR = ([7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e+0, 3.64784832476320460504e+0,
          5.76949722146069140550e+0, 4.63033784615654529590e+0, 1.42343711074968357734e+0],
         [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1, 6.89767334985100004550e-1,
          1.67638483018380384940e+0, 2.05319162663775882187e+0, 1.0])
_FAR = ([2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2, 2.96560571828504891230e-1,
         1.78482653991729133580e+0, 5.46378491116411436990e+0, 6.65790464350110377720e+0],
        [2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4, 1.48753612908506148525e-2,
         1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0])


def _ratio(x: Column, parts: tuple[list[float], list[float]]) -> Column:
    top, bottom = (reduce(lambda acc, k: acc * x + k, p[1:], F.lit(p[0])) for p in parts)
    return top / bottom


def norm_quantile(c, mean: float = 0.0, sd: float = 1.0) -> Column:
    """Inverse of ``norm_cdf``; infinite at 0 and 1, NaN outside."""
    def tail(p):
        return bind(F.sqrt(-F.log(F.least(p, 1 - p))), lambda r: F.signum(p - 0.5) * F.when(r <= 5, bind(r - 1.6, lambda x: _ratio(x, _NEAR))).otherwise(
            bind(r - 5, lambda x: _ratio(x, _FAR))))

    def value(p):
        middle = (p - 0.5) * bind(0.180625 - (p - 0.5) * (p - 0.5), lambda x: _ratio(x, _MIDDLE))
        z = F.when(F.abs(p - 0.5) <= 0.425, middle).otherwise(tail(p))
        return F.when(p.isNull(), None).when((p > 0) & (p < 1), z).when(p == 0, float("-inf")).when(p == 1, float("inf")).otherwise(float("nan"))

    return bind(col(c).cast("double"), value) * sd + mean


def exp_cdf(c, rate: float = 1.0) -> Column:
    c = col(c)
    return F.when(c < 0, 0.0).otherwise(-F.expm1(-c * rate))


def unif_cdf(c, lo: float = 0.0, hi: float = 1.0) -> Column:
    return clamp((col(c) - lo) / (hi - lo), 0.0, 1.0)


def binom_density(k, n: int, p: float) -> Column:
    k = col(k)
    return F.exp(lchoose(F.lit(float(n)), k) + k * math.log(p) + (n - k) * math.log1p(-p))


def pois_density(k, rate: float) -> Column:
    k = col(k)
    return F.exp(k * math.log(rate) - rate - lgamma(k + 1))


def _fraction(first: np.ndarray, step) -> np.ndarray:
    """Continued fraction first + a1 / (b1 + a2 / (b2 + ...)) until it settles; ``step(n)`` gives a and b. Terms near zero are lifted."""
    tiny = 1e-300
    value = np.where(first == 0, tiny, first)
    up, down, n = value, np.zeros_like(value), 0
    while True:
        n += 1
        a, b = step(n)
        down = b + a * down
        down = 1 / np.where(np.abs(down) < tiny, tiny, down)
        up = b + a / up
        up = np.where(np.abs(up) < tiny, tiny, up)
        value = value * up * down
        if not (np.abs(up * down - 1) > 1e-15).any():
            return value


def _incomplete_gamma(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Lower regularised incomplete gamma: power series below a + 1, continued fraction above, both until they settle."""
    x = np.maximum(x, 0.0)
    out = np.where(np.isinf(x), 1.0, 0.0)
    scale = lambda a, x: np.exp(-x + a * np.log(x) - _LGAMMA(a))
    low = (x > 0) & (x < a + 1)
    if low.any():
        p, z = a[low], x[low]
        term = total = 1.0 / p
        n = 0
        while (term > total * 1e-17).any():
            n += 1
            term = term * z / (p + n)
            total = total + term
        out[low] = scale(p, z) * total
    high = (x >= a + 1) & ~np.isinf(x)
    if high.any():
        p, z = a[high], x[high]
        out[high] = 1.0 - scale(p, z) / _fraction(z + 1 - p, lambda n: (-n * (n - p), z + 2 * n + 1 - p))
    return out


def _incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta by its continued fraction, on the side where it settles fast."""
    x = np.clip(x, 0.0, 1.0)
    turn = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(turn, b, a), np.where(turn, a, b), np.where(turn, 1 - x, x)
    value = np.zeros_like(z)
    in_ = (z > 0) & (z < 1)
    if in_.any():
        p, q, y = p[in_], q[in_], z[in_]

        def step(n):
            m = n // 2
            if n % 2:
                return -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1)), np.ones_like(y)
            return m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), np.ones_like(y)

        front = np.exp(_LGAMMA(p + q) - _LGAMMA(p) - _LGAMMA(q) + p * np.log(y) + q * np.log1p(-y)) / p
        value[in_] = front / _fraction(np.ones_like(y), step)
    return np.where(turn, 1 - value, value)


_LGAMMA = np.vectorize(math.lgamma, otypes=["float64"])


def _distribution(fn):
    """Column of a numpy function; missing stays missing."""
    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        x = s.to_numpy(dtype="float64", na_value=np.nan)
        known = ~np.isnan(x)
        out = np.full(len(x), np.nan)
        if known.any():
            out[known] = fn(x[known])
        return pd.Series(out).astype("Float64").where(known)
    return run


def _cdf(family: str, *par: float):
    """Distribution function of a family over a numpy array."""
    full = lambda x, v: np.full(len(x), float(v))
    if family == "chisq":
        return lambda x: _incomplete_gamma(full(x, par[0] / 2), x / 2)
    if family == "gamma":
        return lambda x: _incomplete_gamma(full(x, par[0]), x * par[1])
    if family == "beta":
        return lambda x: _incomplete_beta(full(x, par[0]), full(x, par[1]), x)
    if family == "f":
        m, n = par
        return lambda x: _incomplete_beta(full(x, m / 2), full(x, n / 2), m * np.maximum(x, 0) / (m * np.maximum(x, 0) + n))
    if family == "t":
        n = par[0]
        half = lambda x: _incomplete_beta(full(x, n / 2), full(x, 0.5), n / (n + x * x)) / 2
        return lambda x: np.where(x > 0, 1 - half(x), half(x))
    if family == "binom":
        n, p = par
        k = lambda x: np.floor(x)
        return lambda x: np.where(k(x) < 0, 0.0, np.where(k(x) >= n, 1.0, _incomplete_beta(np.maximum(n - k(x), 0.5), np.maximum(k(x) + 1, 0.5), full(x, 1 - p))))
    if family == "pois":
        return lambda x: np.where(x < 0, 0.0, 1 - _incomplete_gamma(np.maximum(np.floor(x) + 1, 0.5), full(x, par[0])))
    raise ValueError(family)


def dist_cdf(c, family: str, *par: float) -> Column:
    """chisq(df), gamma(shape, rate), beta(a, b), f(df1, df2), t(df), binom(n, p), pois(rate)."""
    return _distribution(_cdf(family, *par))(col(c).cast("double"))


def dist_quantile(c, family: str, *par: float) -> Column:
    """Inverse of the continuous families by halving."""
    cdf = _cdf(family, *par)

    def inverse(p: np.ndarray) -> np.ndarray:
        lo = np.full(len(p), -1.0 if family == "t" else 0.0)
        hi = np.full(len(p), 1.0)
        for _ in range(0 if family == "beta" else 200):
            short, long = cdf(hi) < p, (cdf(lo) > p) & (family == "t")
            if not (short.any() or long.any()):
                break
            hi, lo = np.where(short, hi * 2, hi), np.where(long, lo * 2, lo)
        for _ in range(100):
            mid = (lo + hi) / 2
            below = cdf(mid) < p
            lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
        return np.where((p < 0) | (p > 1), np.nan, (lo + hi) / 2)
    return _distribution(inverse)(col(c).cast("double"))


# Lanczos coefficients for g = 7.
_LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905,
            -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7]


def _lanczos(x: Column) -> Column:
    """Log of gamma for x of 0.5 or more."""
    total = reduce(lambda acc, k: acc + F.lit(_LANCZOS[k]) / (x + (k - 1.0)), range(1, 9), F.lit(_LANCZOS[0]))
    t = x + 6.5
    return F.lit(math.log(2 * math.pi) / 2) + (x - 0.5) * F.log(t) - t + F.log(total)


def lgamma(c) -> Column:
    """Log of the absolute gamma function, by reflection below 0.5; infinite at 0, -1, -2 and so on."""
    def value(x):
        low = F.log(F.lit(math.pi)) - F.log(F.abs(F.sin(F.lit(math.pi) * x))) - bind(1 - x, _lanczos)
        pole = (x <= 0) & (x == F.floor(x))
        return F.when(pole, float("inf")).when(x < 0.5, low).otherwise(_lanczos(x))

    return bind(col(c).cast("double"), value)


def gamma(c) -> Column:
    """Products for whole numbers, else by ``lgamma``; NaN at 0, -1, -2 and so on."""
    x = col(c).cast("double")
    whole = (x == F.floor(x)) & x.between(1, 171)
    product = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(x, F.lit(171.0)), F.lit(1.0)).cast("int")), F.lit(1.0),
                          lambda acc, k: F.when(k < x, acc * k).otherwise(acc))
    sign = F.when((x < 0) & (F.pmod(F.floor(x), F.lit(2)) == 1), -1.0).otherwise(1.0)
    pole = (x <= 0) & (x == F.floor(x))
    return F.when(pole, float("nan")).when(whole, product).otherwise(sign * F.exp(lgamma(x)))


def factorial(c) -> Column:
    """As a double, so that it does not stop at 20."""
    return gamma(col(c) + 1)


def lchoose(n, k) -> Column:
    n, k = col(n), col(k)
    return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)


def choose(n, k) -> Column:
    return F.round(F.exp(lchoose(n, k)))


def beta(a, b) -> Column:
    a, b = col(a), col(b)
    return F.exp(lgamma(a) + lgamma(b) - lgamma(a + b))


def rbernoulli(p: float, seed: int = 0) -> Column:
    return F.rand(seed) < p


def rdunif(lo: int, hi: int, seed: int = 0) -> Column:
    return (F.floor(F.rand(seed) * (hi - lo + 1)) + lo).cast("bigint")


def rnorm(mean: float = 0.0, sd: float = 1.0, seed: int = 0) -> Column:
    return F.randn(seed) * sd + mean


def centroid(df: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """Mean point per group (a rule of this library)."""
    return df.groupBy(*by).agg(F.avg(x).alias(x), F.avg(y).alias(y))
