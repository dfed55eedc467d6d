"""Missing-value rules.

NA is null; NaN is kept apart from it in values but counts as missing in
tests. Aggregates give NA as soon as one input is NA, unless ``na_rm``.
Each aggregate takes an optional window ``w``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAN = float("nan")
INF = float("inf")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, fn) -> Column:
    """``fn`` of a value that is worked out once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _over(c: Column, w) -> Column:
    return c if w is None else c.over(w)


def is_na(c, floating: bool = False) -> Column:
    """Missing test; with ``floating`` NaN counts as missing too."""
    c = col(c)
    return (c.isNull() | F.isnan(c)) if floating else c.isNull()


def is_nan(c) -> Column:
    return F.coalesce(F.isnan(col(c)), F.lit(False))


def is_finite(c) -> Column:
    c = col(c)
    return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(INF)), F.lit(False))


def is_infinite(c) -> Column:
    c = col(c)
    return F.coalesce(F.abs(c) == F.lit(INF), F.lit(False))


def na_omit(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows in which one of the columns is NA or NaN."""
    names = cols or df.columns
    for name in names:
        df = df.where(~na_test(df, name))
    return df


def na_test(df: DataFrame, name: str) -> Column:
    return is_na(name, isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)))


def _missing(c: Column) -> Column:
    """Works for every numeric type."""
    return c.isNull() | F.isnan(c.cast("double"))


def _kept(c: Column) -> Column:
    return F.when(~_missing(c), c)


def _strict(value: Column, c: Column, w) -> Column:
    """NA when one input is NA."""
    return F.when(_over(F.count(F.lit(1)), w) == _over(F.count(c), w), value)


def r_sum(c, na_rm: bool = False, w=None) -> Column:
    c = col(c)
    if na_rm:
        return F.coalesce(_over(F.sum(_kept(c)), w), F.lit(0))
    return _strict(F.coalesce(_over(F.sum(c), w), F.lit(0)), c, w)


def r_mean(c, na_rm: bool = False, w=None) -> Column:
    c = col(c)
    if na_rm:
        return F.coalesce(_over(F.avg(_kept(c)), w).cast("double"), F.lit(NAN))
    return _strict(F.coalesce(_over(F.avg(c), w).cast("double"), F.lit(NAN)), c, w)


def r_var(c, na_rm: bool = False, w=None) -> Column:
    c = col(c)
    return _over(F.var_samp(_kept(c)), w) if na_rm else _strict(_over(F.var_samp(c), w), c, w)


def r_sd(c, na_rm: bool = False, w=None) -> Column:
    c = col(c)
    return _over(F.stddev_samp(_kept(c)), w) if na_rm else _strict(_over(F.stddev_samp(c), w), c, w)


def _extreme(agg, empty: float, c, na_rm: bool, w) -> Column:
    c = col(c)
    value = F.coalesce(_over(agg(_kept(c)), w).cast("double"), F.lit(empty))
    if na_rm:
        return value
    return F.when(_over(F.count_if(_missing(c)), w) == 0, value)


def r_min(c, na_rm: bool = False, w=None) -> Column:
    """Double; +Inf on no rows."""
    return _extreme(F.min, INF, c, na_rm, w)


def r_max(c, na_rm: bool = False, w=None) -> Column:
    """Double; -Inf on no rows."""
    return _extreme(F.max, -INF, c, na_rm, w)


def n_distinct(*cols, na_rm: bool = False, approx: bool = False) -> Column:
    """Distinct tuples; NA is a value unless ``na_rm``, which drops tuples holding one."""
    cs = [col(c) for c in cols]
    key = F.struct(*cs)
    if na_rm:
        keep = F.lit(True)
        for c in cs:
            keep = keep & c.isNotNull()
        key = F.when(keep, key)
    return F.approx_count_distinct(F.xxhash64(key)) if approx else F.count_distinct(key)


def r_any(c, na_rm: bool = False, w=None) -> Column:
    """True if one is true, else NA if one is NA, else false."""
    c = col(c)
    some = F.coalesce(_over(F.bool_or(c), w), F.lit(False))
    if na_rm:
        return some
    return F.when(some, F.lit(True)).when(_over(F.count_if(c.isNull()), w) > 0, F.lit(None).cast("boolean")).otherwise(False)


def r_all(c, na_rm: bool = False, w=None) -> Column:
    """False if one is false, else NA if one is NA, else true."""
    c = col(c)
    every = F.coalesce(_over(F.bool_and(c), w), F.lit(True))
    if na_rm:
        return every
    return F.when(~every, F.lit(False)).when(_over(F.count_if(c.isNull()), w) > 0, F.lit(None).cast("boolean")).otherwise(True)


def coalesce(*cols) -> Column:
    return F.coalesce(*[col(c) for c in cols])


def na_if(c, value) -> Column:
    return F.nullif(col(c), value if isinstance(value, Column) else F.lit(value))


def replace_na(c, value) -> Column:
    return F.coalesce(col(c), value if isinstance(value, Column) else F.lit(value))
