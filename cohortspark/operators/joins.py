"""Equi joins with NA matching, nearest, band and interval joins.

No join here is hinted to broadcast unless the side is bound by construction:
adaptive execution picks broadcast from measured sizes. It also splits a hot
key, but only on a side whose rows need not all be kept: both sides of an inner
join, the left side of left, semi and anti joins. Where the hot side is the
other one, the join is written as an inner join plus the rows without partner.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.operators import ordered as O
from cohortspark.operators import sweep
from cohortspark.operators.verbs import first_rows
from cohortspark.session import hot_rows

By = list[str] | dict[str, str] | None


def _pairs(x: DataFrame, y: DataFrame, by: By) -> list[tuple[str, str]]:
    if by is None:
        by = [c for c in x.columns if c in y.columns]
        if not by:
            raise ValueError("no common columns")
    return list(by.items()) if isinstance(by, dict) else [(c, c) for c in by]


def _condition(x: DataFrame, y: DataFrame, pairs, na_matches: str) -> Column:
    cond = F.lit(True)
    for a, b in pairs:
        if na_matches == "na":
            cond = cond & x[a].eqNullSafe(y[b])
        else:
            cond = cond & (x[a] == y[b])
            if isinstance(x.schema[a].dataType, (T.DoubleType, T.FloatType)):
                cond = cond & ~F.isnan(x[a])
    return cond


def _has_hot_key(df: DataFrame, keys: list[str]) -> bool:
    limit = hot_rows(df.sparkSession)
    return not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit).isEmpty()


def _pair_rows(x: DataFrame, yr: DataFrame, pairs, how: str, na_matches: str) -> DataFrame:
    """The joined rows; outer joins with a hot key on a kept side are put together from parts."""
    cond = _condition(x, yr, pairs, na_matches)
    if how in ("inner", "left", "right", "full"):
        left_keys, right_keys = [a for a, _ in pairs], [b for _, b in pairs]
        split = {"inner": lambda: False, "left": lambda: _has_hot_key(yr, right_keys), "right": lambda: _has_hot_key(x, left_keys),
                 "full": lambda: _has_hot_key(x, left_keys) or _has_hot_key(yr, right_keys)}[how]()
        if split:
            out = x.join(yr, cond, "inner")
            if how in ("left", "full"):
                out = out.unionByName(_without_partner(x, yr, cond, right_keys), allowMissingColumns=True)
            if how in ("right", "full"):
                out = out.unionByName(_without_partner(yr, x, cond, left_keys), allowMissingColumns=True)
            return out
    return x.join(yr, cond, how)


def _without_partner(x: DataFrame, y: DataFrame, cond: Column, y_keys: list[str]) -> DataFrame:
    """Anti join against the distinct keys, so that a hot key of y is one row."""
    return x.join(y.select(*y_keys).distinct(), cond, "left_anti")


def _mutating(x: DataFrame, y: DataFrame, by: By, how: str, suffix, na_matches: str) -> DataFrame:
    pairs = _pairs(x, y, by)
    yr = y.withColumnsRenamed({c: f"__y_{c}" for c in y.columns})
    joined = _pair_rows(x, yr, [(a, f"__y_{b}") for a, b in pairs], how, na_matches)
    key_of = dict(pairs)
    y_keys = {b for _, b in pairs}
    clash = {c for c in x.columns if c in y.columns and c not in key_of and c not in y_keys}
    out = []
    for c in x.columns:
        if c in key_of:
            key = F.col(f"__y_{key_of[c]}")
            value = {"full": F.coalesce(F.col(c), key), "right": key}.get(how, F.col(c))
            out.append(value.alias(c))
        else:
            out.append(F.col(c).alias(c + suffix[0] if c in clash else c))
    out += [F.col(f"__y_{c}").alias(c + suffix[1] if c in clash else c) for c in y.columns if c not in y_keys]
    return joined.select(*out)


def inner_join(x, y, by: By = None, suffix=(".x", ".y"), na_matches: str = "na") -> DataFrame:
    return _mutating(x, y, by, "inner", suffix, na_matches)


def left_join(x, y, by: By = None, suffix=(".x", ".y"), na_matches: str = "na") -> DataFrame:
    return _mutating(x, y, by, "left", suffix, na_matches)


def right_join(x, y, by: By = None, suffix=(".x", ".y"), na_matches: str = "na") -> DataFrame:
    return _mutating(x, y, by, "right", suffix, na_matches)


def full_join(x, y, by: By = None, suffix=(".x", ".y"), na_matches: str = "na") -> DataFrame:
    return _mutating(x, y, by, "full", suffix, na_matches)


def _filtering(x: DataFrame, y: DataFrame, by: By, how: str, na_matches: str) -> DataFrame:
    """Only the different keys of y matter: a hot key of y is one row, and their shuffle serves the join."""
    pairs = _pairs(x, y, by)
    names = {b: f"__y_{b}" for _, b in pairs}
    keys = y.select(*[F.col(b).alias(n) for b, n in names.items()]).distinct()
    return x.join(keys, _condition(x, keys, [(a, names[b]) for a, b in pairs], na_matches), how)


def semi_join(x, y, by: By = None, na_matches: str = "na") -> DataFrame:
    return _filtering(x, y, by, "left_semi", na_matches)


def anti_join(x, y, by: By = None, na_matches: str = "na") -> DataFrame:
    return _filtering(x, y, by, "left_anti", na_matches)


def join_all(dfs: list[DataFrame], by: list[str], how: str = "left", match: str = "all",
             order: list[str] | None = None) -> DataFrame:
    """Join a list of tables; ``match="first"`` keeps the first partner in ``order``."""
    if match == "first":
        dfs = [dfs[0], *[first_rows(d, 1, order, by) for d in dfs[1:]]]
    return reduce(lambda a, b: _mutating(a, b, by, how, (".x", ".y"), "na"), dfs)


# ---------------------------------------------------------------- nearest

def nearest_join(x: DataFrame, y: DataFrame, by: list[str], on: str, max_dist: float | None = None,
                 y_on: str | None = None, order: list[str] | None = None) -> DataFrame:
    """For each x row the y row with the nearest ``on`` value in the group, the lower one on a tie.

    ``max_dist`` is in days for dates and times.

    Both tables are laid in one sorted line; the last y row before and the next
    one after each x row are the only candidates, so no pairs are built.
    ``order`` names y columns that pick one of several y rows at one value.
    """
    y_on = y_on or on
    payload = [c for c in y.columns if c not in by]
    if order is not None:
        y = first_rows(y, 1, order, [*by, y_on])
    kind = x.schema[on].dataType
    instant = isinstance(kind, (T.TimestampType, T.TimestampNTZType))
    if instant:
        num = lambda c: F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        num = F.unix_date
    else:
        num = lambda c: c.cast("double")
    right = y.where(F.col(y_on).isNotNull()).select(
        *by, num(F.col(y_on)).alias("__on"), F.lit(0).alias("__side"),
        F.struct(num(F.col(y_on)).alias("__at"), *payload).alias("__y"))
    left = x.select(*by, num(F.col(on)).alias("__on"), F.lit(1).alias("__side"), F.struct(*x.columns).alias("__x"))
    line = right.unionByName(left, allowMissingColumns=True)
    both = O.neighbours(line, "__y", "__lo", "__hi", ["__on", "__side"], by).where(F.col("__side") == 1)
    dlo, dhi = F.col("__on") - F.col("__lo.__at"), F.col("__hi.__at") - F.col("__on")
    pick = F.when(F.col("__on").isNull(), None).when(
        F.col("__hi").isNull() | (dlo <= dhi), F.col("__lo")).otherwise(F.col("__hi"))
    out = both.withColumn("__best", pick).withColumn("__dist", F.abs(F.col("__on") - F.col("__best.__at")))
    if max_dist is not None:
        limit = max_dist * 86_400_000_000 if instant else max_dist
        out = out.withColumn("__best", F.when(F.col("__dist") <= limit, F.col("__best")))
    names = [c if c not in x.columns else f"{c}.y" for c in payload]
    return out.select("__x.*", *[F.col(f"__best.{c}").alias(n) for c, n in zip(payload, names)])


def asof_last(x: DataFrame, y: DataFrame, by: list[str], on: str, y_on: str | None = None, ties: list[str] | None = None) -> DataFrame:
    """For each x row the last y row at or before it; none for a time that is NA.

    Of y rows with one time the last by ``ties`` (default all other columns of y)
    is taken.
    """
    y_on = y_on or on
    payload = [c for c in y.columns if c not in by]
    tie = F.struct(*(ties or [c for c in payload if c != y_on]), F.lit(0)).alias("__tie")
    right = y.where(F.col(y_on).isNotNull()).select(*by, F.col(y_on).alias("__on"), F.lit(0).alias("__side"), tie, F.struct(*payload).alias("__y"))
    left = x.select(*by, F.col(on).alias("__on"), F.lit(1).alias("__side"), F.struct(*x.columns).alias("__x"))
    line = right.unionByName(left, allowMissingColumns=True)
    lay = O.layout(line, by, ["__on", "__side", "__tie"])
    out = lay.done(O._carry_known(lay, {"__y": "__lo"}, False)).where(F.col("__side") == 1)
    out = out.withColumn("__lo", F.when(F.col("__on").isNotNull(), F.col("__lo")))
    names = [c if c not in x.columns else f"{c}.y" for c in payload]
    return out.select("__x.*", *[F.col(f"__lo.{c}").alias(n) for c, n in zip(payload, names)])


def norm_lookup(df: DataFrame, norms: DataFrame, keys: list[str], score: str, norm_score: str | None = None) -> DataFrame:
    """Left join on keys and score after moving the score into the range the norms cover."""
    norm_score = norm_score or score
    ends = norms.groupBy(*keys).agg(F.min(norm_score).alias("__lo"), F.max(norm_score).alias("__hi"))
    inside = O.attach(df, ends, keys).withColumn(
        "__score", F.least(F.greatest(F.round(score).cast("bigint"), F.col("__lo").cast("bigint")), F.col("__hi").cast("bigint")))
    table = norms.withColumn("__score", F.col(norm_score).cast("bigint")).drop(norm_score)
    return O.attach(inside, table, [*keys, "__score"]).drop("__score", "__lo", "__hi")


# --------------------------------------------------------------- intervals

_LOW = {"[": lambda t, a: t >= a, "(": lambda t, a: t > a}
_HIGH = {"]": lambda t, b: t <= b, ")": lambda t, b: t < b}


def in_bounds(t: Column, a: Column, b: Column, bounds: str = "[]") -> Column:
    """Point test for the four bound kinds ``[] [) (] ()``."""
    return _LOW[bounds[0]](t, a) & _HIGH[bounds[1]](t, b)


def intervals_meet(a0: Column, a1: Column, b0: Column, b1: Column, bounds: str = "[]") -> Column:
    """Two intervals share a point; a shared end counts only when both ends are closed."""
    if bounds == "[]":
        return (a0 <= b1) & (b0 <= a1)
    return (a0 < b1) & (b0 < a1)


def _pairs_of(both: DataFrame, x: DataFrame, y: DataFrame, by: list[str], test: Column) -> DataFrame:
    """Columns of x, then those of y without the keys (``.y`` behind names that x has), of the pairs that pass the test."""
    same = [F.col(f"x.`{c}`").eqNullSafe(F.col(f"y.`{c}`")) for c in by]  # equal hashes are not yet equal keys
    kept = both.where(reduce(lambda a, b: a & b, same, test))
    return kept.select(*[F.col(f"x.`{c}`").alias(c) for c in x.columns],
                       *[F.col(f"y.`{c}`").alias(f"{c}.y" if c in x.columns else c) for c in y.columns if c not in by])


def within_join(x: DataFrame, y: DataFrame, ts: str, start: str, end: str, by: list[str] | None = None,
                bounds: str = "[]") -> DataFrame:
    """Rows of x whose time lies in an interval of y; see operators/sweep.py."""
    by = list(by or [])
    both = sweep.overlapping(x, y, (ts, ts), (start, end), by)
    return _pairs_of(both, x, y, by, in_bounds(F.col(f"x.`{ts}`"), F.col(f"y.`{start}`"), F.col(f"y.`{end}`"), bounds))


def overlap_join(x: DataFrame, y: DataFrame, start: tuple[str, str], end: tuple[str, str],
                 by: list[str] | None = None, bounds: str = "[]") -> DataFrame:
    """Pairs of overlapping intervals, each once; see operators/sweep.py."""
    by = list(by or [])
    both = sweep.overlapping(x, y, (start[0], end[0]), (start[1], end[1]), by)
    ends = [F.col(f"{side}.`{c}`") for side, c in (("x", start[0]), ("x", end[0]), ("y", start[1]), ("y", end[1]))]
    return _pairs_of(both, x, y, by, intervals_meet(*ends, bounds))


def _interval_algebra(x: DataFrame, y: DataFrame, by: list[str], start: str, end: str, keep: Column) -> DataFrame:
    """Stretches over which ``keep``, a test of __in_x and __in_y (the intervals open there), holds.

    One sorted line per group: running counts of open intervals, and where the
    test changes from one boundary to the next a stretch starts or stops.
    """
    parts = []
    for df, side in ((x, "x"), (y, "y")):
        ends = F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("step")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("step"))))
        part = df.where(F.col(start) < F.col(end)).select(*by, ends.alias("__e"))
        step, zero = F.col("__e.step"), F.lit(0)
        parts.append(part.select(*by, F.col("__e.at").alias("__at"), (step if side == "x" else zero).alias("__x"), (step if side == "y" else zero).alias("__y")))
    marks = parts[0].unionByName(parts[1]).groupBy(*by, "__at").agg(F.sum("__x").alias("__x"), F.sum("__y").alias("__y"))
    stop = F.when(~F.col("__keep") & F.col("__was"), F.col("__at"))
    line = O.windows(
        marks, ["__at"], by, __in_x=O.w_cum("__x", "sum"), __in_y=O.w_cum("__y", "sum"), __keep=lambda lay, name: lay.df.withColumn(name, keep),
        __was=O.w_lag("__keep", 1, False), __stop=lambda lay, name: lay.df.withColumn(name, stop), __end=O.w_fill("__stop", up=True))
    return line.where("__keep AND NOT __was").select(*by, F.col("__at").alias(start), F.col("__end").alias(end))


def interval_setdiff(x, y, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Time covered by x and not by y, as half-open intervals."""
    return _interval_algebra(x, y, by, start, end, (F.col("__in_x") > 0) & (F.col("__in_y") == 0))


def interval_intersect(x, y, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    return _interval_algebra(x, y, by, start, end, (F.col("__in_x") > 0) & (F.col("__in_y") > 0))


def interval_union(x, y, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    return _interval_algebra(x, y, by, start, end, (F.col("__in_x") > 0) | (F.col("__in_y") > 0))


def interval_intersects(x, y, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Groups in which the two sets share time."""
    return interval_intersect(x, y, by, start, end).select(*by).distinct()


def interval_contained(x, y, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Groups of x in which every moment is also covered by y."""
    return x.select(*by).distinct().join(interval_setdiff(x, y, by, start, end).select(*by).distinct(), by, "left_anti")
