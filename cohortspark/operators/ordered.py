"""Order-based operators that stay exact and parallel when one group is huge.

Spark runs a window over one group in one task. Here the groups are counted
first. When no group passes the row limit, a plain window is the plan. When
some do, those groups are cut into pieces by split points on the order keys.
The piece of a row depends on its values only, so a recomputed task gives the
same pieces. Each piece is handled by its own task, and what the pieces before
it hand over (a running total, a last value) is computed on one summary row per
piece. The number of pieces is bound by the parallelism, so that summary can be
broadcast.

An order is a list of column names, a leading ``-`` means descending. Missing
values sort last in both directions, NaN after them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.session import cut_lineage, hot_rows

PIECE = "__piece"
_ALL = "__all"
_SAMPLES_PER_PIECE = 12
_PIECES_PER_CORE = 4


@dataclass
class Key:
    expr: Column
    desc: bool = False
    nulls_last: bool = True

    def flip(self) -> "Key":
        return Key(self.expr, not self.desc, not self.nulls_last)

    def sort(self) -> Column:
        if self.desc:
            return self.expr.desc_nulls_last() if self.nulls_last else self.expr.desc_nulls_first()
        return self.expr.asc_nulls_last() if self.nulls_last else self.expr.asc_nulls_first()


def order_keys(df: DataFrame, order: list[str]) -> list[Key]:
    """Sort keys as plain values that also survive a trip to the driver."""
    keys = []
    for spec in order:
        desc, name = spec.startswith("-"), spec.removeprefix("-")
        kind, c = df.schema[name].dataType, F.col(name)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            keys.append(Key(F.coalesce(F.isnan(c), F.lit(False)).cast("int")))
        elif isinstance(kind, T.TimestampType):
            c = F.unix_micros(c)
        elif isinstance(kind, T.DateType):
            c = F.unix_date(c)
        keys.append(Key(c, desc))
    return keys


def sort_columns(df: DataFrame, order: list[str]) -> list[Column]:
    return [k.sort() for k in order_keys(df, order)]


def null_safe(left: DataFrame, right: DataFrame, names: list[str], right_names: list[str] | None = None) -> Column:
    cond = F.lit(True)
    for a, b in zip(names, right_names or names):
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def attach(df: DataFrame, right: DataFrame, by: list[str], how: str = "left", small: bool = False) -> DataFrame:
    """Add the columns of ``right`` (unique on ``by``); missing keys match each other.

    ``small`` is only passed for sides whose row count is bound by construction.
    Otherwise the measured size decides at run time, and a hot key on the left
    is split by the adaptive skew join.
    """
    new = [f"__r_{c}" for c in by]
    renamed = right.withColumnsRenamed(dict(zip(by, new)))
    if small:
        renamed = F.broadcast(renamed)
    return df.join(renamed, null_safe(df, renamed, by, new), how).drop(*new)


@dataclass
class Layout:
    df: DataFrame
    by: list[str]
    keys: list[Key]
    bounds: DataFrame | None = None
    drop: list[str] = field(default_factory=list)

    @property
    def hot(self) -> bool:
        return self.bounds is not None

    def window(self, flip: bool = False):
        keys = [k.flip() if flip else k for k in self.keys]
        return Window.partitionBy(*self.by, PIECE).orderBy(*[k.sort() for k in keys])

    def group(self):
        return Window.partitionBy(*self.by, PIECE)

    def split_rows(self) -> DataFrame:
        return self.df.where(F.col(PIECE) >= 0)

    def pieces(self) -> DataFrame:
        """One row per piece of each split group, empty pieces included."""
        return self.bounds.select(*self.by, F.explode(F.sequence(F.lit(0), F.size("__splits"))).alias(PIECE))

    def across(self, start: int, end: int):
        return Window.partitionBy(*self.by).orderBy(PIECE).rowsBetween(start, end)

    def carry(self, per_piece: DataFrame) -> DataFrame:
        """Join one row per piece to the rows of the piece."""
        return attach(self.df, per_piece, [*self.by, PIECE], small=True)

    def done(self, df: DataFrame) -> DataFrame:
        return df.drop(PIECE, *self.drop)


def not_after(split, row: list[Column], keys: list[Key]) -> Column:
    """True when the split point sorts before the row or level with it."""
    verdict = F.lit(True)
    for i in reversed(range(len(keys))):
        a, b, key = split[f"k{i}"], row[i], keys[i]
        less = (a > b) if key.desc else (a < b)
        edge = (a.isNotNull() & b.isNull()) if key.nulls_last else (a.isNull() & b.isNotNull())
        verdict = F.coalesce(less, F.lit(False)) | edge | (a.eqNullSafe(b) & verdict)
    return verdict


def _piece_of(splits: Column, row: list[Column], keys: list[Key], longest: int) -> Column:
    """Number of split points not after the row, by halving steps."""
    steps = [2 ** i for i in reversed(range(max(longest, 1).bit_length()))]

    def step(acc, s):
        at = acc + s
        ok = (at <= F.size(splits)) & not_after(F.get(splits, at - 1), row, keys)
        return F.when(F.coalesce(ok, F.lit(False)), at).otherwise(acc)

    return F.reduce(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def piece_of(splits: Column, df: DataFrame, c: str, longest: int) -> Column:
    """The piece a value of column ``c`` falls in, by the split points of a layout ordered by such a value; 0 without split points."""
    return F.coalesce(F.when(splits.isNotNull(), _piece_of(splits, [k.expr for k in order_keys(df, [c])], order_keys(df, [c]), longest)), F.lit(0))


def layout(df: DataFrame, by: list[str] | None, order: list[str], small_groups: bool = False, bounded: bool = False, limit: int | None = None) -> Layout:
    """Count the groups and cut those above the row limit.

    Pieces are as many as the tasks that run at once, or, if ``bounded``, as many
    as it takes for a piece to hold about the row limit (``limit``, if given).

    ``small_groups`` saves the counting pass where the size of a group is bound
    by construction, such as one row per school year.
    """
    if not order:
        raise ValueError("an order is needed: Spark rows have no position")
    spark = df.sparkSession
    by, drop = list(by or []), []
    if not by:
        df, by, drop = df.withColumn(_ALL, F.lit(1)), [_ALL], [_ALL]
    keys = order_keys(df, order)
    limit = limit or hot_rows(spark)
    plain = Layout(df.withColumn(PIECE, F.lit(-1)), by, keys, None, drop)
    if small_groups:
        return plain
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    hot_total = sizes.agg(F.sum("__n")).first()[0]
    if not hot_total:
        return plain
    # pieces are no smaller than the limit and, in all, not many more than the tasks that run at once, unless bounded
    target = limit if bounded else max(limit, hot_total // (_PIECES_PER_CORE * spark.sparkContext.defaultParallelism))
    large = sizes.where(F.col("__n") > target).collect()  # at most hot_total / target rows
    if not large:
        return plain
    cut = [(*[r[b] for b in by], math.ceil(r["__n"] / target), r["__n"]) for r in large]
    by_fields = [df.schema[b] for b in by]
    wanted = spark.createDataFrame(cut, T.StructType([
        *[T.StructField(f.name, f.dataType) for f in by_fields],
        T.StructField("__k", T.IntegerType()), T.StructField("__n", T.LongType())]))
    named = [k.expr.alias(f"k{i}") for i, k in enumerate(keys)]
    # a sample only places the cuts; every row is kept
    sample = (attach(df, wanted, by, "inner", small=True)
              .where(F.rand(17) < F.col("__k") * _SAMPLES_PER_PIECE / F.col("__n"))
              .select(*by, *named))
    key_fields = [sample.schema[f"k{i}"] for i in range(len(keys))]
    order_by = [Key(F.col(f"k{i}"), k.desc, k.nulls_last).sort() for i, k in enumerate(keys)]
    drawn: dict[tuple, list[tuple]] = {}
    for r in sample.orderBy(*order_by).collect():
        drawn.setdefault(tuple(r[b] for b in by), []).append(tuple(r[f"k{i}"] for i in range(len(keys))))
    rows, longest = [], 1
    for *group, k, _ in cut:
        points = drawn.get(tuple(group), [])
        # each split point is a row of the group, so no piece after the first is empty
        splits = list(dict.fromkeys(points[len(points) * j // k] for j in range(1, k))) if points else []
        longest = max(longest, len(splits))
        rows.append((*group, splits))
    bounds = spark.createDataFrame(rows, T.StructType([
        *[T.StructField(f.name, f.dataType) for f in by_fields],
        T.StructField("__splits", T.ArrayType(T.StructType(
            [T.StructField(f"k{i}", f.dataType) for i, f in enumerate(key_fields)])))]))
    piece = _piece_of(F.col("__splits"), [k.expr for k in keys], keys, longest)
    cut_df = (attach(df, bounds, by, small=True)
              .withColumn(PIECE, F.when(F.col("__splits").isNull(), F.lit(-1)).otherwise(piece))
              .drop("__splits"))
    return Layout(cut_df, by, keys, bounds, drop)


_UP = (Window.unboundedPreceding, -1)


def _position(lay: Layout, name: str, total: str | None = None) -> DataFrame:
    df = lay.df
    if lay.hot:
        counts = lay.split_rows().groupBy(*lay.by, PIECE).agg(F.count(F.lit(1)).alias("__c"))
        whole = Window.partitionBy(*lay.by)
        per_piece = counts.select(*lay.by, PIECE,
                                  F.coalesce(F.sum("__c").over(lay.across(*_UP)), F.lit(0)).alias("__before"),
                                  F.sum("__c").over(whole).alias("__whole"))
        df = lay.carry(per_piece)
    rn = F.row_number().over(lay.window()).cast("bigint")
    df = df.withColumn(name, rn + F.coalesce(F.col("__before"), F.lit(0)) if lay.hot else rn)
    if total:
        n = F.count(F.lit(1)).over(lay.group())
        # a split group takes its count from the summary, so no task buffers it whole
        df = df.withColumn(total, F.coalesce(F.col("__whole"), n) if lay.hot else n)
    return df.drop("__before", "__whole")


def row_number(df: DataFrame, name: str, order: list[str], by: list[str] | None = None, small_groups: bool = False) -> DataFrame:
    """Position 1..n in the given order."""
    lay = layout(df, by, order, small_groups)
    return lay.done(_position(lay, name))


def ntile(df: DataFrame, name: str, n: int, order: list[str], by: list[str] | None = None, small_groups: bool = False) -> DataFrame:
    """Bucket 1..n of near equal size; rows whose first order column is NA get NA."""
    first = order[0].removeprefix("-")
    known = F.col(first).isNotNull()
    work = df.withColumn("__known", known)
    lay = layout(work, [*(by or []), "__known"], order, small_groups)
    pos = _position(lay, "__pos", "__n")
    base, extra = F.floor(F.col("__n") / n), F.col("__n") % n
    edge = extra * (base + 1)
    zero = F.col("__pos") - 1
    bucket = F.when(zero < edge, F.floor(zero / (base + 1))).otherwise(extra + F.floor((zero - edge) / F.greatest(base, F.lit(1))))
    out = pos.withColumn(name, F.when(F.col("__known"), bucket.cast("bigint") + 1))
    return lay.done(out).drop("__pos", "__n", "__known")


def ranks(df: DataFrame, c: str, by: list[str] | None = None, desc: bool = False, **names: str) -> DataFrame:
    """Rank columns of ``c``; NA stays NA.

    ``names`` maps a measure to its output column: min_rank, dense_rank,
    max_rank, avg_rank, percent_rank, cume_dist. With a group above the row
    limit ties are counted before any ordering, so a value held by many rows is
    one row of the ranking, which is then joined back.
    """
    by = list(by or [])
    spec = ("-" if desc else "") + c
    limit = hot_rows(df.sparkSession)
    known = df.where(F.col(c).isNotNull())
    sizes = known.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    if sizes.where(F.col("__n") > limit).isEmpty():
        return _plain_ranks(df, c, by, spec, names)
    counts = known.groupBy(*by, c).agg(F.count(F.lit(1)).alias("__c"))
    lay = layout(counts, by, [spec])
    run = Layout(_running(lay, "__c", "sum", "__upto"), lay.by, lay.keys, lay.bounds, lay.drop)
    run = lay.done(_position(run, "__dense"))
    run = attach(run, sizes, by) if by else run.withColumn("__n", sizes.scalar())
    first = F.col("__upto") - F.col("__c") + 1
    build = {
        "min_rank": first.cast("bigint"),
        "dense_rank": F.col("__dense").cast("bigint"),
        "max_rank": F.col("__upto").cast("bigint"),
        "avg_rank": first + (F.col("__c") - 1) / 2.0,
        "percent_rank": F.when(F.col("__n") > 1, (first - 1) / (F.col("__n") - 1)).otherwise(F.lit(0.0)),
        "cume_dist": F.col("__upto") / F.col("__n"),
    }
    table = run.select(*by, c, *[build[k].alias(v) for k, v in names.items()])
    return attach(df, table, [*by, c])


def _plain_ranks(df: DataFrame, c: str, by: list[str], spec: str, names: dict[str, str]) -> DataFrame:
    # rows with NA get no rank, so they are dealt out: many of them are no one task
    names_in, df = df.columns, df.withColumn("__na", F.when(F.col(c).isNull(), F.monotonically_increasing_id() % 4096))
    w = Window.partitionBy(*by, "__na").orderBy(*sort_columns(df, [spec]))
    upto = F.count(F.lit(1)).over(w)  # the frame ends with the ties of the row
    build = {
        "min_rank": F.rank().over(w).cast("bigint"),
        "dense_rank": F.dense_rank().over(w).cast("bigint"),
        "max_rank": upto,
        "avg_rank": (F.rank().over(w) + upto) / 2.0,
        "percent_rank": F.percent_rank().over(w),
        "cume_dist": F.cume_dist().over(w),
    }
    ranked = df.withColumns({v: F.when(F.col(c).isNotNull(), build[k]) for k, v in names.items()})
    return ranked.select(*names_in, *[v for v in names.values() if v not in names_in])


_MERGE = {"sum": F.sum, "min": F.min, "max": F.max, "prod": F.product, "any": F.bool_or, "all": F.bool_and}


def _combine(kind: str, carried: Column, local: Column) -> Column:
    if kind == "sum":
        return F.when(carried.isNull(), local).when(local.isNull(), carried).otherwise(carried + local)
    if kind == "prod":
        return F.coalesce(carried, F.lit(1.0)) * F.coalesce(local, F.lit(1.0))
    if kind == "min":
        return F.least(carried, local)
    if kind == "max":
        return F.greatest(carried, local)
    if kind == "any":
        return F.coalesce(carried, F.lit(False)) | F.coalesce(local, F.lit(False))
    return F.coalesce(carried, F.lit(True)) & F.coalesce(local, F.lit(True))


def _running(lay: Layout, c: str, kind: str, name: str) -> DataFrame:
    """Running value with the rule that NA makes all later rows NA."""
    x = F.col(c)
    parts = {"sum": ["sum"], "mean": ["sum"]}.get(kind, [kind])
    df, w = lay.df, lay.window().rowsBetween(Window.unboundedPreceding, 0)
    state = {"__na": F.count_if(x.isNull()), "__rows": F.count(F.lit(1))}
    state.update({f"__{p}": _MERGE[p](x) for p in parts})
    if lay.hot:
        summary = lay.split_rows().groupBy(*lay.by, PIECE).agg(*[v.alias(k) for k, v in state.items()])
        up = lay.across(*_UP)
        merge = {"__na": F.sum("__na"), "__rows": F.sum("__rows")}
        merge.update({f"__{p}": _MERGE[p](f"__{p}") for p in parts})
        df = lay.carry(summary.select(*lay.by, PIECE, *[v.over(up).alias(f"{k}_c") for k, v in merge.items()]))
    na, rows = state["__na"].over(w), state["__rows"].over(w)
    value = _MERGE[parts[0]](x).over(w)
    if lay.hot:
        na = na + F.coalesce(F.col("__na_c"), F.lit(0))
        rows = rows + F.coalesce(F.col("__rows_c"), F.lit(0))
        value = _combine(parts[0], F.col(f"__{parts[0]}_c"), value)
    if kind == "mean":
        out = F.when(na == 0, value / rows)
    elif kind == "any":
        out = F.when(F.coalesce(value, F.lit(False)), F.lit(True)).when(na > 0, F.lit(None).cast("boolean")).otherwise(False)
    elif kind == "all":
        out = F.when(~F.coalesce(value, F.lit(True)), F.lit(False)).when(na > 0, F.lit(None).cast("boolean")).otherwise(True)
    else:
        out = F.when(na == 0, value)
    return df.withColumn(name, out).drop(*[f"{k}_c" for k in state])


def cumulate(df: DataFrame, c: str, kind: str, name: str, order: list[str], by: list[str] | None = None, small_groups: bool = False) -> DataFrame:
    """Running sum, min, max, prod, mean, any or all."""
    lay = layout(df, by, order, small_groups)
    return lay.done(_running(lay, c, kind, name))


def _shift(lay: Layout, c: str, n: int, name: str, default=None) -> DataFrame:
    flip, n = n < 0, abs(n)
    w = lay.window(flip)
    other = F.lit(default).cast(lay.df.schema[c].dataType)
    if not lay.hot:
        return lay.df.withColumn(name, F.lag(F.col(c), n, default).over(w) if default is not None else F.lag(F.col(c), n).over(w))
    back = lay.window(not flip)
    tail = (lay.split_rows().withColumn("__rn", F.row_number().over(back)).where(F.col("__rn") <= n)
            .groupBy(*lay.by, PIECE)
            .agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("__rn")).alias("p"), F.col(c).alias("v")))),
                             lambda s: F.struct(s["v"].alias("v"))).alias("__tail")))
    tails = attach(lay.pieces(), tail, [*lay.by, PIECE])
    # n pieces back hold at least n rows unless some are empty, so empty ones go first
    tails = tails.where(F.col("__tail").isNotNull())
    frame = lay.across(1, n) if flip else lay.across(-n, -1)
    gathered = F.collect_list("__tail").over(frame)
    ordered = F.flatten(F.reverse(gathered)) if flip else F.flatten(gathered)
    df = lay.carry(tails.select(*lay.by, PIECE, ordered.alias("__past")))
    rn = F.row_number().over(w)
    past = F.col("__past")
    reach = F.size(past) - 1 - (F.lit(n) - rn)  # index into the handed-over values
    outside = F.coalesce((reach >= 0) & (F.size(past) > 0), F.lit(False))
    value = (F.when(rn > n, F.lag(F.col(c), n).over(w))
             .when(outside, F.get(past, reach)["v"]).otherwise(other))
    return df.withColumn(name, value).drop("__past")


def lag(df: DataFrame, c: str, name: str, order: list[str], by: list[str] | None = None, n: int = 1, default=None, small_groups: bool = False) -> DataFrame:
    lay = layout(df, by, order, small_groups)
    return lay.done(_shift(lay, c, n, name, default))


def lead(df: DataFrame, c: str, name: str, order: list[str], by: list[str] | None = None, n: int = 1, default=None, small_groups: bool = False) -> DataFrame:
    lay = layout(df, by, order, small_groups)
    return lay.done(_shift(lay, c, -n, name, default))


def diff(df: DataFrame, c: str, name: str, order: list[str], by: list[str] | None = None, n: int = 1, small_groups: bool = False) -> DataFrame:
    """x minus the value n rows before."""
    return lag(df, c, "__lag", order, by, n, small_groups=small_groups).withColumn(name, F.col(c) - F.col("__lag")).drop("__lag")


def _carry_known(lay: Layout, names: dict[str, str], up: bool) -> DataFrame:
    """Last known value at or before the row (or next at or after it)."""
    df = lay.df
    if lay.hot:
        table = lay.pieces()
        for c in names:
            known = lay.split_rows().where(F.col(c).isNotNull())
            edge = (known.withColumn("__rn", F.row_number().over(lay.window(not up))).where(F.col("__rn") == 1)
                    .select(*lay.by, PIECE, F.col(c).alias(f"__e_{c}")))
            table = attach(table, edge, [*lay.by, PIECE])
        across = lay.across(1, Window.unboundedFollowing) if up else lay.across(*_UP)
        pick = F.first if up else F.last
        df = lay.carry(table.select(*lay.by, PIECE, *[
            pick(f"__e_{c}", ignorenulls=True).over(across).alias(f"__c_{c}") for c in names]))
    w = lay.window(up).rowsBetween(Window.unboundedPreceding, 0)
    new = {}
    for c, out in names.items():
        local = F.last(c, ignorenulls=True).over(w)
        new[out] = F.coalesce(local, F.col(f"__c_{c}")) if lay.hot else local
    return df.withColumns(new).drop(*[f"__c_{c}" for c in names])


def fill(df: DataFrame, cols: list[str], order: list[str], by: list[str] | None = None, direction: str = "down", small_groups: bool = False) -> DataFrame:
    """Put the last known value (down) or the next one (up) into NA cells."""
    lay = layout(df, by, order, small_groups)
    columns = df.columns
    for way in {"down": ["down"], "up": ["up"], "downup": ["down", "up"], "updown": ["up", "down"]}[direction]:
        out = _carry_known(lay, {c: f"__f_{c}" for c in cols}, way == "up")
        out = out.drop(*cols).withColumnsRenamed({f"__f_{c}": c for c in cols})
        lay = Layout(out, lay.by, lay.keys, lay.bounds, lay.drop)
    return lay.done(lay.df).select(*columns)


def neighbours(df: DataFrame, c: str, before: str, after: str, order: list[str], by: list[str] | None = None, small_groups: bool = False) -> DataFrame:
    """Both the last known value at or before a row and the next at or after it."""
    lay = layout(df, by, order, small_groups)
    out = _carry_known(lay, {c: before}, False)
    out = _carry_known(Layout(out, lay.by, lay.keys, lay.bounds, lay.drop), {c: after}, True)
    return lay.done(out)


def which(df: DataFrame, c: str, name: str, order: list[str], by: list[str] | None = None, largest: bool = False) -> DataFrame:
    """Position of the first extreme value per group."""
    by = list(by or [])
    pos = row_number(df, "__pos", order, by).where(F.col(c).isNotNull())
    rank = F.struct((-F.col(c) if largest else F.col(c)).alias("v"), F.col("__pos").alias("p"))
    grouped = pos.groupBy(*by) if by else pos.groupBy()
    return grouped.agg(F.min(rank)["p"].alias(name))


def quantiles(df: DataFrame, c: str, probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact interpolated quantiles per group, NA left out.

    Small groups use the built-in aggregate, which keeps the values of a group
    in memory. If a group is above the row limit, values are counted first and
    the ranks looked up on the running count.
    """
    by = list(by or [])
    known = df.where(F.col(c).isNotNull())
    limit = hot_rows(df.sparkSession)
    sizes = known.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    if sizes.where(F.col("n") > limit).isEmpty():
        points = F.percentile(c, F.array(*[F.lit(float(p)) for p in probs.values()]))
        table = known.groupBy(*by).agg(points.alias("__q"))
        return table.select(*by, *[F.get("__q", F.lit(i)).alias(name) for i, name in enumerate(probs)])
    counts = known.groupBy(*by, c).agg(F.count(F.lit(1)).alias("__c"))
    run = cumulate(counts, "__c", "sum", "__upto", [c], by)
    run = attach(run, sizes, by) if by else run.withColumn("n", sizes.scalar())
    low, high = F.col("__upto") - F.col("__c"), F.col("__upto")
    aggs = []
    for name, p in probs.items():
        at = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.floor(at), F.ceil(at)
        aggs += [F.max(F.when((low <= lo) & (lo < high), F.col(c))).alias(f"__lo_{name}"),
                 F.max(F.when((low <= hi) & (hi < high), F.col(c))).alias(f"__hi_{name}"),
                 F.max(at - lo).alias(f"__f_{name}")]
    table = run.groupBy(*by).agg(*aggs)
    return table.select(*by, *[
        (F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__f_{n}")).cast("double").alias(n)
        for n in probs])


def recycle(df: DataFrame, by: list[str] | None = None, **aggs: Column) -> DataFrame:
    """Group statistics as columns of every row: aggregate first, then join back."""
    by = list(by or [])
    if by:
        return attach(df, df.groupBy(*by).agg(*[a.alias(n) for n, a in aggs.items()]), by)
    one = df.agg(F.struct(*[a.alias(n) for n, a in aggs.items()]).alias("s"))
    return df.withColumn("__s", one.scalar()).select("*", *[F.col("__s")[n].alias(n) for n in aggs]).drop("__s")


_FRAME = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def _join_frames(kind: str, a: Column, b: Column) -> Column:
    """Aggregate of two neighbouring stretches of rows; one without a known value is null (0 for a count)."""
    if kind == "min":
        return F.least(a, b)
    if kind == "max":
        return F.greatest(a, b)
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def moving_frames(df: DataFrame, frames: dict[str, tuple[str, str]], start: int, end: int, order: list[str], by: list[str] | None = None,
                  small_groups: bool = False) -> DataFrame:
    """Sums, counts, means, minima and maxima, {name: (kind, column)}, of the rows from ``start`` to ``end`` places away.

    Rows are numbered and cut into blocks as long as the frame. A frame then lies
    in one block, or is the end of one and the beginning of the next: each row
    gets the aggregate up to it and from it on inside its block, and a frame is
    put together from the two rows at its ends, looked up by their numbers. So the
    work does not grow with the length of the frame, a block is the largest group
    of a task, and no row is copied. NA is left out; a frame without a known value
    gives NA (count 0). Sums of doubles may differ in the last digits.
    """
    if start > end:
        raise ValueError("the frame is empty")
    by, width = list(by or []), end - start + 1
    # stored twice: what makes the rows would run again for the counts, the cuts and the places, and the numbering for the rows and both ends
    lay = layout(cut_lineage(df), by, order, small_groups)
    rows = cut_lineage(lay.done(_position(lay, "__pos", "__all_rows")))
    need = {}
    for kind, c in frames.values():
        for k in (("sum", "count") if kind == "mean" else (kind,)):
            need[k, c] = f"__{k}_{df.columns.index(c)}"
    rows = rows.withColumn("__block", F.floor((F.col("__pos") - 1) / width))
    block = Window.partitionBy(*by, "__block")
    ahead = block.orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    back = block.orderBy(F.desc("__pos")).rowsBetween(Window.unboundedPreceding, 0)
    keyed = rows.select(*by, "__pos", "__block", *[_FRAME[k](c).over(ahead).alias(f"{n}_a") for (k, c), n in need.items()],
                        *[_FRAME[k](c).over(back).alias(f"{n}_b") for (k, c), n in need.items()])
    low, high = F.greatest(F.col("__pos") + start, F.lit(1)), F.least(F.col("__pos") + end, F.col("__all_rows"))
    rows = rows.drop("__block").withColumns({"__low": low, "__high": high})
    first = keyed.select(*by, F.col("__pos").alias("__low"), F.col("__block").alias("__low_block"), *[f"{n}_b" for n in need.values()])
    last = keyed.select(*by, F.col("__pos").alias("__high"), F.col("__block").alias("__high_block"), *[f"{n}_a" for n in need.values()])
    both = attach(attach(rows, first, [*by, "__low"]), last, [*by, "__high"])
    some = F.col("__low") <= F.col("__high")
    whole = F.col("__low_block") == F.col("__high_block")
    at_start = (F.col("__low") - 1) % width == 0
    value = {}
    for (k, c), n in need.items():
        a, b = F.col(f"{n}_a"), F.col(f"{n}_b")
        joined = F.when(whole & at_start, a).when(whole, b).otherwise(_join_frames(k, b, a))
        value[k, c] = F.coalesce(F.when(some, joined), F.lit(0)) if k == "count" else F.when(some, joined)
    mean = lambda c: F.when(value["count", c] > 0, value["sum", c] / value["count", c])
    out = both.withColumns({n: mean(c) if kind == "mean" else value[kind, c] for n, (kind, c) in frames.items()})
    return out.select(*[c for c in df.columns if c not in frames], *frames)


def moving(df: DataFrame, aggs: dict[str, Column], start: int, end: int, order: list[str], by: list[str] | None = None, small_groups: bool = False) -> DataFrame:
    """Any aggregates over a frame of a fixed number of rows around each row; for long frames see ``moving_frames``.

    At the edge of a piece the frame needs rows of the neighbouring pieces, so
    those few rows are copied over, used, and dropped again: no more than the
    frame reaches, for each piece.
    """
    lay = layout(df, by, order, small_groups)
    rows = lay.df
    if lay.hot:
        split = lay.split_rows()
        parts = [rows.withColumn("__copy", F.lit(False))]
        counts = split.groupBy(*lay.by, PIECE).agg(F.count(F.lit(1)).alias("__c"))
        for reach, flip, step in ((-min(start, 0), True, 1), (max(end, 0), False, -1)):
            if reach:
                # pieces that begin within the reach behind (or before) a piece: 0, 1, 2 ... of them and the rows that lie between
                line = Window.partitionBy(*lay.by).orderBy(F.col(PIECE) * step)
                upto = counts.withColumn("__after", F.sum("__c").over(line))
                other = upto.select(*[F.col(b).alias(f"__r_{b}") for b in lay.by], F.col(PIECE).alias("__to"), (F.col("__after") - F.col("__c")).alias("__before"))
                near_by = null_safe(upto, other, lay.by, [f"__r_{b}" for b in lay.by])
                reached = upto.join(other, near_by & (F.col("__before") >= F.col("__after")) & (F.col("__before") - F.col("__after") < reach)).select(
                    *lay.by, PIECE, "__to", (F.col("__before") - F.col("__after")).alias("__between"))
                gaps = reached.groupBy(*lay.by, PIECE).agg(F.collect_list(F.struct("__to", "__between")).alias("__gaps"))
                near = split.withColumn("__rn", F.row_number().over(lay.window(flip))).where(F.col("__rn") <= reach)
                near = attach(near, gaps, [*lay.by, PIECE], "inner", small=True).withColumn("__g", F.explode("__gaps"))
                near = near.where(F.col("__rn") + F.col("__g.__between") <= reach).withColumn(PIECE, F.col("__g.__to"))
                parts.append(near.drop("__rn", "__gaps", "__g").withColumn("__copy", F.lit(True)))
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
    w = lay.window().rowsBetween(start, end)
    out = rows.withColumns({n: a.over(w) for n, a in aggs.items()})
    return lay.done(out.where(~F.col("__copy")).drop("__copy") if lay.hot else out)


# Several window columns on one layout: the groups are counted once.

def w_row_number():
    return lambda lay, name: _position(lay, name)


def w_cum(c: str, kind: str):
    return lambda lay, name: _running(lay, c, kind, name)


def w_lag(c: str, n: int = 1, default=None):
    return lambda lay, name: _shift(lay, c, n, name, default)


def w_lead(c: str, n: int = 1, default=None):
    return lambda lay, name: _shift(lay, c, -n, name, default)


def w_fill(c: str, up: bool = False):
    return lambda lay, name: _carry_known(lay, {c: name}, up)


def windows(df: DataFrame, order: list[str], by: list[str] | None = None, *, small_groups: bool = False, **specs) -> DataFrame:
    """Add several window columns, ``windows(df, ["ts"], ["k"], n=w_row_number(), prev=w_lag("x"))``."""
    lay = layout(df, by, order, small_groups)
    for name, spec in specs.items():
        lay = Layout(spec(lay, name), lay.by, lay.keys, lay.bounds, lay.drop)
    return lay.done(lay.df)
