"""Table verbs: columns, rows, edits, sorting, set operations."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.functions.na import is_na, na_test
from cohortspark.operators import ordered as O
from cohortspark.session import broadcast_rows

# ---------------------------------------------------------------- selection

Selector = Callable[[list[str]], list[str]]


def starts_with(prefix: str) -> Selector:
    return lambda names: [n for n in names if n.lower().startswith(prefix.lower())]


def ends_with(suffix: str) -> Selector:
    return lambda names: [n for n in names if n.lower().endswith(suffix.lower())]


def contains(part: str) -> Selector:
    return lambda names: [n for n in names if part.lower() in n.lower()]


def matches(pattern: str) -> Selector:
    return lambda names: [n for n in names if re.search(pattern, n, re.I)]


def num_range(prefix: str, numbers, width: int = 0) -> Selector:
    wanted = [f"{prefix}{i:0{width}d}" for i in numbers]
    return lambda names: [n for n in wanted if n in names]


def one_of(*wanted: str) -> Selector:
    return lambda names: [n for n in wanted if n in names]


def everything() -> Selector:
    return list


def last_col(offset: int = 0) -> Selector:
    return lambda names: [names[-1 - offset]]


def resolve(df: DataFrame, *specs) -> list[str]:
    """Names chosen by ``"a"``, ``"a:c"`` ranges, ``"-a"`` negation and helpers."""
    names, chosen = df.columns, []
    drops_first = bool(specs) and isinstance(specs[0], str) and specs[0].startswith("-") and specs[0] not in names
    if drops_first:
        chosen = list(names)
    for spec in specs:
        if callable(spec):
            found, drop = spec(names), False
        else:
            drop = spec.startswith("-") and spec not in names
            text = spec[1:] if drop else spec
            if ":" in text and text not in names:
                a, b = (names.index(t) for t in text.split(":"))
                found = names[a:b + 1] if a <= b else names[b:a + 1][::-1]
            else:
                if text not in names:
                    raise KeyError(text)
                found = [text]
        if drop:
            chosen = [n for n in chosen if n not in found]
        else:
            chosen += [n for n in found if n not in chosen]
    return chosen


def select(df: DataFrame, *specs, **renamed: str) -> DataFrame:
    """Choose columns; keyword ``new="old"`` renames."""
    cols = [F.col(f"`{n}`") for n in resolve(df, *specs)] if specs else []
    return df.select(*cols, *[F.col(f"`{old}`").alias(new) for new, old in renamed.items()])


def rename(df: DataFrame, **renamed: str) -> DataFrame:
    return df.withColumnsRenamed({old: new for new, old in renamed.items()})


Pred = Callable[[T.StructField], bool]


def is_numeric(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.NumericType)


def is_string(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.StringType)


def _where_fields(df: DataFrame, which) -> list[str]:
    if callable(which):
        return [f.name for f in df.schema.fields if which(f)]
    return resolve(df, *which)


def select_if(df: DataFrame, pred, renamer: Callable[[str], str] | None = None) -> DataFrame:
    """Columns by predicate on the field or by a list, with a renaming function."""
    return df.select(*[F.col(n).alias(renamer(n) if renamer else n) for n in _where_fields(df, pred)])


def rename_if(df: DataFrame, pred, renamer: Callable[[str], str]) -> DataFrame:
    return df.withColumnsRenamed({n: renamer(n) for n in _where_fields(df, pred)})


# ------------------------------------------------------------------ mutate

def mutate(df: DataFrame, by: list[str] | None = None, **exprs: Column) -> DataFrame:
    """Add columns in order. With ``by`` each expression is a group aggregate given to every row."""
    if by:
        return O.recycle(df, by, **exprs)
    for name, expr in exprs.items():
        df = df.withColumn(name, expr)
    return df


def transmute(df: DataFrame, **exprs: Column) -> DataFrame:
    return mutate(df, **exprs).select(*exprs)


def mutate_at(df: DataFrame, which, *fns: Callable[[Column], Column], suffixes: list[str] | None = None) -> DataFrame:
    """Apply functions to chosen columns, in place or as new suffixed columns."""
    names = _where_fields(df, which)
    if suffixes:
        return df.withColumns({f"{n}_{s}": f(F.col(n)) for n in names for f, s in zip(fns, suffixes)})
    return df.withColumns({n: reduce(lambda c, f: f(c), fns, F.col(n)) for n in names})


def rowwise_agg(df: DataFrame, name: str, cols: list[str], how: str) -> DataFrame:
    """One value per row over several columns: sum, mean, min, max, n_missing."""
    cells = [F.col(c) for c in cols]
    total = reduce(lambda a, b: a + b, cells)
    value = {"sum": total, "mean": total / len(cells), "min": F.least(*cells), "max": F.greatest(*cells),
             "n_missing": reduce(lambda a, b: a + b, [c.isNull().cast("int") for c in cells])}[how]
    return df.withColumn(name, value)


# ------------------------------------------------------------------ filter

def filter(df: DataFrame, *conds: Column, by: list[str] | None = None, **stats: Column) -> DataFrame:
    """Keep rows where all conditions are true; ``stats`` are group aggregates the conditions may use."""
    if stats:
        df2 = O.recycle(df, by, **stats)
        return reduce(lambda d, c: d.where(c), conds, df2).select(*df.columns)
    return reduce(lambda d, c: d.where(c), conds, df)


def filter_at(df: DataFrame, which, pred: Callable[[Column], Column], how: str = "all") -> DataFrame:
    tests = [pred(F.col(n)) for n in _where_fields(df, which)]
    return df.where(reduce((lambda a, b: a & b) if how == "all" else (lambda a, b: a | b), tests))


def is_in(c, values: list) -> Column:
    """Membership that is never NA."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.isin(values), F.lit(False))


def in_table(df: DataFrame, c: str, table: DataFrame, key: str | None = None) -> DataFrame:
    """Membership in another table, for sets too large for a list."""
    key = key or c
    right = table.select(F.col(key).alias("__key")).where(F.col("__key").isNotNull()).distinct()
    return df.join(right, df[c] == right["__key"], "left_semi")


def between(c, lo, hi) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.between(lo, hi)


def near(a, b, tol: float = 1.5e-8) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.abs(a - b) < tol


def case_when(*branches: tuple[Column, object], default=None) -> Column:
    out = F
    for cond, value in branches:
        out = out.when(cond, value)
    return out.otherwise(default)


def if_else(cond: Column, yes, no, missing=None) -> Column:
    return F.when(cond, yes).when(~cond, no).otherwise(missing)


def recode(c, mapping: dict, default=None, missing=None) -> Column:
    """Map values. Without ``default`` the rest is kept."""
    c = F.col(c) if isinstance(c, str) else c
    out = F.when(c.isNull(), F.lit(missing))
    for old, new in mapping.items():
        out = out.when(c == old, F.lit(new))
    return out.otherwise(c if default is None else F.lit(default))


def recode_from(df: DataFrame, c: str, table: DataFrame, old: str, new: str) -> DataFrame:
    """Map values by a table, for many keys."""
    right = table.select(F.col(old).alias(c), F.col(new).alias("__new"))
    return O.attach(df, right, [c]).withColumn(c, F.coalesce("__new", c)).drop("__new")


def convert_to_na(df: DataFrame, values: list[str]) -> DataFrame:
    """Given strings become NA in every string column."""
    return df.withColumns({f.name: F.when(~F.coalesce(F.col(f.name).isin(values), F.lit(False)), F.col(f.name))
                           for f in df.schema.fields if is_string(f)})


def replace_na(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items()})


def drop_na(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return reduce(lambda d, c: d.where(~na_test(d, c)), cols or df.columns, df)


# --------------------------------------------------------- rows by position

def slice(df: DataFrame, positions: list[int], order: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows by position (1-based) per group; negative positions drop rows."""
    if any(p < 0 for p in positions):
        drop = [-p for p in positions]
        return O.row_number(df, "__pos", order, by).where(~F.col("__pos").isin(drop)).drop("__pos")
    return first_rows(df, max(positions), order, by, "__pos").where(F.col("__pos").isin(positions)).drop("__pos")


# Up to this n Spark cuts each map task to n rows per group before the shuffle.
GROUP_LIMIT = 1000


def first_rows(df: DataFrame, n: int, order: list[str], by: list[str] | None = None, name: str | None = None) -> DataFrame:
    """First n rows per group."""
    pos = name or "__pos"
    if n > GROUP_LIMIT:
        out = O.row_number(df, pos, order, by).where(F.col(pos) <= n)
    else:
        w = Window.partitionBy(*(by or [])).orderBy(*O.sort_columns(df, order))
        out = df.withColumn(pos, F.row_number().over(w)).where(F.col(pos) <= n)
    return out if name else out.drop("__pos")


def reverse_order(order: list[str]) -> list[str]:
    return [o[1:] if o.startswith("-") else f"-{o}" for o in order]


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*O.sort_columns(df, order)).limit(n)


def tail(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*[k.flip().sort() for k in O.order_keys(df, order)]).limit(n)


def top_n(df: DataFrame, n: int, wt: str, by: list[str] | None = None) -> DataFrame:
    """Largest n per group (smallest for negative n), ties kept."""
    if abs(n) > GROUP_LIMIT:
        return O.ranks(df, wt, by, desc=n > 0, min_rank="__rank").where(F.col("__rank") <= abs(n)).drop("__rank")
    keys = O.sort_columns(df, [("-" if n > 0 else "") + wt])
    w = Window.partitionBy(*(by or [])).orderBy(*keys)
    return (df.where(F.col(wt).isNotNull()).withColumn("__rank", F.rank().over(w))
            .where(F.col("__rank") <= abs(n)).drop("__rank"))


def arrange(df: DataFrame, *order: str) -> DataFrame:
    """Sort; missing last in both directions, NaN after NA."""
    return df.orderBy(*O.sort_columns(df, list(order)))


def arrange_at(df: DataFrame, which, desc: bool = False) -> DataFrame:
    return arrange(df, *[("-" if desc else "") + n for n in _where_fields(df, which)])


def str_sort(df: DataFrame, c: str, locale: str = "UNICODE", desc: bool = False) -> DataFrame:
    key = F.collate(F.col(c), locale)
    return df.orderBy(key.desc_nulls_last() if desc else key.asc_nulls_last(), F.col(c))


def str_order(df: DataFrame, c: str, name: str, locale: str = "UNICODE") -> DataFrame:
    """Position of each distinct string in the sort order of the locale."""
    values = df.select(c).distinct().withColumn("__key", F.collate(F.col(c), locale))
    lay = O.layout(values, None, ["__key", c])
    return O.attach(df, lay.done(O._position(lay, name)).drop("__key"), [c])


def merge_sorted(dfs: list[DataFrame], *order: str) -> DataFrame:
    return arrange(union_all(*dfs), *order)


def distinct(df: DataFrame, cols: list[str] | None = None, keep_all: bool = False, order: list[str] | None = None) -> DataFrame:
    if not cols:
        return df.distinct()
    if not keep_all:
        return df.select(*cols).distinct()
    return first_rows(df, 1, order, cols)


def match_rows(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` that also occur in ``other`` on the given columns."""
    keys = other.select(*[F.col(c).alias(f"__k_{c}") for c in on]).distinct()
    return df.join(keys, O.null_safe(df, keys, on, [f"__k_{c}" for c in on]), "left_semi")


def sample_n(df: DataFrame, n: int, by: list[str] | None = None, weight: str | None = None,
             seed: int = 0, replace: bool = False) -> DataFrame:
    """Exactly n random rows per group (all rows of smaller groups).

    Rows whose weight is zero or NA are never drawn; a negative weight is an error.
    With ``replace`` a row may come back, see ``draw_rows``.
    """
    by = list(by or [])
    if replace:
        return draw_rows(df, n, by, weight, seed)
    key = F.rand(seed)
    if weight is not None:
        df = df.where(F.col(weight) != 0)
        size = F.when(F.col(weight) < 0, F.raise_error(F.lit("negative weight")).cast("double")).otherwise(F.col(weight))
        key = -F.log(key) / size
    return first_rows(df.withColumn("__u", key), n, ["__u"], by).drop("__u")


DRAWS_PER_ROW = 10_000


def draw_rows(df: DataFrame, n: int, by: list[str] | None = None, weight: str | None = None, seed: int = 0) -> DataFrame:
    """n independent draws per group, each row with a chance in proportion to its weight (all equal without one).

    The rows of a group lie one behind the other on a line, each as long as its
    weight, and a draw is a point on it. Points follow from the seed, the group and
    the number of the draw. They are made in blocks on many tasks and find
    their rows by a sweep along the line, so neither many draws nor a long line is
    one task's work.
    """
    from cohortspark.operators.joins import within_join
    from cohortspark.session import cut_lineage

    by = list(by or [])
    size = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    sized = df.withColumn("__w", F.when(size < 0, F.raise_error(F.lit("negative weight")).cast("double")).otherwise(size)).where("__w > 0")
    # numbers of rows must not change between uses
    line = cut_lineage(sized.withColumn("__id", F.monotonically_increasing_id()))
    line = O.windows(line, ["__id"], by, __hi=O.w_cum("__w", "sum"), __lo=O.w_lag("__hi", 1, 0.0))
    line = cut_lineage(line.drop("__w", "__id"))
    ends = line.groupBy(*by).agg(F.max("__hi").alias("__end")).where(F.col("__end").isNotNull())
    blocks = F.sequence(F.lit(0), F.lit(max(0, (n - 1) // DRAWS_PER_ROW)))
    draws = ends.select(*by, "__end", F.explode(blocks).alias("__block")).repartition(*by, "__block")
    first = F.col("__block") * DRAWS_PER_ROW
    draws = draws.withColumn("__draw", F.explode(F.sequence(first, F.least(first + DRAWS_PER_ROW, F.lit(n)) - 1)))
    share = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("draw"), *by, "__draw"), 11) / F.lit(float(1 << 53))
    points = draws.select(*by, (share * F.col("__end")).alias("__at")) if n > 0 else draws.limit(0).select(*by, F.lit(0.0).alias("__at"))
    return within_join(points, line, "__at", "__lo", "__hi", by, "[)").select(*df.columns)


def sample_frac(df: DataFrame, frac: float, by: list[str] | None = None, seed: int = 0) -> DataFrame:
    """The given share of the rows of each group, exactly, in a hashed order."""
    lay = O.layout(df.withColumn("__u", F.xxhash64(F.lit(seed), *df.columns)), by, ["__u"])
    return lay.done(O._position(lay, "__pos", "__n").where(F.col("__pos") <= F.round(F.col("__n") * frac)).drop("__pos", "__n", "__u"))


def pull(df: DataFrame, c: str) -> DataFrame:
    return df.select(c)


# ------------------------------------------------------------------- edits

def add_row(df: DataFrame, **values) -> DataFrame:
    row = df.sparkSession.createDataFrame([tuple(values.get(c) for c in df.columns)], df.schema)
    return df.unionByName(row)


def add_column(df: DataFrame, name: str, expr, before: str | None = None) -> DataFrame:
    if name in df.columns:
        raise ValueError(f"column {name} exists")
    names = list(df.columns)
    names.insert(names.index(before) if before else len(names), name)
    return df.withColumn(name, expr if isinstance(expr, Column) else F.lit(expr)).select(*names)


def rowid_to_column(df: DataFrame, order: list[str], name: str = "rowid") -> DataFrame:
    return O.row_number(df, name, order).select(name, *df.columns)


def repair_names(names: list[str]) -> list[str]:
    """Empty names get ``x``, repeats a number."""
    seen, out = set(), []
    for n in names:
        base = n or "x"
        new, i = base, 1
        while new in seen:
            new, i = f"{base}_{i}", i + 1
        seen.add(new)
        out.append(new)
    return out


def upsert_rows(df: DataFrame, changes: DataFrame, key: str, insert: bool = True) -> DataFrame:
    """Rows with a known key are replaced; others are added, or are an error."""
    if not insert:
        stray = changes.join(df.select(key).distinct(), key, "left_anti")
        if not stray.isEmpty():
            raise KeyError(f"unknown {key} in changes")
    return df.join(changes.select(key).distinct(), key, "left_anti").unionByName(changes)


def append_with_id(df: DataFrame, rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """New rows get the next ids after the largest one."""
    top = F.coalesce(df.agg(F.max(key)).scalar(), F.lit(0))
    numbered = O.row_number(rows, key, order).withColumn(key, F.col(key) + top)
    return df.unionByName(numbered.withColumn(key, F.col(key).cast(df.schema[key].dataType)).select(*df.columns))


def delete_rows(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key).distinct(), key, "left_anti")


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Rows with the key; an unknown key is an error."""
    found = df.where(F.col(key) == value)
    if found.isEmpty():
        raise KeyError(value)
    return found


def validate_required(df: DataFrame, required: list[str], name: str = "errors") -> DataFrame:
    """List the required fields that are missing, blank or zero in each row."""
    tests = []
    for c in required:
        x = F.col(c)
        bad = x.isNull() | ((F.trim(x) == "") if is_string(df.schema[c]) else (x == 0))
        tests.append(F.when(bad, F.lit(c)))
    return df.withColumn(name, F.array_compact(F.array(*tests)))


# --------------------------------------------------------- sets and binding

def intersect(x: DataFrame, y: DataFrame) -> DataFrame:
    return x.intersect(y.select(*x.columns))


def union(x: DataFrame, y: DataFrame) -> DataFrame:
    return x.unionByName(y).distinct()


def setdiff(x: DataFrame, y: DataFrame) -> DataFrame:
    return x.subtract(y.select(*x.columns))


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def bind_rows(dfs, id: str | None = None) -> DataFrame:
    """Stack by name, absent columns are NA; a dict gives the value of ``id``."""
    parts = list(dfs.items()) if isinstance(dfs, dict) else [(str(i), d) for i, d in enumerate(dfs, 1)]
    frames = [d.select(F.lit(n).alias(id), "*") if id else d for n, d in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def bind_cols(x: DataFrame, y: DataFrame, order_x: list[str], order_y: list[str]) -> DataFrame:
    """Side by side by position under the given orders."""
    a, b = O.row_number(x, "__pos", order_x), O.row_number(y, "__pos", order_y)
    return a.join(b, "__pos", "full").drop("__pos")


def duplicated(df: DataFrame, keys: list[str], order: list[str], name: str = "duplicated") -> DataFrame:
    """False on the first row of each key, true on later ones."""
    return O.row_number(df, "__pos", order, keys).withColumn(name, F.col("__pos") > 1).drop("__pos")


def tied(df: DataFrame, keys: list[str], name: str = "tied") -> DataFrame:
    return O.recycle(df, keys, __n=F.count(F.lit(1))).withColumn(name, F.col("__n") > 1).drop("__n")


def collect_list_bounded(df: DataFrame, c: str) -> Column:
    """The values of a small column as one list Column; its rows are counted first."""
    limit = broadcast_rows(df.sparkSession)
    if df.limit(limit + 1).count() > limit:
        raise ValueError(f"more than {limit} rows")
    return df.agg(F.collect_list(c)).scalar()


def expand_grid(*dfs: DataFrame) -> DataFrame:
    """All combinations of the rows of the inputs, the product being what is asked for.

    Each later input is counted; up to the broadcast limit it is carried as one
    array and exploded next to each row, beyond it Spark pairs the partitions.
    """
    def add(left: DataFrame, right: DataFrame) -> DataFrame:
        limit = broadcast_rows(left.sparkSession)
        if right.limit(limit + 1).count() > limit:
            return left.crossJoin(right)
        rows = right.agg(F.collect_list(F.struct(*right.columns))).scalar()
        return left.withColumn("__row", F.explode(rows)).select(*left.columns, "__row.*")
    return reduce(add, dfs)


def crossing(*dfs: DataFrame) -> DataFrame:
    return expand_grid(*[d.distinct() for d in dfs])
