"""User functions: per group, per window, per partition, and named queries."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.operators import ordered as O
from cohortspark.session import hot_rows


# Chunks of a group that has fewer rows than so many full ones.
CHUNKS = 4

# A long group that may be cut comes in frames of about so many rows: several Python workers of an executor hold one each.
FRAME_ROWS = 100_000

# Rows that go to Python at a time when many small groups share a trip.
BUCKET_ROWS = 20_000


def _check_groups(df: DataFrame, by: list[str], limit: int) -> DataFrame | None:
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    return None if sizes.isEmpty() else sizes


def group_apply(df: DataFrame, by: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                combine: Callable[[pd.DataFrame], pd.DataFrame] | None = None, max_rows: int | None = None) -> DataFrame:
    """Any function of a group's rows.

    With ``combine`` every group, small or large, is cut into chunks: ``fn`` runs
    on each chunk and ``combine`` on the stacked chunk results, so the answer
    does not depend on a limit, and a ``combine`` that does not fit shows at any
    size. Without it a group is one pandas frame in one task, and one above the
    row limit raises.
    """
    limit = max_rows or hot_rows(df.sparkSession)
    if combine is None:
        if _check_groups(df, by, limit) is not None:
            raise ValueError(f"a group has more than {limit} rows; pass combine")
        return df.groupBy(*by).applyInPandas(fn, schema)
    limit = min(limit, FRAME_ROWS)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    # the chunk follows from the values, so a task that runs again gives the same one
    spread = F.pmod(F.xxhash64(*df.columns), F.greatest(F.lit(CHUNKS).cast("bigint"), F.ceil(F.col("__n") / limit * 1.25)))
    chunks = O.attach(df, sizes, by).withColumn("__chunk", spread).drop("__n")
    part = chunks.groupBy(*by, "__chunk").applyInPandas(lambda p: fn(p.drop(columns="__chunk")), schema)
    return part.groupBy(*by).applyInPandas(combine, schema)


# Kinds of columns of which a stretch of a frame is the frame that Spark makes of those rows, but for missing whole numbers and booleans.
_PLAIN = (T.IntegralType, T.BooleanType, T.FloatType, T.DoubleType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
_FLAG = "__null_"


def _stretches(p: pd.DataFrame, code: np.ndarray, flags: list[str]) -> dict[int, pd.DataFrame]:
    """The rows of each key code; columns with missing values in these rows as Spark hands them over for these rows alone."""
    order = np.argsort(code, kind="stable")
    p, code = p.take(order).reset_index(drop=True), code[order]
    found, missing = {}, {f: p.pop(f).to_numpy(bool) for f in flags}
    missing = {f.removeprefix(_FLAG): m for f, m in missing.items() if m.any()}
    edges = np.append(np.flatnonzero(np.append(True, code[1:] != code[:-1])), len(code)) if len(code) else np.array([0])
    for a, b in zip(edges[:-1], edges[1:]):
        own = p.iloc[a:b].reset_index(drop=True)
        for c, m in missing.items():
            if m[a:b].any():
                kind = "object" if own[c].dtype == bool else "float64"
                own[c] = own[c].astype(kind).mask(m[a:b], None if kind == "object" else np.nan)
        found[int(code[a])] = own
    return found


def _stack(frames: list[pd.DataFrame]) -> pd.DataFrame:
    """Results of many keys as one frame; a column that has not one kind throughout keeps its values as they are."""
    some = [f for f in frames if len(f)]
    if not some:
        return next((f for f in frames if len(f.columns)), pd.DataFrame())
    kinds: dict = {}
    for f in some:
        for c, kind in zip(f.columns, f.dtypes):
            kinds.setdefault(c, set()).add(kind)
    mixed = [c for c, k in kinds.items() if len(k) > 1]
    return pd.concat([f.astype({c: "object" for c in mixed if c in f}) for f in some] if mixed else some, ignore_index=True)


def group_pairs_apply(x: DataFrame, y: DataFrame, by: list[str], fn, schema: str, max_rows: int | None = None) -> DataFrame:
    """A function of the two frames that share a key.

    ``fn`` runs once per key. Keys go to Python by the bucket, some ten thousand
    rows at a time, since a trip of its own for each of many small groups would
    take longer than the work on it.
    """
    limit = max_rows or hot_rows(x.sparkSession)
    total = 0
    for df in (x, y):
        rows, largest = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).agg(F.sum("__n"), F.max("__n")).first()
        if (largest or 0) > limit:
            raise ValueError(f"a group has more than {limit} rows")
        total += rows or 0
    if not all(isinstance(f.dataType, _PLAIN) for df in (x, y) for f in df.schema) or [x.schema[b].dataType for b in by] != [y.schema[b].dataType for b in by]:
        return x.groupBy(*by).cogroup(y.groupBy(*by)).applyInPandas(fn, schema)
    buckets = total // BUCKET_ROWS + 1

    def ready(df: DataFrame) -> tuple[DataFrame, list[str]]:
        whole = [f.name for f in df.schema if isinstance(f.dataType, (T.IntegralType, T.BooleanType))]
        flags = [c for c in dict.fromkeys([*whole, *by])]
        fill = lambda c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)).alias(c) if c in whole else F.col(c)
        return df.select(*[fill(c) for c in df.columns], *[F.col(c).isNull().alias(_FLAG + c) for c in flags],
                         F.pmod(F.xxhash64(*by), F.lit(buckets)).alias("__bucket")), [_FLAG + c for c in flags]

    (left, left_flags), (right, right_flags) = ready(x), ready(y)
    ids = [*by, *[_FLAG + b for b in by]]

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.drop(columns="__bucket"), b.drop(columns="__bucket")
        code = pd.concat([a[ids], b[ids]], ignore_index=True).groupby(ids, dropna=False, sort=False).ngroup().to_numpy()
        ones, others = _stretches(a, code[:len(a)], left_flags), _stretches(b, code[len(a):], right_flags)
        none, nothing = (p.drop(columns=f).iloc[:0] for p, f in ((a, left_flags), (b, right_flags)))
        return _stack([fn(ones.get(k, none), others.get(k, nothing)) for k in dict.fromkeys([*ones, *others])])

    return left.groupBy("__bucket").cogroup(right.groupBy("__bucket")).applyInPandas(run, schema)


@dataclass(frozen=True)
class Carry:
    """What a piece of a long group hands on: ``summarise(rows)`` gives its state, ``merge(before, piece)`` the state behind both."""

    summarise: Callable[[pd.DataFrame], object]
    merge: Callable[[object, object], object]


def _carried_window(df: DataFrame, by: list[str], order: list[str], fn: Callable, name: str, schema: T.StructType, carry: Carry) -> DataFrame:
    """Groups of more rows than a frame should have in pieces: their states first, merged in order, then every piece with the state before it."""
    lay = O.layout(df, by, order, bounded=True, limit=min(hot_rows(df.sparkSession), FRAME_ROWS))
    keys, up = [o.removeprefix("-") for o in order], [not o.startswith("-") for o in order]
    rows, key = lay.df, [*lay.by, O.PIECE]
    in_order = lambda p: p.sort_values(keys, ascending=up).reset_index(drop=True)
    columns = df.columns

    if lay.hot:
        state_schema = T.StructType([*rows.select(*key).schema.fields, T.StructField("__state", T.BinaryType())])

        def summary(p: pd.DataFrame) -> pd.DataFrame:
            return p[key].head(1).assign(__state=[pickle.dumps(carry.summarise(in_order(p)[columns]))])

        def add_up(p: pd.DataFrame) -> pd.DataFrame:
            p, before = p.sort_values(O.PIECE).reset_index(drop=True), []
            state = None
            for own in map(pickle.loads, p["__state"]):
                before.append(None if state is None else pickle.dumps(state))
                state = own if state is None else carry.merge(state, own)
            return p.assign(__state=before)

        states = lay.split_rows().groupBy(*key).applyInPandas(summary, state_schema)
        states = states.groupBy(*lay.by).applyInPandas(add_up, state_schema)  # a row per piece
        rows = O.attach(rows, states, key)
    else:
        rows = rows.withColumn("__state", F.lit(None).cast("binary"))

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = in_order(p)
        state, own = p["__state"].iloc[0], p[columns]
        return own.assign(**{name: fn(own, None if state is None else pickle.loads(state))})

    return rows.groupBy(*key).applyInPandas(run, schema)


def window_apply(df: DataFrame, by: list[str], order: list[str], fn: Callable[..., pd.Series], name: str,
                 kind: str, max_rows: int | None = None, carry: Carry | None = None) -> DataFrame:
    """A custom window function: the ordered rows of a group to one value per row.

    With ``carry`` a group of any size is handled: ``fn(rows, state)`` gets a piece
    of the group and the state of all rows before it (None if there are none).
    Without it ``fn(rows)`` gets the whole group, and one above the limit raises.
    """
    if carry:
        schema = T.StructType([*df.schema.fields, T.StructField(name, T._parse_datatype_string(kind))])
        return _carried_window(df, by, order, fn, name, schema, carry)
    limit = max_rows or hot_rows(df.sparkSession)
    if _check_groups(df, by, limit) is not None:
        raise ValueError(f"a group has more than {limit} rows")
    keys, up = [o.removeprefix("-") for o in order], [not o.startswith("-") for o in order]

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(keys, ascending=up).reset_index(drop=True)
        return p.assign(**{name: fn(p)})

    schema = T.StructType([*df.schema.fields, T.StructField(name, T._parse_datatype_string(kind))])
    return df.groupBy(*by).applyInPandas(run, schema)


def page_apply(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A function over pages of rows, no grouping: each Arrow batch is a page."""
    def run(pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for page in pages:
            yield fn(page)
    return df.mapInPandas(run, schema)


def custom_agg(df: DataFrame, by: list[str], c: str, name: str, fn: Callable[[pd.Series], object],
               merge: Callable[[pd.Series], object], kind: str = "double") -> DataFrame:
    """An aggregate written over pandas Series.

    ``merge`` turns the results of chunks into the result of the group. It always
    runs, so ``fn`` must be one that can be merged; use ``quantiles`` for a median.
    """
    def one(p: pd.DataFrame, f, source: str) -> pd.DataFrame:
        return pd.DataFrame({**{b: [p[b].iloc[0]] for b in by}, name: [f(p[source])]})

    schema = T.StructType([*[df.schema[b] for b in by], T.StructField(name, T._parse_datatype_string(kind))])
    return group_apply(df.select(*by, c), by, lambda p: one(p, fn, c), schema, lambda p: one(p, merge, name))


def iterate(df: DataFrame) -> Iterator:
    """Rows one partition at a time on the driver."""
    return df.toLocalIterator(prefetchPartitions=True)


def run_sql(spark: SparkSession, sql: str, _tables: dict[str, DataFrame] | None = None, **args) -> DataFrame:
    """SQL with bound values; they are never pasted into the text."""
    for name, df in (_tables or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args)


def run_many(fns: dict[str, Callable[[DataFrame], DataFrame]], df: DataFrame, id: str = "name") -> DataFrame:
    """Call each function on the table and stack the results in one plan."""
    from cohortspark.operators.verbs import bind_rows
    return bind_rows({n: f(df) for n, f in fns.items()}, id)


class QueryBook:
    """Named, parameterised queries over tables, with filters that run before the body."""

    def __init__(self):
        self._filters: list[tuple[str, Callable]] = []
        self._queries: dict[str, tuple[Callable, tuple[str, ...]]] = {}

    def filter(self, name: str):
        def add(fn):
            self._filters.append((name, fn))
            return fn
        return add

    def query(self, name: str, skip: tuple[str, ...] = ()):
        def add(fn):
            self._queries[name] = (fn, skip)
            return fn
        return add

    def run(self, name: str, df: DataFrame, **params) -> DataFrame:
        """Filters in order, each may change the table or the parameters, then the body."""
        fn, skip = self._queries[name]
        for label, step in self._filters:
            if label not in skip:
                df, params = step(df, params)
        return fn(df, **params)


def safe_apply(expr: Column, fallback: Column | None = None) -> Column:
    """Result and error text of an expression whose failure is NA (the ``try_`` functions)."""
    value = F.coalesce(expr, fallback) if fallback is not None else expr
    return F.struct(value.alias("result"), F.when(expr.isNull(), F.lit("failed")).alias("error"))
