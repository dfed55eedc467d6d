"""Functions over list columns, all inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.functions.na import col

Fn = Callable[..., Column]


def arr_map(c, fn: Fn, kind: str | None = None) -> Column:
    out = F.transform(col(c), fn)
    return out.cast(f"array<{kind}>") if kind else out


def arr_imap(c, fn: Fn) -> Column:
    """fn(element, 1-based index)."""
    return F.transform(col(c), lambda x, i: fn(x, i + 1))


def arr_map2(a, b, fn: Fn) -> Column:
    return F.zip_with(col(a), col(b), fn)


def arr_pmap(cols: list[str], fn: Fn) -> Column:
    zipped = F.arrays_zip(*[col(c).alias(f"a{i}") for i, c in enumerate(cols)])
    return F.transform(zipped, lambda s: fn(*[s.getField(f"a{i}") for i in range(len(cols))]))


def arr_modify_if(c, pred: Fn, fn: Fn) -> Column:
    return F.transform(col(c), lambda x: F.when(pred(x), fn(x)).otherwise(x))


def arr_modify_at(c, positions: list[int], fn: Fn) -> Column:
    return F.transform(col(c), lambda x, i: F.when((i + 1).isin(positions), fn(x)).otherwise(x))


def arr_modify_depth(c, depth: int, fn: Fn) -> Column:
    if depth == 1:
        return F.transform(col(c), fn)
    return F.transform(col(c), lambda x: arr_modify_depth(x, depth - 1, fn))


def arr_keep(c, pred: Fn) -> Column:
    return F.filter(col(c), lambda x: F.coalesce(pred(x), F.lit(False)))


def arr_discard(c, pred: Fn) -> Column:
    return F.filter(col(c), lambda x: ~F.coalesce(pred(x), F.lit(False)))


def arr_compact(c) -> Column:
    return F.array_compact(col(c))


def arr_reduce(c, init, fn: Fn) -> Column:
    return F.reduce(col(c), init if isinstance(init, Column) else F.lit(init), fn)


def arr_reduce_right(c, init, fn: Fn) -> Column:
    return arr_reduce(F.reverse(col(c)), init, fn)


def arr_accumulate(c, init: Column, fn: Fn, kind: str) -> Column:
    """All intermediate values of the fold."""
    start = F.struct(init.cast(kind).alias("a"), F.array().cast(f"array<{kind}>").alias("o"))

    def step(s, x):
        nxt = fn(s["a"], x).cast(kind)
        return F.struct(nxt.alias("a"), F.array_append(s["o"], nxt).alias("o"))
    return F.reduce(col(c), start, step, lambda s: s["o"])


def arr_every(c, pred: Fn) -> Column:
    return F.forall(col(c), pred)


def arr_some(c, pred: Fn) -> Column:
    return F.exists(col(c), pred)


def arr_has(c, value) -> Column:
    return F.array_contains(col(c), value)


def arr_detect(c, pred: Fn) -> Column:
    return F.get(F.filter(col(c), pred), F.lit(0))


def arr_detect_index(c, pred: Fn) -> Column:
    """1-based index of the first match, 0 without one."""
    return F.array_position(F.transform(col(c), lambda x: F.coalesce(pred(x), F.lit(False))), True)


def _first_false(c: Column, pred: Fn) -> Column:
    at = F.array_position(F.transform(c, lambda x: F.coalesce(pred(x), F.lit(False))), False)
    return F.when(at == 0, F.size(c)).otherwise(at - 1).cast("int")


def arr_head_while(c, pred: Fn) -> Column:
    c = col(c)
    return F.slice(c, F.lit(1), _first_false(c, pred))


def arr_tail_while(c, pred: Fn) -> Column:
    return F.reverse(arr_head_while(F.reverse(col(c)), pred))


def arr_flatten(c) -> Column:
    return F.flatten(col(c))


def arr_prepend(c, value) -> Column:
    return F.array_prepend(col(c), value)


def arr_append(c, value) -> Column:
    return F.array_append(col(c), value)


def arr_insert(c, at: int, value) -> Column:
    return F.array_insert(col(c), at, value)


def arr_transpose(c, fields: list[str]) -> Column:
    """Array of structs to a struct of arrays."""
    def part(name: str) -> Column:
        return F.transform(col(c), lambda s: s.getField(name)).alias(name)
    return F.struct(*[part(f) for f in fields])


def pluck(c, *path, default=None) -> Column:
    """Deep get by field names and 1-based positions."""
    out = col(c)
    for p in path:
        out = F.get(out, F.lit(p - 1)) if isinstance(p, int) else out.getField(p)
    return out if default is None else F.coalesce(out, F.lit(default))


def vec_depth(kind: T.DataType) -> int:
    if isinstance(kind, T.ArrayType):
        return 1 + vec_depth(kind.elementType)
    if isinstance(kind, T.StructType):
        return 1 + max([vec_depth(f.dataType) for f in kind.fields], default=0)
    return 0


def arr_cross(a, b) -> Column:
    """All pairs of two lists of one row."""
    a, b = col(a), col(b)
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.struct(x.alias("x"), y.alias("y")))))


def arr_rev(c) -> Column:
    return F.reverse(col(c))


def arr_seq_along(c) -> Column:
    c = col(c)
    return F.when(F.size(c) > 0, F.sequence(F.lit(1), F.size(c))).otherwise(F.array().cast("array<int>"))


def arr_match(c, table: list) -> Column:
    """1-based position of each element in a list, NA when absent."""
    lookup = F.array(*[F.lit(v) for v in table])
    return F.transform(col(c), lambda x: F.nullif(F.array_position(lookup, x), F.lit(0).cast("bigint")))


def arr_unique(c) -> Column:
    return F.array_distinct(col(c))


def to_columns(df: DataFrame, c: str, names: list[str]) -> DataFrame:
    """List cells to one column per position, missing positions NA."""
    return df.select("*", *[F.get(c, F.lit(i)).alias(n) for i, n in enumerate(names)]).drop(c)


def unbox(c) -> Column:
    """Array of length one to its value; other lengths are NA."""
    c = col(c)
    return F.when(F.size(c) == 1, F.get(c, F.lit(0)))
