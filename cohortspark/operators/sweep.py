"""Interval joins by a plane sweep over split time lines.

The start points of both sides lie on one line per group of ``by``. Long lines
are cut at sampled points (operators/ordered.py), so that a piece is one task's
work however long the line is. An interval belongs to the piece it starts in; one
that reaches beyond a cut is also handed to the pieces it crosses, all others are
not copied. Where no line is long, nothing is cut.

Two intervals that share a point do so first where the later one of them starts.
In a piece the starts are sorted once, and an interval's partners are the starts
between its own ends: a stretch of the sorted line, found by binary search. So
each pair is built once, in the piece in which the later one starts, and nothing
else is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.operators import ordered as O

BLOCK_ROWS = 100_000
OUT_ROWS = 50_000


def line_value(df: DataFrame, name: str) -> Column:
    """Times as whole microseconds, whole numbers as they are, others as doubles."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)):
        return F.unix_micros(c.cast("timestamp"))
    return c.cast("bigint") if isinstance(kind, T.IntegralType) else c.cast("double")


def starts_inside(line: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, after: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each interval (low, high) the first of the sorted starts inside it, and how many; ``after`` leaves out those at low."""
    a = np.searchsorted(line[order], low, "right" if after else "left")
    return a, np.maximum(np.searchsorted(line[order], high, "right") - a, 0)


def pairs(group: np.ndarray, left: np.ndarray, own: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(left row, right row) for all that share a point of their group, some at a time; ``own`` rows start in this piece."""
    values, rank = np.unique(np.concatenate((start, end)), return_inverse=True)
    low, high = (group * len(values) + r for r in (rank[:len(start)], rank[len(start):]))
    a, b = np.flatnonzero(left), np.flatnonzero(~left)
    # the right one starts inside the left one, or the left one inside the right one and later
    for span, point, after, swap in ((a, b[own[b]], False, False), (b, a[own[a]], True, True)):
        order = np.argsort(low[point], kind="stable")
        first, count = starts_inside(low[point], order, low[span], high[span], after)
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        for k in range(0, total, OUT_ROWS):
            at = np.arange(k, min(total, k + OUT_ROWS))
            i = np.searchsorted(ends, at, "right")
            one, other = span[i], point[order[first[i] + at - (ends[i] - count[i])]]
            yield (other, one) if swap else (one, other)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by __h and __p: blocks of whole groups are joined."""
    held: list[pa.RecordBatch] = []

    def join(table: pa.Table):
        table = table.combine_chunks()
        column = lambda c: table.column(c).chunk(0) if table.num_rows else table.column(c)
        number = lambda c: column(c).to_numpy(zero_copy_only=False)
        h, p = number("__h"), number("__p")
        group = np.cumsum(np.append(False, (h[1:] != h[:-1]) | (p[1:] != p[:-1])))
        x, y = column("x"), column("y")
        for one, other in pairs(group, number("__left"), number("__own"), number("__a"), number("__b")):
            yield pa.RecordBatch.from_arrays([x.take(pa.array(one)), y.take(pa.array(other))], ["x", "y"])

    fresh = 0  # rows since the last cut was looked for
    for batch in batches:
        held.append(batch)
        fresh += batch.num_rows
        if fresh < BLOCK_ROWS:
            continue
        table, fresh = pa.Table.from_batches(held), 0
        h, p = table.column("__h").to_numpy(), table.column("__p").to_numpy()
        cut = np.flatnonzero((h[1:] != h[:-1]) | (p[1:] != p[:-1]))
        if len(cut):  # the last group may go on
            yield from join(table.slice(0, cut[-1] + 1))
            held = table.slice(cut[-1] + 1).to_batches()
    if held:
        yield from join(pa.Table.from_batches(held))


def overlapping(x: DataFrame, y: DataFrame, x_span: tuple[str, str], y_span: tuple[str, str], by: list[str] | None = None) -> DataFrame:
    """x, y (structs): all pairs of rows that share ``by`` (missing values match each other) and a point of their closed intervals.

    Rows with a missing end, or one before the start, have no partner.
    """
    by = list(by or [])
    sides = [(x, x_span, True), (y, y_span, False)]
    # keys of both sides as one type, so that equal ones have equal hashes
    kinds = {f.name: f.dataType for f in x.select(*by).unionByName(y.select(*by)).schema} if by else {}
    ready = []
    for df, (start, end), left in sides:
        ready.append(df.select(
            F.xxhash64(F.lit(0), *[F.col(c).cast(kinds[c]) for c in by]).alias("__h"), F.lit(left).alias("__left"), line_value(df, start).alias("__a"),
            line_value(df, end).alias("__b"), F.struct("*").alias("x" if left else "y")).where("__a <= __b"))
    if len({f.dataType for df in ready for f in df.schema if f.name in ("__a", "__b")}) > 1:
        ready = [df.withColumns({"__a": F.col("__a").cast("double"), "__b": F.col("__b").cast("double")}) for df in ready]
    lay = O.layout(ready[0].select("__h", "__a").unionByName(ready[1].select("__h", "__a")), ["__h"], ["__a"], bounded=True)
    line = ready[0].withColumn("y", F.lit(None).cast(ready[1].schema["y"].dataType)).unionByName(
        ready[1].withColumn("x", F.lit(None).cast(ready[0].schema["x"].dataType)))
    if lay.hot:
        line = O.attach(line, lay.bounds, ["__h"], small=True)
        longest = lay.bounds.agg(F.max(F.size("__splits"))).first()[0] or 1
        first, last = (O.piece_of(F.col("__splits"), line, c, longest) for c in ("__a", "__b"))
        line = line.withColumns({"__first": first, "__last": last}).withColumn("__p", F.explode(F.sequence("__first", "__last")))
        line = line.withColumn("__own", F.col("__p") == F.col("__first")).drop("__splits", "__first", "__last")
        line = line.repartition("__h", "__p")
    else:
        line = line.withColumns({"__p": F.lit(0), "__own": F.lit(True)}).repartition("__h")
    line = line.sortWithinPartitions("__h", "__p")
    return line.mapInArrow(_sweep, line.select("x", "y").schema)
