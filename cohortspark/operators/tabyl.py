"""Frequency tables and their decorations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.operators import ordered as O
from cohortspark.operators.verbs import crossing

MAX_LEVELS = 10_000  # one output column each
NA_NAME = "NA_"


def levels_of(df: DataFrame, c: str, levels: list | None = None) -> list:
    """Sorted distinct values, NA last; they become columns, so their number has a limit."""
    if levels is not None:
        return list(levels)
    found = [r[0] for r in df.select(c).distinct().limit(MAX_LEVELS + 1).collect()]
    if len(found) > MAX_LEVELS:
        raise ValueError(f"{c} has more than {MAX_LEVELS} levels")
    return sorted((v for v in found if v is not None)) + ([None] if None in found else [])


def _name(level) -> str:
    return str(int(level)) if isinstance(level, float) and level.is_integer() else str(level)


def column_names(levels: list) -> list[str]:
    """A column name for each level; NA gets one that no level has."""
    named = [_name(v) for v in levels if v is not None]
    na = NA_NAME
    while na in named:
        na += "_"
    return [na if v is None else _name(v) for v in levels]


def tabyl(df: DataFrame, a: str, b: str | None = None, c: str | None = None, show_na: bool = True,
          levels: list | None = None, show_missing_levels: bool = True) -> DataFrame:
    """Counts of one, two or three columns.

    One way: n, percent and valid_percent (NA left out). Two ways: one column
    per level of ``b``. Three ways: the same with ``c`` kept as a leading key.
    """
    if not show_na:
        for k in filter(None, (a, b, c)):
            df = df.where(F.col(k).isNotNull())
    if b is None:
        return tabyl_one(df.groupBy(a).agg(F.count(F.lit(1)).alias("n")), a)
    found = levels_of(df, b, levels)
    keys = [c, a] if c else [a]
    names = column_names(found)
    cells = df.groupBy(*keys, b).agg(F.count(F.lit(1)).alias("__n"))
    wide = cells.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col(b).eqNullSafe(F.lit(v)), F.col("__n"))), F.lit(0)).alias(n) for v, n in zip(found, names)])
    if c and show_missing_levels:
        grid = crossing(df.select(c), df.select(a))
        wide = O.attach(grid, wide, [c, a]).fillna(0, names)
    return wide


def tabyl_one(counts: DataFrame, a: str) -> DataFrame:
    total = F.sum("n")
    valid = F.sum(F.when(F.col(a).isNotNull(), F.col("n")))
    out = O.recycle(counts, None, __t=total, __v=valid)
    return out.select(a, "n", (F.col("n") / F.col("__t")).alias("percent"),
                      F.when(F.col(a).isNotNull(), F.col("n") / F.col("__v")).alias("valid_percent"))


def tabyl_long(df: DataFrame, a: str, b: str, c: str | None = None, show_na: bool = True, share: str | None = None) -> DataFrame:
    """The cross table with a row per cell that occurs, for any number of levels.

    ``share`` adds the cell's part of its row (a), column (b) or of the whole table,
    three ways within each ``c``. Cells that do not occur are not listed.
    """
    keys = [k for k in (c, a, b) if k]
    if not show_na:
        for k in keys:
            df = df.where(F.col(k).isNotNull())
    cells = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if share is None:
        return cells
    outer = [c] if c else []
    by = {"row": [*outer, a], "col": [*outer, b], "all": outer}[share]
    return O.recycle(cells, by, __t=F.sum("n")).withColumn("share", F.col("n") / F.col("__t")).drop("__t")


def crosstab(df: DataFrame, a: str, b: str, levels: list | None = None) -> DataFrame:
    return tabyl(df, a, b, levels=levels)


def number_columns(df: DataFrame, label: str) -> list[str]:
    return [f.name for f in df.schema.fields if f.name != label and isinstance(f.dataType, T.NumericType)]


def adorn_totals(df: DataFrame, where: str | tuple = "row", label: str | None = None, name: str = "Total",
                 by: list[str] | None = None) -> DataFrame:
    """Total row, total column or both; ``by`` gives one total row per table of a three-way result."""
    label = label or df.columns[len(by or [])]
    where = (where,) if isinstance(where, str) else where
    by = list(by or [])
    cols = [c for c in number_columns(df, label) if c not in by]
    out = df
    if "col" in where:
        out = out.withColumn(name, reduce(lambda p, q: p + q, [F.col(c) for c in cols]))
        cols = cols + [name]
    if "row" in where:
        out = out.withColumn(label, F.col(label).cast("string"))
        total = out.groupBy(*by).agg(*[F.sum(c).cast(out.schema[c].dataType).alias(c) for c in cols]).withColumn(label, F.lit(name))
        out = out.unionByName(total, allowMissingColumns=True)
    return out


def adorn_percentages(df: DataFrame, denom: str = "row", label: str | None = None) -> DataFrame:
    """Counts to shares of the row, the column or the whole table."""
    label = label or df.columns[0]
    cols = number_columns(df, label)
    total = reduce(lambda p, q: p + q, [F.col(c) for c in cols])
    if denom == "row":
        return df.withColumns({c: F.col(c) / total for c in cols})
    if denom == "col":
        out = O.recycle(df, None, **{f"__{c}": F.sum(c) for c in cols})
        return out.withColumns({c: F.col(c) / F.col(f"__{c}") for c in cols}).drop(*[f"__{c}" for c in cols])
    out = O.recycle(df, None, __all=F.sum(total))
    return out.withColumns({c: F.col(c) / F.col("__all") for c in cols}).drop("__all")


def rounded(c: Column, digits: int, rounding: str) -> Column:
    if rounding == "half up":
        return F.round(c, digits)
    return F.bround(c, digits)


def pct_text(c: Column, digits: int = 1, rounding: str = "half to even") -> Column:
    dec = rounded((c * 100).cast("decimal(38,12)"), digits, rounding)
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.format_string(f"%.{digits}f", dec.cast("double")), F.lit("%")))


def adorn_pct_formatting(df: DataFrame, digits: int = 1, rounding: str = "half to even", label: str | None = None) -> DataFrame:
    label = label or df.columns[0]
    return df.withColumns({c: pct_text(F.col(c), digits, rounding) for c in number_columns(df, label)})


def adorn_rounding(df: DataFrame, digits: int = 1, rounding: str = "half to even", label: str | None = None) -> DataFrame:
    label = label or df.columns[0]
    return df.withColumns({c: rounded(F.col(c), digits, rounding) for c in number_columns(df, label)})


def adorn_ns(df: DataFrame, ns: DataFrame, position: str = "rear", label: str | None = None) -> DataFrame:
    """Put the counts next to the text cells: ``50.0% (6)``."""
    label = label or df.columns[0]
    cols = number_columns(ns, label)
    both = O.attach(df, ns.select(label, *[F.col(c).alias(f"__{c}") for c in cols]), [label])
    cell = (lambda c: F.concat(F.col(c), F.lit(" ("), F.col(f"__{c}").cast("bigint").cast("string"), F.lit(")"))) if position == "rear" else (
        lambda c: F.concat(F.col(f"__{c}").cast("bigint").cast("string"), F.lit(" ("), F.col(c), F.lit(")")))
    return both.withColumns({c: cell(c) for c in cols}).select(*df.columns)


def adorn_title(df: DataFrame, row_name: str, col_name: str) -> DataFrame:
    """Combined title in the name of the first column."""
    return df.withColumnRenamed(df.columns[0], f"{row_name}/{col_name}")


def top_levels(df: DataFrame, c: str, levels: list[str], n: int = 2, show_na: bool = False) -> DataFrame:
    """Counts of an ordered category in its first n, middle and last n levels."""
    if not show_na:
        df = df.where(F.col(c).isNotNull())
    if n < 1 or 2 * n > len(levels):
        raise ValueError("n does not fit the number of levels")
    bands = [levels[:n], levels[n:-n], levels[-n:]]
    names = [", ".join(b) for b in bands if b]
    expr = F
    for band in bands:
        if band:
            expr = expr.when(F.col(c).isin(band), F.lit(", ".join(band)))
    counts = df.groupBy(expr.otherwise(None).alias(c)).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.createDataFrame([(v,) for v in names], f"`{c}` string")
    full = O.attach(frame, counts, [c]).fillna(0, ["n"])
    if show_na:
        full = full.unionByName(counts.where(F.col(c).isNull()))
    return O.recycle(full, None, __t=F.sum("n")).withColumn("percent", F.col("n") / F.col("__t")).drop("__t")


def add_margins(df: DataFrame, keys: list[str], all_label: str = "(all)", **aggs: Column) -> DataFrame:
    """Aggregate over the keys and over every subset of them."""
    ids = [F.grouping(k).alias(f"__g_{k}") for k in keys]
    cube = df.cube(*keys).agg(*[a.alias(n) for n, a in aggs.items()], *ids)
    cells = [F.when(F.col(f"__g_{k}") == 1, F.lit(all_label)).otherwise(F.col(k).cast("string")).alias(k) for k in keys]
    return cube.select(*cells, *aggs)
