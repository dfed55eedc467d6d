"""Ordered categories: a column and its levels, as a list or as a table.

Level tables (the column and ``level``, from 1) are numbered on the cluster and
joined, so a category may have as many levels as rows. Level lists are short cuts
for few levels: they live on the driver and are checked against the same limit as
the columns of a cross table. What reorders levels takes either.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.functions.na import col
from cohortspark.operators import ordered as O
from cohortspark.operators.tabyl import MAX_LEVELS


def _listed(df: DataFrame, c: str) -> list[str]:
    rows = df.limit(MAX_LEVELS + 1).collect()
    if len(rows) > MAX_LEVELS:
        raise ValueError(f"{c} has more than {MAX_LEVELS} levels")
    return [r[c] for r in rows]


def levels_inorder(df: DataFrame, c: str, order: str) -> list[str]:
    """By first appearance in ``order``."""
    return _listed(df.where(F.col(c).isNotNull()).groupBy(c).agg(F.min(order).alias("__o")).orderBy("__o", c), c)


def levels_infreq(df: DataFrame, c: str) -> list[str]:
    return _listed(fct_count(df.where(F.col(c).isNotNull()), c).orderBy(F.desc("n"), c), c)


Levels = list | DataFrame


def table_inorder(df: DataFrame, c: str, order: str) -> DataFrame:
    """Level table by first appearance in ``order``."""
    first = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.min(order).alias("__o"))
    return O.row_number(first, "level", ["__o", c]).drop("__o")


def table_infreq(df: DataFrame, c: str) -> DataFrame:
    """Level table, most frequent first."""
    return O.row_number(fct_count(df.where(F.col(c).isNotNull()), c), "level", ["-n", c]).drop("n")


def table_sorted(df: DataFrame, c: str) -> DataFrame:
    """Level table in the order of the values."""
    return O.row_number(fct_unique(df, c), "level", [c])


def level_table(levels: Levels, df: DataFrame, c: str) -> DataFrame:
    """A list of levels as a table; the first of equal levels counts."""
    if isinstance(levels, DataFrame):
        return levels
    rows = [(v, i) for i, v in enumerate(dict.fromkeys(v for v in levels if v is not None), 1)]
    return df.sparkSession.createDataFrame(rows, T.StructType([T.StructField(c, df.schema[c].dataType), T.StructField("level", T.LongType())]))


def as_factor(df: DataFrame, c: str, order: str) -> DataFrame:
    """Add the level number of each value, however many there are."""
    return level_number(df, c, table_inorder(df, c, order))


def level_number(df: DataFrame, c: str, levels: Levels, name: str | None = None) -> DataFrame:
    """Add the number of each value's level; NA for a value that is no level."""
    table = level_table(levels, df, c)
    found = O.attach(df, table.select(c, F.col("level").cast("bigint").alias("__level")), [c], small=not isinstance(levels, DataFrame))
    return found.withColumn(name or f"{c}_level", F.col("__level")).drop("__level")


def order_by_levels(df: DataFrame, c: str, levels: Levels) -> DataFrame:
    return level_number(df, c, levels, "__l").orderBy(F.col("__l").asc_nulls_last()).drop("__l")


def fct_count(df: DataFrame, c: str, sort: bool = False) -> DataFrame:
    out = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.desc("n"), c) if sort else out


def fct_unique(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).where(F.col(c).isNotNull()).distinct()


def fct_lump(df: DataFrame, c: str, n: int | None = None, prop: float | None = None, w: str | None = None,
             other: str = "Other") -> DataFrame:
    """Merge levels into Other: all but the n most (or, negative, least) frequent, or those below a share.

    Ties at the edge are kept. NA stays NA and counts in the total.
    """
    weight = F.count(F.lit(1)) if w is None else F.sum(w)
    counts = df.groupBy(c).agg(weight.alias("__w"))
    if n is not None:
        known = counts.where(F.col(c).isNotNull())
        ranked = O.ranks(known, "__w", desc=n > 0, min_rank="__r")
        kept = ranked.where(F.col("__r") <= abs(n))
    else:
        share = O.recycle(counts, None, __t=F.sum("__w")).withColumn("__p", F.col("__w") / F.col("__t"))
        kept = share.where(F.col(c).isNotNull()).where(F.col("__p") > prop if prop >= 0 else F.col("__p") <= -prop)
    marked = O.attach(df, kept.select(c, F.lit(True).alias("__keep")), [c])
    return marked.withColumn(c, F.when(F.col(c).isNull() | F.col("__keep"), F.col(c)).otherwise(other)).drop("__keep")


def fct_other(c, keep: list[str] | None = None, drop: list[str] | None = None, other: str = "Other") -> Column:
    c = col(c)
    bad = ~c.isin(keep) if keep is not None else c.isin(drop)
    return F.when(bad, F.lit(other)).otherwise(c)


def fct_recode(c, **new_old: str) -> Column:
    """new="old" pairs."""
    c = col(c)
    out = F.when(c.isNull(), None)
    for new, old in new_old.items():
        out = out.when(c == old, F.lit(new))
    return out.otherwise(c)


def fct_collapse(c, groups: dict[str, list[str]]) -> Column:
    c = col(c)
    out = F.when(c.isNull(), None)
    for new, olds in groups.items():
        out = out.when(c.isin(olds), F.lit(new))
    return out.otherwise(c)


def fct_relabel(c, fn: Callable[[Column], Column]) -> Column:
    return fn(col(c))


def _name_of(table: DataFrame) -> str:
    return next(c for c in table.columns if c != "level")


def fct_relevel(levels: Levels, *first: str, after: int = 0) -> Levels:
    """Move some levels to the front, or behind the first ``after`` others."""
    if isinstance(levels, DataFrame):
        c = _name_of(levels)
        moved = level_table(list(first), levels, c).select(c, F.col("level").alias("__at"))
        split = O.attach(levels, moved, [c], small=True)
        rest = O.row_number(split.where(F.col("__at").isNull()), "__n", ["level"])
        behind = F.col("__n") + F.when(F.col("__n") > after, F.lit(split.where(F.col("__at").isNotNull()).count())).otherwise(0)
        front = O.row_number(split.where(F.col("__at").isNotNull()), "__n", ["__at"])
        before = F.least(F.lit(after), F.lit(rest.count()))
        return rest.select(c, behind.alias("level")).unionByName(front.select(c, (F.col("__n") + before).alias("level")))
    rest = [v for v in levels if v not in first]
    return rest[:after] + list(first) + rest[after:]


def _with_count(table: DataFrame) -> DataFrame:
    return O.recycle(table, None, __t=F.count(F.lit(1)))


def fct_rev(levels: Levels) -> Levels:
    if isinstance(levels, DataFrame):
        return _with_count(levels).withColumn("level", F.col("__t") + 1 - F.col("level")).drop("__t")
    return levels[::-1]


def fct_shift(levels: Levels, n: int = 1) -> Levels:
    if isinstance(levels, DataFrame):
        return _with_count(levels).withColumn("level", F.pmod(F.col("level") - 1 - n, F.col("__t")) + 1).drop("__t")
    n %= max(len(levels), 1)
    return levels[n:] + levels[:n]


def fct_shuffle(levels: Levels, seed: int = 0) -> Levels:
    if isinstance(levels, DataFrame):
        c = _name_of(levels)
        return O.row_number(levels.select(c, F.xxhash64(F.lit(seed), F.col(c)).alias("__h")), "level", ["__h", c]).drop("__h")
    import random
    out = list(levels)
    random.Random(seed).shuffle(out)
    return out


def fct_reorder(df: DataFrame, c: str, x: str, fn: Callable[[str], Column] | None = None, desc: bool = False) -> DataFrame:
    """Levels with their place by a summary of another column (exact median by default)."""
    known = df.where(F.col(c).isNotNull())
    table = known.groupBy(c).agg(fn(x).alias("value")) if fn else O.quantiles(known, x, {"value": 0.5}, [c])
    return O.row_number(table, "level", [("-" if desc else "") + "value", c])


def fct_reorder2(df: DataFrame, c: str, x: str, y: str) -> DataFrame:
    """Levels by the y value at the largest x, largest first."""
    known = df.where(F.col(c).isNotNull() & F.col(x).isNotNull())
    table = known.groupBy(c).agg(F.max(F.struct(x, y))[y].alias("value"))
    return O.row_number(table, "level", ["-value", c])


def fct_explicit_na(c, level: str = "(Missing)") -> Column:
    return F.coalesce(col(c), F.lit(level))


def fct_drop(df: DataFrame, c: str, levels: Levels) -> Levels:
    """Levels that occur."""
    if isinstance(levels, DataFrame):
        return O.row_number(levels.join(fct_unique(df, c), c, "left_semi").withColumnRenamed("level", "__old"), "level", ["__old"]).drop("__old")
    present = set(_listed(fct_unique(df.where(F.col(c).isin(levels)), c), c))
    return [v for v in levels if v in present]


def fct_expand(levels: Levels, *more: str) -> Levels:
    if isinstance(levels, DataFrame):
        return lvls_union(levels, level_table(list(more), levels, _name_of(levels)))
    return levels + [v for v in more if v not in levels]


def lvls_union(*levels: Levels) -> Levels:
    """All levels, those of the first first; lists or tables with the same column name."""
    if any(isinstance(v, DataFrame) for v in levels):
        tables = [v for v in levels if isinstance(v, DataFrame)]
        c = _name_of(tables[0])
        stacked = reduce(lambda a, b: a.unionByName(b), [
            level_table(v, tables[0], c).select(c, F.struct(F.lit(i).alias("i"), F.col("level").cast("bigint").alias("level")).alias("__o")) for i, v in enumerate(levels)])
        first = stacked.groupBy(c).agg(F.min("__o").alias("__o")).select(c, "__o.*").withColumnRenamed("level", "__l")
        return O.row_number(first, "level", ["i", "__l"]).drop("i", "__l")
    return list(dict.fromkeys(v for ls in levels for v in ls))


def fct_c(dfs: list[DataFrame], c: str, levels: list[list[str]]) -> tuple[DataFrame, list[str]]:
    """Stack columns and unite their levels."""
    return reduce(lambda a, b: a.unionByName(b), [d.select(c) for d in dfs]), lvls_union(*levels)


def fct_anon(df: DataFrame, c: str, seed: int = 0, prefix: str = "") -> DataFrame:
    """Replace the levels by numbers, in the order of an MD5 hash of seed and level."""
    values = df.select(c).where(F.col(c).isNotNull()).distinct().withColumn("__h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(c).cast("string"))))
    numbered = O.row_number(values, "__n", ["__h", c]).drop("__h")
    return O.attach(df, numbered, [c]).withColumn(
        c, F.when(F.col("__n").isNotNull(), F.concat(F.lit(prefix), F.col("__n").cast("string")))).drop("__n")
