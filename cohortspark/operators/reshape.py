"""Wide to long and back, splitting cells, completing grids, nesting."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.functions.na import na_test
from cohortspark.operators import ordered as O
from cohortspark.operators.tabyl import column_names, levels_of
from cohortspark.operators.verbs import crossing, repair_names, resolve
from cohortspark.session import hot_rows


def gather(df: DataFrame, key: str, value: str, cols, na_rm: bool = False, convert: bool = False) -> DataFrame:
    """Measure columns to key and value rows."""
    names = resolve(df, *cols)
    ids = [c for c in df.columns if c not in names]
    quoted = lambda cols: [F.col(f"`{c}`") for c in cols]
    long = df.unpivot(quoted(ids), quoted(names), key, value)
    if na_rm:
        long = long.where(~na_test(long, value))
    if convert:
        from cohortspark.sources.types import convert_columns
        long = convert_columns(long, [key])
    return long


def melt(df: DataFrame, id_vars: list[str], variable: str = "variable", value: str = "value", na_rm: bool = False) -> DataFrame:
    return gather(df, variable, value, [c for c in df.columns if c not in id_vars], na_rm)


def spread(df: DataFrame, key: str, value: str, fill=None, levels: list | None = None, sep: str | None = None,
           check: bool = True) -> DataFrame:
    """Key and value rows to columns; two rows for one cell are an error.

    The check is part of the plan: a cell that got two rows raises while running.
    """
    rest = [c for c in df.columns if c not in (key, value)]
    found = levels_of(df, key, levels)
    cells = df.groupBy(*rest, key).agg(F.max(value).alias("__v"), F.count(F.lit(1)).alias("__n"))
    one = F.when(F.col("__n") == 1, F.col("__v")).otherwise(
        F.raise_error(F.lit("duplicate rows for one cell"))) if check else F.col("__v")
    cells = cells.withColumn("__v", one.cast(df.schema[value].dataType))
    out = []
    for v, label in zip(found, column_names(found)):
        hit = F.max(F.when(F.col(key).eqNullSafe(F.lit(v)), F.col("__v")))
        name = label if sep is None else f"{key}{sep}{label}"
        out.append((F.coalesce(hit, F.lit(fill).cast(df.schema[value].dataType)) if fill is not None else hit).alias(name))
    return cells.groupBy(*rest).agg(*out)


def spread_map(df: DataFrame, key: str, value: str, name: str = "cells", check: bool = True) -> DataFrame:
    """As ``spread``, the cells of a row in one map, for any number of keys; cells without a row are not in it."""
    rest = [c for c in df.columns if c not in (key, value)]
    cells = df.where(F.col(key).isNotNull()).groupBy(*rest, key).agg(F.max(value).alias("__v"), F.count(F.lit(1)).alias("__n"))
    if check:
        one = F.when(F.col("__n") == 1, F.col("__v")).otherwise(F.raise_error(F.lit("duplicate rows for one cell")))
        cells = cells.withColumn("__v", one.cast(df.schema[value].dataType))
    return cells.groupBy(*rest).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(key).alias("key"), F.col("__v").alias("value"))))).alias(name))


def separate(df: DataFrame, c: str, into: list[str], sep: str | list[int] = "[^0-9A-Za-z]+", convert: bool = False,
             remove: bool = True) -> DataFrame:
    """One column to several, by a regex or at positions (negative ones count from the right).

    With a regex the last piece keeps the rest; pieces that are absent are NA.
    """
    x = F.col(c)
    if isinstance(sep, str):
        parts = F.split(x, sep, len(into))
        cells = [F.get(parts, F.lit(i)) for i in range(len(into))]
    else:
        n = F.char_length(x)
        cuts = [F.lit(0), *[F.least(F.lit(p), n) if p >= 0 else F.greatest(n + p, F.lit(0)) for p in sep], n]
        cells = [F.substring(x, a + 1, F.greatest(b - a, F.lit(0))) for a, b in zip(cuts, cuts[1:])]
    names = []
    for name in df.columns:
        names += into if name == c and remove else ([name, *into] if name == c else [name])
    out = df.withColumns(dict(zip(into, cells))).select(*dict.fromkeys(names))
    if convert:
        from cohortspark.sources.types import convert_columns
        out = convert_columns(out, into)
    return out


def separate_rows(df: DataFrame, c: str, sep: str = "[^0-9A-Za-z.]+") -> DataFrame:
    return df.withColumn(c, F.explode_outer(F.split(F.col(c), sep)))


def extract(df: DataFrame, c: str, into: list[str], regex: str, remove: bool = True) -> DataFrame:
    """Regex groups to columns, NA where the pattern does not match."""
    hit = F.col(c).rlike(regex)
    out = df.withColumns({n: F.when(hit, F.regexp_extract(c, regex, i + 1)) for i, n in enumerate(into)})
    return out.drop(c) if remove and c not in into else out


def unite(df: DataFrame, name: str, cols: list[str], sep: str = "_", remove: bool = True) -> DataFrame:
    text = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in cols])
    out = df.withColumn("__u", text)
    return (out.drop(*cols) if remove else out).withColumnRenamed("__u", name)


def parse_number(c, grouping: str = ",", decimal: str = ".") -> Column:
    """First number in a text."""
    c = F.col(c) if isinstance(c, str) else c
    g, d = re.escape(grouping), re.escape(decimal)
    found = F.regexp_substr(c, F.lit(rf"-?[0-9](?:[0-9{g}]*[0-9])?(?:{d}[0-9]+)?|-?{d}[0-9]+"))
    plain = F.replace(F.replace(found, F.lit(grouping), F.lit("")), F.lit(decimal), F.lit("."))
    return plain.try_cast("double")


extract_numeric = parse_number


def expand(df: DataFrame, *cols) -> DataFrame:
    """All combinations of the distinct values; a list of names is taken as combinations found in the data."""
    return crossing(*[df.select(*([c] if isinstance(c, str) else c)) for c in cols])


def nesting(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def complete(df: DataFrame, *cols, fill: dict | None = None) -> DataFrame:
    """Add the combinations that do not occur; their other cells are NA or the fill value."""
    keys = [k for c in cols for k in ([c] if isinstance(c, str) else c)]
    grid = expand(df, *cols)
    mark = df.withColumn("__hit", F.lit(True))
    new = [f"__r_{k}" for k in keys]
    right = mark.withColumnsRenamed(dict(zip(keys, new)))
    full = grid.join(right, O.null_safe(grid, right, keys, new), "left").drop(*new)
    for c, v in (fill or {}).items():
        full = full.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)))
    return full.drop("__hit").select(*df.columns)


def full_seq(df: DataFrame, c: str, period, by: list[str] | None = None) -> DataFrame:
    """Regular values from the smallest to the largest, per group; the grid has one row per step."""
    kind = df.schema[c].dataType
    ends = df.groupBy(*(by or [])).agg(F.min(c).alias("__lo"), F.max(c).alias("__hi"))
    if isinstance(kind, (T.DateType, T.TimestampType)):
        step = F.expr(period)  # an interval literal
        return ends.select(*(by or []), F.explode(F.sequence("__lo", "__hi", step)).alias(c))
    steps = F.floor((F.col("__hi") - F.col("__lo")) / period).cast("bigint")
    out = ends.select(*(by or []), "__lo", F.explode(F.sequence(F.lit(0).cast("bigint"), steps)).alias("__i"))
    return out.select(*(by or []), (F.col("__lo") + F.col("__i") * period).cast(kind).alias(c))


def nest(df: DataFrame, by: list[str], name: str = "data", order: list[str] | None = None,
         rows_per_cell: int | None = None) -> DataFrame:
    """Rows of a group to one list cell, sorted by ``order``.

    A cell is one value, so a group above the row limit cannot be nested whole:
    pass ``rows_per_cell`` to get the group as several rows with a ``chunk``
    number; without it such a group raises.
    """
    rest = [c for c in df.columns if c not in by]
    rank = F.struct(*[F.col(c) for c in (order or [])], F.struct(*rest).alias("__row"))
    if rows_per_cell:
        numbered = O.row_number(df, "__pos", order or rest, by)
        chunk = F.floor((F.col("__pos") - 1) / rows_per_cell).cast("bigint") + 1
        cells = numbered.withColumn("chunk", chunk).groupBy(*by, "chunk").agg(
            F.sort_array(F.collect_list(F.struct("__pos", F.struct(*rest).alias("__row")))).alias("__l"))
        return cells.select(*by, "chunk", F.transform("__l", lambda s: s["__row"]).alias(name))
    limit = hot_rows(df.sparkSession)
    if not df.groupBy(*by).count().where(F.col("count") > limit).isEmpty():
        raise ValueError(f"a group has more than {limit} rows; pass rows_per_cell")
    return df.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(rank)), lambda s: s["__row"]).alias(name))


def flatten_text(df: DataFrame, by: list[str], c: str, sep: str = "", order: list[str] | None = None, name: str = "text",
                 rows_per_cell: int | None = None) -> DataFrame:
    """Texts of a group in one, ordered; the size rule of ``nest`` holds."""
    cells = nest(df.select(*dict.fromkeys([*by, *[o.removeprefix("-") for o in order or []], c])), by, "__l", order or [c], rows_per_cell)
    keys = [x for x in cells.columns if x != "__l"]
    return cells.select(*keys, F.array_join(F.transform("__l", lambda s: s[c].cast("string")), sep).alias(name))


def unnest(df: DataFrame, c: str, keep_empty: bool = False) -> DataFrame:
    """List cells back to rows."""
    kind = df.schema[c].dataType.elementType
    rest = [x for x in df.columns if x != c]
    out = df.withColumn(c, (F.explode_outer if keep_empty else F.explode)(c))
    return out.select(*rest, f"{c}.*") if isinstance(kind, T.StructType) else out.select(*rest, c)


def uncount(df: DataFrame, n: str, remove: bool = True, id: str | None = None) -> DataFrame:
    """Repeat each row n times."""
    out = df.where(F.col(n) > 0).withColumn(id or "__i", F.explode(F.sequence(F.lit(1), F.col(n).cast("int"))))
    out = out if id else out.drop("__i")
    return out.drop(n) if remove else out


HEAD_ROWS = 10_000  # a header further down is looked up by its number


def row_to_names(df: DataFrame, row: int, order: list[str]) -> DataFrame:
    """Take one row as header and drop it and the rows above; rows level in the order are told apart by their values."""
    order_cols = [o.removeprefix("-") for o in order]
    body = [c for c in df.columns if c not in order_cols]
    nested = any(isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType)) for c in order_cols)
    if nested or row > HEAD_ROWS or "map<" in df.schema.simpleString():
        pos = O.row_number(df, "__pos", order)
        header, rest = pos.where(F.col("__pos") == row).first(), pos.where(F.col("__pos") > row)
    else:
        header, rest = _below(df, row, order)
    names = repair_names([str(header[c]) if header[c] is not None else "" for c in body])
    return rest.select(*order_cols, *[F.col(c).alias(n) for c, n in zip(body, names)])


def _below(df: DataFrame, row: int, order: list[str]) -> tuple[Row, DataFrame]:
    """The row at a place and the rows after it. Only the first rows are sorted; the others sort after the header by their values."""
    keys = [*O.order_keys(df, order), O.Key(F.xxhash64(*df.columns))]
    named = [k.expr.alias(f"k{i}") for i, k in enumerate(keys)]
    head = df.select(F.struct(*named).alias("__key"), F.struct(*df.columns).alias("__row"))
    kinds = [f.dataType for f in head.schema["__key"].dataType.fields]
    first = [O.Key(F.col(f"__key.k{i}"), k.desc, k.nulls_last).sort() for i, k in enumerate(keys)]
    found = head.orderBy(*first).limit(row + 1).collect()
    if not 0 < row <= len(found):
        raise ValueError(f"there is no row {row}")
    at = found[row - 1]["__key"]
    split = {f"k{i}": F.lit(v).cast(kind) for i, (v, kind) in enumerate(zip(at, kinds))}
    own = [k.expr for k in keys]
    level = reduce(lambda a, b: a & b, [o.eqNullSafe(v) for o, v in zip(own, split.values())])
    rest = df.where(O.not_after(split, own, keys) & ~level)
    if len(found) > row and _same(found[row]["__key"], at):
        # copies of the header go on below it
        above = sum(_same(r["__key"], at) for r in found[:row])
        copies = O.row_number(df.where(level), "__pos", order).where(F.col("__pos") > above).drop("__pos")
        rest = rest.unionByName(copies)
    return found[row - 1]["__row"], rest


def _same(a: Row, b: Row) -> bool:
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def remove_empty(df: DataFrame, which: tuple = ("rows", "cols")) -> DataFrame:
    """Drop rows and columns in which everything is NA."""
    if "cols" in which:
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(df.columns)]).first()
        df = df.select(*[F.col(f"`{c}`") for i, c in enumerate(df.columns) if counts[i]])
    return df.dropna("all") if "rows" in which else df


def _words(text: str) -> list[str]:
    text = text.replace("%", " percent ").replace("#", " number ")
    text = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", text.replace("'", ""))
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1 \2", text)
    return [w.lower() for w in re.split(r"[^A-Za-z0-9]+", text) if w]


_CASES = {
    "snake": lambda w: "_".join(w),
    "lower_camel": lambda w: "".join([w[0], *[x.capitalize() for x in w[1:]]]),
    "upper_camel": lambda w: "".join(x.capitalize() for x in w),
    "screaming_snake": lambda w: "_".join(w).upper(),
    "sentence": lambda w: " ".join(w).capitalize(),
    "title": lambda w: " ".join(x.capitalize() for x in w),
}


def clean_names(df: DataFrame, case: str = "snake") -> DataFrame:
    return df.toDF(*clean_name_list(df.columns, case))


def clean_name_list(names: list[str], case: str = "snake") -> list[str]:
    out, seen = [], {}
    for n in names:
        words = _words(n) or ["x"]
        new = _CASES[case](words)
        if new[0].isdigit():
            new = "x" + new
        seen[new] = seen.get(new, 0) + 1
        out.append(new if seen[new] == 1 else f"{new}_{seen[new]}")
    return out


def make_names(names: list[str]) -> list[str]:
    """Valid names: other characters become dots, a leading digit or sign gets an X."""
    out = []
    for n in names:
        start = "" if re.match(r"[^\W\d_]|\.(?!\d)", n) else "X"
        out.append(start + re.sub(r"[^\w.]", ".", n))
    return out


def cube_to_long(df: DataFrame, c: str, dims: list[str], measure: str) -> DataFrame:
    """Nested arrays to one row per cell with 1-based indices."""
    for i, d in enumerate(dims):
        target = "__cell" if i < len(dims) - 1 else measure
        source = c if i == 0 else "__cell"
        rest = [x for x in df.columns if x != source]
        df = df.select(*rest, F.posexplode(source).alias("__p", "__v")).withColumn(d, F.col("__p") + 1)
        df = df.drop("__p").withColumnRenamed("__v", target)
    return df


def outer(x: DataFrame, y: DataFrame, name: str, fn) -> DataFrame:
    """fn(x, y) for all pairs of two indexed vectors (i, x) and (j, y)."""
    from cohortspark.operators.verbs import expand_grid
    return expand_grid(x, y).withColumn(name, fn(F.col(x.columns[-1]), F.col(y.columns[-1])))


def lower_tri(df: DataFrame, i: str = "i", j: str = "j", diag: bool = False) -> DataFrame:
    return df.where(F.col(i) >= F.col(j)) if diag else df.where(F.col(i) > F.col(j))


def upper_tri(df: DataFrame, i: str = "i", j: str = "j", diag: bool = False) -> DataFrame:
    return df.where(F.col(i) <= F.col(j)) if diag else df.where(F.col(i) < F.col(j))


def diag(df: DataFrame, i: str = "i", j: str = "j") -> DataFrame:
    return df.where(F.col(i) == F.col(j))


def dcast(df: DataFrame, rows: list[str], cols: str, value: str, fn, margins: bool = False, levels: list | None = None,
          fill=None) -> DataFrame:
    """Rows by columns with an aggregate; margins add ``(all)`` rows and columns.

    ``fn`` takes a Column and returns an aggregate, so partial aggregation holds.
    """
    found = levels_of(df, cols, levels)
    x, names = F.col(value), column_names(found)
    cells = [fn(F.when(F.col(cols).eqNullSafe(F.lit(v)), x)).alias(n) for v, n in zip(found, names)]
    if margins:
        cells.append(fn(x).alias("(all)"))
        ids = [F.grouping(r).alias(f"__g_{r}") for r in rows]
        wide = df.rollup(*rows).agg(*cells, *ids)
        wide = wide.select(*[F.when(F.col(f"__g_{r}") == 1, F.lit("(all)")).otherwise(F.col(r).cast("string")).alias(r) for r in rows],
                           *names, "(all)")
    else:
        wide = df.groupBy(*rows).agg(*cells)
    return wide.fillna(fill) if fill is not None else wide


def dcast_map(df: DataFrame, rows: list[str], cols: str, value: str, fn, name: str = "cells") -> DataFrame:
    """As ``dcast``, the cells of a row in one map, for any number of columns."""
    cells = df.where(F.col(cols).isNotNull()).groupBy(*rows, cols).agg(fn(F.col(value)).alias("__v"))
    return cells.groupBy(*rows).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(cols).alias("key"), F.col("__v").alias("value"))))).alias(name))


def acast(df: DataFrame, row: str, cols: str, value: str, fn, levels: list | None = None) -> DataFrame:
    """As dcast, the cells of a row in one array."""
    found = levels_of(df, cols, levels)
    wide = dcast(df, [row], cols, value, fn, levels=found)
    return wide.select(row, F.array(*[F.col(n) for n in column_names(found)]).alias("cells"))


def recast(df: DataFrame, id_vars: list[str], rows: list[str], fn) -> DataFrame:
    """Melt, then cast with one column per variable."""
    variables = [c for c in df.columns if c not in id_vars]
    return dcast(melt(df, id_vars), rows, "variable", "value", fn, levels=variables)
