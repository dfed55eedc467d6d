"""Column types: guessing them, parsing text to them, and listing what failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions import dates as D
from cohortspark.functions.na import col

NA_STRINGS = ("", "NA")

_NUMBER = r"^-?(\d{1,3}(,\d{3})+|\d+)(\.\d+)?$"
_DOUBLE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?Inf(inity)?$|^NaN$"
_DATE = r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}$"
_DATETIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"
_TIME = r"^\s*\d{1,2}:\d{1,2}(:\d{1,2})?\s*([AaPp][Mm])?\s*$"


def _text(c: Column, na: tuple = NA_STRINGS) -> Column:
    t = F.trim(c)
    return F.when(~t.isin(list(na)), t)


def _logical(c):
    up = F.upper(c)
    return F.when(up.isin("T", "TRUE"), True).when(up.isin("F", "FALSE"), False)


def _time(c):
    return D.hms_seconds(c)


# From the narrowest type to the widest; each turns text to a value or NA.
PARSERS = {
    "logical": _logical,
    "integer": lambda c: F.when(c.rlike(r"^[+-]?\d+$"), c).try_cast("int"),
    "long": lambda c: F.when(c.rlike(r"^[+-]?\d+$"), c).try_cast("bigint"),
    "double": lambda c: F.when(c.rlike(_DOUBLE), c).try_cast("double"),
    "number": lambda c: F.when(c.rlike(_NUMBER), F.replace(c, F.lit(","), F.lit(""))).try_cast("double"),
    "date": lambda c: F.when(c.rlike(_DATE), F.replace(c, F.lit("/"), F.lit("-"))).try_cast("date"),
    "datetime": lambda c: F.when(c.rlike(_DATETIME), c).try_cast("timestamp"),
    "time": _time,
    "character": lambda c: c,
}

# One-letter codes of the compact column specification: fixed values.
CODES = {"l": "logical", "i": "integer", "L": "long", "d": "double", "n": "number", "D": "date", "T": "datetime", "t": "time",
         "c": "character", "_": "skip", "-": "skip", "?": "guess"}


# Classes of a cell, tried in this order; the pattern comes first as it is cheap.
_SHAPES = {
    "logical": lambda t: t.rlike(r"^(?i:T|F|TRUE|FALSE)$"),
    "integer": lambda t: t.rlike(r"^[+-]?\d+$") & t.try_cast("int").isNotNull(),
    "long": lambda t: t.rlike(r"^[+-]?\d+$") & t.try_cast("bigint").isNotNull(),
    "double": lambda t: t.rlike(_DOUBLE) & t.try_cast("double").isNotNull(),
    "number": lambda t: t.rlike(_NUMBER),
    "date": lambda t: t.rlike(_DATE) & PARSERS["date"](t).isNotNull(),
    "datetime": lambda t: t.rlike(_DATETIME) & PARSERS["datetime"](t).isNotNull(),
    "time": lambda t: t.rlike(_TIME) & PARSERS["time"](t).isNotNull(),
    "character": lambda t: F.lit(True),
}
# Cell classes a column of the type may hold.
_HOLDS = {"logical": {"logical"}, "integer": {"integer"}, "long": {"integer", "long"}, "double": {"integer", "long", "double"},
          "number": {"integer", "long", "double", "number"}, "date": {"date"}, "datetime": {"datetime"}, "time": {"time"}}


def guess_types(df: DataFrame, cols: list[str] | None = None, na: tuple = NA_STRINGS) -> dict[str, str]:
    """Narrowest type that fits every value.

    Each cell gets the class of its shape as one bit; one aggregation joins the
    bits of all columns, and the bits of a column name its type.
    """
    kinds = dict(df.dtypes)
    cols = [c for c in (df.columns if cols is None else cols) if kinds[c] == "string"]
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        t = _text(F.col(f"`{c}`"), na)
        bit = F.when(t.isNull(), 0)
        for j, shape in enumerate(_SHAPES.values()):
            bit = bit.when(shape(t), 2 ** j)
        aggs.append(F.bit_or(bit).alias(f"b{i}"))
    row = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(cols):
        found = {k for j, k in enumerate(_SHAPES) if (row[f"b{i}"] or 0) & 2 ** j}
        out[c] = next((k for k, ok in _HOLDS.items() if found and found <= ok), "character")
    return out


def parse_col(c, kind: str, levels: list[str] | None = None, na: tuple = NA_STRINGS, decimal_mark: str = ".",
              grouping_mark: str = ",", fmt: str | None = None, locale: str = "en", tz: str = "UTC") -> Column:
    """Text to a typed value, NA where it does not parse."""
    t = _text(col(c), na)
    if kind == "factor":
        return F.when(t.isin(list(levels or [])), t)
    if kind in ("double", "number") and decimal_mark != ".":
        t = F.replace(F.replace(t, F.lit(grouping_mark), F.lit("")), F.lit(decimal_mark), F.lit("."))
    if kind == "date" and fmt:
        return D.parse_date(t, fmt, locale)
    if kind == "datetime" and fmt:
        return D.parse_datetime(t, fmt, locale, tz)
    if kind == "datetime":
        return F.to_utc_timestamp(PARSERS[kind](t), tz)
    return PARSERS[kind](t)


def column_spec(spec, columns: list[str]) -> dict[str, str]:
    """A compact text such as ``icD_`` or a dict to name -> type; ``skip`` drops, ``guess`` infers."""
    if isinstance(spec, str):
        if len(spec) != len(columns):
            raise ValueError("one letter per column")
        return {c: CODES[s] for c, s in zip(columns, spec)}
    return {c: spec.get(c, spec.get(".default", "guess")) for c in columns}


def cols_only(spec: dict[str, str]) -> dict[str, str]:
    return {**spec, ".default": "skip"}


def cols_condense(spec: dict[str, str]) -> dict[str, str]:
    """The most common type becomes the default."""
    kinds = list(spec.values())
    top = max(dict.fromkeys(kinds), key=kinds.count)
    return {".default": top, **{c: k for c, k in spec.items() if k != top}}


def convert_columns(df: DataFrame, cols: list[str], spec: dict[str, str] | None = None) -> DataFrame:
    kinds = spec or guess_types(df, cols)
    return df.withColumns({c: parse_col(F.col(f"`{c}`"), kinds[c]) for c in cols if c in kinds})


def type_convert(df: DataFrame) -> DataFrame:
    """Infer again the types of all text columns."""
    return convert_columns(df, df.columns)


def apply_spec(df: DataFrame, spec: dict[str, str], **options) -> DataFrame:
    """Typed columns by a specification; guesses are made together in one pass."""
    open_cols = [c for c in df.columns if spec[c] == "guess"]
    kinds = {**spec, **guess_types(df, open_cols)}
    return df.select(*[parse_col(F.col(f"`{c}`"), kinds[c], **options).alias(c) if kinds[c] != "guess" else F.col(f"`{c}`")
                       for c in df.columns if kinds[c] != "skip"])


def problems(df: DataFrame, spec: dict[str, str], id_cols: list[str] | None = None) -> DataFrame:
    """One row per cell that did not parse: its ids, column, expected type and actual text."""
    cells = []
    for c, kind in spec.items():
        t = _text(F.col(f"`{c}`"))
        bad = t.isNotNull() & PARSERS[kind](t).isNull()
        cells.append(F.when(bad, F.struct(F.lit(c).alias("column"), F.lit(kind).alias("expected"), F.col(f"`{c}`").alias("actual"))))
    return df.select(*(id_cols or []), F.explode(F.array_compact(F.array(*cells))).alias("p")).select(*(id_cols or []), "p.*")


def stop_for_problems(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    found = problems(df, spec).limit(1).collect()
    if found:
        raise ValueError(f"{found[0]['actual']!r} in {found[0]['column']} is not {found[0]['expected']}")
    return df
