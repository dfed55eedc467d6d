"""JSON columns and nested structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.functions.na import col


def parse_json_col(c, schema: str) -> Column:
    """Text to a typed value; keys that are absent are NA."""
    return F.from_json(col(c), schema)


def json_schema(df: DataFrame, c: str) -> str:
    """Schema merged from the objects of all rows, in one aggregation, as ``parse_json_col`` takes it."""
    found = df.where(F.col(c).isNotNull()).agg(F.schema_of_variant_agg(F.try_parse_json(F.col(c))).alias("s")).first()["s"]
    return found.replace("OBJECT<", "STRUCT<")


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs to ``a.b`` columns."""
    def walk(kind: T.StructType, path: Column | None, name: str):
        for f in kind.fields:
            here = F.col(f"`{f.name}`") if path is None else path.getField(f.name)
            label = f.name if not name else f"{name}{sep}{f.name}"
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, here, label)
            else:
                yield here.alias(label)
    return df.select(*walk(df.schema, None, ""))


def json_valid(c) -> Column:
    """The whole text is one JSON value.

    The parser stops after the first value, so the text is also put between two
    kinds of brackets: what closes one of them early breaks the other.
    """
    c = col(c)
    in_list = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"a":'), c, F.lit("}")))
    return F.when(c.isNotNull(), in_list.isNotNull() & in_object.isNotNull())


def json_minify(c) -> Column:
    """Without blanks; NA when the text is not valid."""
    c = col(c)
    return F.when(json_valid(c), F.to_json(F.try_parse_json(c)))


def json_prettify(c, schema: str) -> Column:
    return F.to_json(F.from_json(col(c), schema), {"pretty": "true"})


def to_json_col(*cols: str) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def round_trip_equal(df: DataFrame) -> Column:
    """True when a row is the same after a trip through JSON."""
    whole = F.struct(*[F.col(c) for c in df.columns])
    return F.from_json(F.to_json(whole, {"ignoreNullFields": "false"}), df.schema).eqNullSafe(whole)
