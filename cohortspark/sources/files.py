"""Text, delimited, fixed-width, JSON and log files."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.sources.types import apply_spec, column_spec, type_convert


def read_delim(spark: SparkSession, path, sep: str = ",", col_types=None, header: bool = True, decimal_mark: str = ".",
               grouping_mark: str = ",", quote: str = '"', comment: str | None = None, encoding: str = "UTF-8",
               na: tuple = ("", "NA"), **options) -> DataFrame:
    """Delimited text. Cells are read as text, then typed by the specification or by inference over all rows."""
    reader = (spark.read.option("header", header).option("sep", sep).option("quote", quote).option("escape", quote)
              .option("encoding", encoding).option("mode", "PERMISSIVE").options(**options))
    if comment:
        reader = reader.option("comment", comment)
    raw = reader.csv(path, inferSchema=False)
    spec = column_spec(col_types if col_types is not None else {}, raw.columns)
    return apply_spec(raw, spec, decimal_mark=decimal_mark, grouping_mark=grouping_mark, na=na)


def read_csv(spark, path, **kw) -> DataFrame:
    return read_delim(spark, path, ",", **kw)


def read_csv2(spark, path, **kw) -> DataFrame:
    """Semicolons between cells, a comma as decimal mark."""
    return read_delim(spark, path, ";", decimal_mark=",", grouping_mark=".", **kw)


def read_tsv(spark, path, **kw) -> DataFrame:
    return read_delim(spark, path, "\t", **kw)


def infer_schema(spark: SparkSession, path, sep: str = ",") -> dict[str, str]:
    """Specification guessed from all rows, for use as ``col_types``."""
    from cohortspark.sources.types import guess_types
    raw = spark.read.option("header", True).option("sep", sep).csv(path, inferSchema=False)
    return guess_types(raw)


def read_lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path)


def read_files(spark: SparkSession, path, raw: bool = False) -> DataFrame:
    """One row per file, as text or bytes."""
    if raw:
        return spark.read.format("binaryFile").load(path)
    return spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())


def fwf_widths(widths: list[int], names: list[str]) -> list[tuple[str, int, int]]:
    out, at = [], 0
    for w, n in zip(widths, names):
        out.append((n, at, at + w))
        at += w
    return out


def fwf_positions(start: list[int], end: list[int], names: list[str]) -> list[tuple[str, int, int]]:
    """1-based first and last positions."""
    return [(n, a - 1, b) for n, a, b in zip(names, start, end)]


def fwf_cols(**cols) -> list[tuple[str, int, int]]:
    """name=width, or name=(first, last)."""
    if all(isinstance(v, int) for v in cols.values()):
        return fwf_widths(list(cols.values()), list(cols))
    return [(n, a - 1, b) for n, (a, b) in cols.items()]


def fwf_empty(lines: DataFrame, names: list[str]) -> list[tuple[str, int, int]]:
    """Fields between the positions that are blank on every line, found in one aggregation."""
    width = lines.agg(F.max(F.char_length("value"))).first()[0] or 0
    used = lines.agg(*[F.coalesce(F.bool_or(F.substring("value", i + 1, 1).rlike(r"\S")), F.lit(False)) for i in range(width)]).first()
    fields, start = [], None
    for i in range(width + 1):
        on = i < width and used[i]
        if on and start is None:
            start = i
        if not on and start is not None:
            fields.append((start, i))
            start = None
    return [(n, a, b) for n, (a, b) in zip(names, fields)]


def split_fwf(lines: DataFrame, spec: list[tuple[str, int, int]]) -> DataFrame:
    return lines.select(*[F.nullif(F.trim(F.substring("value", a + 1, b - a)), F.lit("")).alias(n) for n, a, b in spec])


def read_fwf(spark: SparkSession, path, spec, convert: bool = True) -> DataFrame:
    """Fixed-width fields; a list of names alone finds the fields by blank positions."""
    lines = spark.read.text(path)
    if spec and isinstance(spec[0], str):
        spec = fwf_empty(lines, spec)
    out = split_fwf(lines, spec)
    return type_convert(out) if convert else out


def read_table(spark: SparkSession, path, names: list[str], convert: bool = True) -> DataFrame:
    """Cells separated by white space."""
    parts = F.split(F.trim("value"), r"\s+")
    out = spark.read.text(path).where(F.trim("value") != "").select(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])
    return type_convert(out) if convert else out


# Common and combined web-server log line: fixed format.
_LOG = r'^(\S+) (\S+) (\S+) \[([^\]]+)\] "([^"]*)" (\d{3}|-) (\d+|-)(?: "([^"]*)" "([^"]*)")?'
_LOG_FIELDS = ["host", "ident", "user", "time", "request", "status", "bytes", "referer", "agent"]


def parse_log(lines: DataFrame) -> DataFrame:
    hit = F.col("value").rlike(_LOG)
    cells = [F.when(hit, F.nullif(F.nullif(F.regexp_extract("value", _LOG, i + 1), F.lit("-")), F.lit(""))).alias(n)
             for i, n in enumerate(_LOG_FIELDS)]
    out = lines.select(*cells)
    return (out.withColumn("status", F.col("status").try_cast("int")).withColumn("bytes", F.col("bytes").try_cast("bigint"))
            .withColumn("time", F.try_to_timestamp("time", F.lit("dd/MMM/yyyy:HH:mm:ss Z"))))


def read_log(spark: SparkSession, path) -> DataFrame:
    return parse_log(spark.read.text(path))


def count_fields(lines: DataFrame, sep: str = ",") -> Column:
    """Cells per line; separators inside quotes do not count."""
    plain = F.regexp_replace("value", r'"(?:[^"]|"")*"', "")
    return F.char_length(plain) - F.char_length(F.replace(plain, F.lit(sep), F.lit(""))) + 1


def read_many(spark: SparkSession, paths: list[str], id: str = "filename", reader=read_csv, **kw) -> DataFrame:
    """All files by ``reader`` and its options, stacked by column name, with the file name as a column.

    Files with the same columns in the same order are one scan. Where the reader
    guesses types, it does so for each layout; columns that get other types in
    another layout are text.
    """
    layouts: dict[tuple, list[str]] = {}
    for path in paths:
        layouts.setdefault(tuple(reader(spark, path, **kw).columns), []).append(path)
    frames = [reader(spark, same, **kw).withColumn(id, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)) for same in layouts.values()]
    kinds: dict[str, set] = {}
    for f in frames:
        for name, kind in f.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = {c for c, k in kinds.items() if len(k) > 1}
    frames = [f.withColumns({c: F.col(c).cast("string") for c in f.columns if c in mixed}) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_assessment_files(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """Every delimited file below a folder as text, stacked by name, then types inferred once.

    Files are grouped by their header so that files of one layout are one scan;
    empty files are skipped with a message.
    """
    text = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(folder)
    # the first line of the split that starts a file is its header
    lines = text.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
    heads = lines.where("at = 0").groupBy("path").agg(F.first("value").alias("head"))
    found = {urlsplit(r["path"]).path: r["head"].strip() for r in heads.collect()}  # one short row per file
    by_header: dict[str, list[str]] = {}
    for path in sorted(text.inputFiles()):
        head = found.get(urlsplit(path).path)
        if not head:
            print(f"skipped empty file {path}")
            continue
        by_header.setdefault(head, []).append(unquote(path))
    if not by_header:
        raise FileNotFoundError(folder)
    frames = [spark.read.option("header", True).csv(paths, inferSchema=False) for _, paths in sorted(by_header.items())]
    return type_convert(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames))


def write_delim(df: DataFrame, path: str, sep: str = ",", na: str = "NA", header: bool = True, mode: str = "error",
                bom: bool = False) -> None:
    """A folder of delimited files, one per task."""
    if bom:
        df = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0])
    (df.write.mode(mode).option("header", header).option("sep", sep).option("nullValue", na).option("emptyValue", "")
     .option("escape", '"').csv(path))


def write_csv(df, path, **kw) -> None:
    write_delim(df, path, ",", **kw)


def write_tsv(df, path, **kw) -> None:
    write_delim(df, path, "\t", **kw)


def write_excel_csv(df, path, **kw) -> None:
    """With a byte order mark, for spreadsheets."""
    write_delim(df, path, ",", bom=True, **kw)


def write_lines(df: DataFrame, path: str, c: str = "value", mode: str = "error") -> None:
    df.select(F.col(c).cast("string").alias("value")).write.mode(mode).text(path)


def format_csv(df: DataFrame, sep: str = ",", name: str = "value") -> DataFrame:
    """Each row as one line of delimited text."""
    return df.select(F.to_csv(F.struct(*df.columns), {"sep": sep, "nullValue": "NA"}).alias(name))


def read_json(spark: SparkSession, path, schema: str | T.StructType | None = None, flatten: bool = False,
              records: bool = False) -> DataFrame:
    """Line JSON, or with ``records`` files that hold one array of records."""
    reader = spark.read.option("multiLine", records)
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    if flatten:
        from cohortspark.functions.jsons import flatten_struct
        return flatten_struct(df)
    return df


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def rbind_pages(dfs: list[DataFrame]) -> DataFrame:
    from cohortspark.operators.verbs import bind_rows
    return bind_rows(dfs)
