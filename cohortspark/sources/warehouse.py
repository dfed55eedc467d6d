"""Tables in catalogs, databases, warehouses and object stores, and small literal tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.operators.ordered import sort_columns

# --------------------------------------------------------- named sources


@dataclass
class Source:
    fmt: str
    options: dict[str, str] = field(default_factory=dict)
    namespace: str = ""


_SOURCES: dict[str, Source] = {}

def register_source(name: str, fmt: str, options: dict[str, str] | None = None, namespace: str = "") -> None:
    """Name a connection once; ``{table}`` in an option value is filled in on reading."""
    _SOURCES[name] = Source(fmt, dict(options or {}), namespace)


def source_table(spark: SparkSession, source: str, table: str, schema: str | None = None) -> DataFrame:
    """A lazy table of a named source."""
    s = _SOURCES[source]
    full = ".".join(x for x in (s.namespace, schema, table) if x)
    if s.fmt == "table":
        return spark.table(full)
    options = {k: v.format(table=table, full=full) for k, v in s.options.items()}
    path = options.pop("path", None)
    reader = spark.read.format(s.fmt).options(**options)
    return reader.load(path) if path else reader.load()


def source_loader(source: str, schema: str | None = None):
    """A one-argument loader, ``get = source_loader("roster"); get(spark, "students")``."""
    return lambda spark, table: source_table(spark, source, table, schema)


# -------------------------------------------------------------- databases

def read_db(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
            partition: tuple[str, int, int, int] | None = None, fetchsize: int = 10_000, **options) -> DataFrame:
    """Database table or query. ``partition`` is (column, low, high, n) for a parallel read."""
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize).options(**options)
    reader = reader.option("query", query) if query else reader.option("dbtable", table)
    if partition:
        if query:
            raise ValueError("a query cannot be read in parallel, pass it as a table in parentheses")
        c, lo, hi, n = partition
        reader = (reader.option("partitionColumn", c).option("lowerBound", lo).option("upperBound", hi).option("numPartitions", n))
    return reader.load()


def write_db(df: DataFrame, url: str, table: str, mode: str = "error", **options) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode(mode).save()


def write_table(df: DataFrame, name: str, mode: str = "error", partition_by: list[str] | None = None,
                cluster_by: tuple[int, list[str]] | None = None) -> None:
    """Catalog table; buckets take the place of an index on join keys."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if cluster_by:
        n, cols = cluster_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    w.saveAsTable(name)


def catalog_tables(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables()],
                                 "name string, type string, temporary boolean")


def catalog_fields(df: DataFrame) -> DataFrame:
    """Name, type and place of the columns."""
    return df.sparkSession.createDataFrame([(i + 1, n, t) for i, (n, t) in enumerate(df.dtypes)], "position int, name string, type string")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def run_statement(spark: SparkSession, sql: str, **args) -> DataFrame:
    return spark.sql(sql, args=args)


def drop_table(spark: SparkSession, name: str) -> None:
    if spark.catalog.dropTempView(name):
        return
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_atomic(df: DataFrame, base: str) -> str:
    """Write a new version next to the old ones; the newest complete one is the table.

    A version counts once Spark has put its success mark, so readers never see
    half a write.
    """
    import uuid
    from datetime import datetime, timezone
    path = f"{base}/v={datetime.now(timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return path


# -------------------------------------------------------------- warehouse

def read_warehouse(spark: SparkSession, table_or_query: str, max_results: int | None = None, fmt: str = "bigquery", **options) -> DataFrame:
    """Warehouse table, or query when it holds a blank. The connector must be on the class path;
    with ``fmt="parquet"`` the same call reads files."""
    reader = spark.read.format(fmt).options(**options)
    if fmt == "bigquery" and " " in table_or_query.strip():
        df = reader.option("query", table_or_query).option("viewsEnabled", "true").load()
    else:
        df = reader.load(table_or_query)
    return df.limit(max_results) if max_results is not None else df


def write_warehouse(df: DataFrame, table: str, mode: str = "error", fmt: str = "bigquery", **options) -> None:
    df.write.format(fmt).options(**options).mode(mode).save(table)


def copy_table(spark: SparkSession, src: str, dst: str, fmt: str = "bigquery", mode: str = "error", **options) -> None:
    write_warehouse(read_warehouse(spark, src, fmt=fmt, **options), dst, mode, fmt, **options)


def table_meta(df: DataFrame) -> DataFrame:
    """Rows, columns and fields as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_cols"), F.lit(", ".join(f"{n} {t}" for n, t in df.dtypes)).alias("fields"))


# ----------------------------------------------------------- object store

def list_objects(spark: SparkSession, prefix: str, glob: str = "*") -> DataFrame:
    """Name, size and time of the objects below a prefix, contents not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(prefix)
            .select("path", "modificationTime", "length"))


def read_objects(spark: SparkSession, prefix: str, fmt: str = "parquet", glob: str | None = None, **options) -> DataFrame:
    """Parse all objects below a prefix; any scheme with a file system on the class path."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(prefix)


def write_objects(df: DataFrame, prefix: str, fmt: str = "parquet", mode: str = "error") -> None:
    df.write.format(fmt).mode(mode).save(prefix)


# ----------------------------------------------------------- small tables

def tibble(spark: SparkSession, **cols) -> DataFrame:
    """Small table by columns: lists of one length, single values, or expressions over earlier columns."""
    lists = {k: v for k, v in cols.items() if isinstance(v, (list, tuple, range))}
    n = max((len(v) for v in lists.values()), default=1)
    bad = [k for k, v in lists.items() if len(v) not in (1, n)]
    if bad:
        raise ValueError(f"length of {bad[0]} is not 1 or {n}")
    full = {k: list(v) * n if len(v) == 1 else list(v) for k, v in lists.items()}
    rows = [(i, *[full[k][i] for k in full]) for i in range(n)]
    df = spark.createDataFrame(rows, ["__i", *full])
    for k, v in cols.items():
        if k not in full:
            df = df.withColumn(k, v if isinstance(v, Column) else F.lit(v))
    return df.select(*cols)


def tribble(spark: SparkSession, names: list[str], *cells) -> DataFrame:
    """Small table written row by row."""
    k = len(names)
    return spark.createDataFrame([tuple(cells[i:i + k]) for i in range(0, len(cells), k)], names)


def frame_matrix(spark: SparkSession, names: list[str], *cells, name: str = "cells") -> DataFrame:
    return tribble(spark, names, *cells).select(F.array(*names).alias(name))


def enframe(spark: SparkSession, values: dict, name: str = "name", value: str = "value") -> DataFrame:
    return spark.createDataFrame(list(values.items()), [name, value])


def deframe(df: DataFrame, name: str = "name", value: str = "value", max_rows: int = 100_000) -> dict:
    rows = df.select(name, value).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows")
    return {r[0]: r[1] for r in rows}


# ------------------------------------------------------- running and seeing

def compute(df: DataFrame, name: str | None = None) -> DataFrame:
    """Store the result in the shared folder and read it back; optionally under a view name."""
    from cohortspark.session import scratch_path
    path = scratch_path(df.sparkSession, name or "computed")
    df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    if name:
        out.createOrReplaceTempView(name)
    return out


def collapse(df: DataFrame) -> DataFrame:
    """Nothing to do: Spark folds verbs into one plan."""
    return df


def collect(df: DataFrame, max_rows: int = 100_000) -> list:
    """Rows on the driver; more than ``max_rows`` is an error instead of a crash."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows")
    return rows


def explain(df: DataFrame) -> str:
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def glimpse(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """One row per column: type and the first values, in ``order`` or as found; NA is left out."""
    head = df.orderBy(*sort_columns(df, order)).limit(n) if order else df.limit(n)
    place = F.struct(*[F.col(f"`{o.removeprefix('-')}`") for o in order]) if order else F.lit(0)
    listed = lambda c: F.transform(F.sort_array(F.collect_list(F.struct(place.alias("at"), F.col(f"`{c}`").cast("string").alias("v")))), lambda s: s["v"])
    cells = [F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("type"), F.array_join(listed(c), ", ").alias("values"))
             for i, (c, t) in enumerate(df.dtypes)]
    return head.agg(F.array(*cells).alias("a")).select(F.inline("a"))


def summary_table(df: DataFrame) -> DataFrame:
    return df.summary("count", "mean", "stddev", "min", "max")
