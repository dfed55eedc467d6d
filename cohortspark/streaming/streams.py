"""Chunked reading and continuous results with Structured Streaming.

Each run stores its progress below the shared folder and, with the default
trigger, ends when the files present have been read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.operators import ordered as O
from cohortspark.operators.verbs import first_rows
from cohortspark.session import scratch_path

Chunk = Callable[[DataFrame, int], DataFrame | None]


def stream_files(spark: SparkSession, folder: str, schema: T.StructType | str, fmt: str = "parquet",
                 files_per_chunk: int = 100, **options) -> DataFrame:
    """New files of a folder as they arrive."""
    return (spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_chunk)
            .options(**options).load(folder))


def run_stream(sdf: DataFrame, path: str | None = None, mode: str = "append", checkpoint: str | None = None) -> str:
    """Write the stream as parquet files and wait for the end."""
    spark = sdf.sparkSession
    path = path or scratch_path(spark, "stream")
    q = (sdf.writeStream.format("parquet").outputMode(mode).option("path", path)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "progress"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return path


def each_chunk(sdf: DataFrame, fn: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None) -> None:
    """Call ``fn(chunk, number)`` for each chunk; the side effect is the caller's."""
    q = (sdf.writeStream.foreachBatch(fn).outputMode(mode)
         .option("checkpointLocation", checkpoint or scratch_path(sdf.sparkSession, "progress"))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def bind_chunks(sdf: DataFrame, fn: Chunk, schema: T.StructType | str, mode: str = "append") -> DataFrame:
    """Stack what ``fn`` returns for each chunk.

    Chunks are stored by number and overwritten when one is run again after a
    failure, so nothing is counted twice.
    """
    spark = sdf.sparkSession
    path = scratch_path(spark, "chunks")

    def store(chunk: DataFrame, number: int) -> None:
        out = fn(chunk, number)
        if out is not None:
            out.write.mode("overwrite").parquet(f"{path}/chunk={number}")

    each_chunk(sdf, store, mode)
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(T.StructType([*kind.fields, T.StructField("chunk", T.IntegerType())])).parquet(path)


def _file_stream(fmt: str):
    def read(spark: SparkSession, folder: str, schema, fn: Chunk, out_schema, files_per_chunk: int = 1, **options) -> DataFrame:
        return bind_chunks(stream_files(spark, folder, schema, fmt, files_per_chunk, **options), fn, out_schema)
    return read


stream_csv = _file_stream("csv")
stream_json = _file_stream("json")
stream_lines = _file_stream("text")


def stream_tabyl(sdf: DataFrame, *keys: str) -> DataFrame:
    """Counts per key kept up to date."""
    return sdf.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def latest_table(sdf: DataFrame, schema: T.StructType | str, keys: list[str]) -> DataFrame:
    """Run an update-mode stream; the last value per key is the result."""
    parts = bind_chunks(sdf, lambda chunk, _: chunk, schema, mode="update")
    values = [c for c in parts.columns if c not in (*keys, "chunk")]
    last = parts.groupBy(*keys).agg(F.max_by(F.struct(*values), "chunk").alias("__v"))
    return last.select(*keys, "__v.*")


def final_table(sdf: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Run a complete-mode stream; the last chunk is the result."""
    parts = bind_chunks(sdf, lambda chunk, _: chunk, schema, mode="complete")
    return parts.where(F.col("chunk") == parts.agg(F.max("chunk")).scalar()).drop("chunk")


def _timed(sdf: DataFrame, ts: str) -> DataFrame:
    """Watermarks need an instant; a time without zone is taken in the session zone."""
    return sdf.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_window_agg(sdf: DataFrame, ts: str, size: str, slide: str | None = None, watermark: str | None = None,
                      by: list[str] | None = None, session: bool = False, **aggs) -> DataFrame:
    """Tumbling, sliding or session windows.

    Without a watermark every row counts, however the files are cut into
    chunks; run it in update or complete mode (``latest_table``,
    ``final_table``). With one, state is bounded and rows later than it are
    dropped, so what is late depends on the chunks.
    """
    marked = _timed(sdf, ts)
    if watermark:
        marked = marked.withWatermark(ts, watermark)
    win = F.session_window(ts, size) if session else (F.window(ts, size, slide) if slide else F.window(ts, size))
    out = marked.groupBy(win.alias("w"), *(by or [])).agg(*[a.alias(n) for n, a in aggs.items()])
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *(by or []), *aggs)


def stream_dedupe(sdf: DataFrame, keys: list[str], ts: str, watermark: str) -> DataFrame:
    """First row seen per key; state is dropped after the watermark."""
    return _timed(sdf, ts).withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)


def dedupe_with_late(sdf: DataFrame, keys: list[str], ts: str, delay: str) -> tuple[DataFrame, DataFrame]:
    """First row of each key, and the rows that came too late to tell; both with the number of their chunk.

    A row is late if its time lies more than ``delay`` before the latest time of
    the chunks before its own, or is missing. Late rows are not dropped but handed
    back, so no key is lost in whatever order the files come. Keys are remembered
    until a row as late as their latest one would be late, so the state is bounded by the delay.
    It is a table per chunk in the shared folder: a chunk that runs again after a
    failure reads the state of the one before and writes the same rows.
    """
    spark = sdf.sparkSession
    base = scratch_path(spark, "dedupe")
    kind = T.StructType([*sdf.schema.fields, T.StructField("chunk", T.IntegerType())])
    known = T.StructType([*[sdf.schema[k] for k in keys], T.StructField("__at", T.TimestampType())])

    def step(chunk: DataFrame, number: int) -> None:
        rows = chunk.withColumn("__at", F.col(ts).cast("timestamp"))
        seen = spark.read.schema(known).parquet(f"{base}/seen/{number - 1}") if number else spark.createDataFrame([], known)
        mark = spark.read.parquet(f"{base}/mark/{number - 1}").first()["mark"] if number else None
        on_time = F.col("__at").isNotNull() if mark is None else F.coalesce(F.col("__at") >= F.lit(mark), F.lit(False))
        rows.where(~on_time).drop("__at").write.mode("overwrite").parquet(f"{base}/late/chunk={number}")
        first = first_rows(rows.where(on_time), 1, ["__at"], keys)
        other = seen.select(*[F.col(k).alias(f"__k_{k}") for k in keys])
        new = first.join(other, O.null_safe(first, other, keys, [f"__k_{k}" for k in keys]), "left_anti")
        new.drop("__at").write.mode("overwrite").parquet(f"{base}/kept/chunk={number}")
        latest = rows.agg(F.greatest(F.max("__at") - F.expr(f"INTERVAL {delay}"), F.lit(mark).cast("timestamp")).alias("mark"))
        latest.write.mode("overwrite").parquet(f"{base}/mark/{number}")
        after = spark.read.parquet(f"{base}/mark/{number}").first()["mark"]
        both = seen.unionByName(rows.where(on_time).select(*keys, "__at")).groupBy(*keys).agg(F.max("__at").alias("__at"))
        both.where(F.col("__at") >= F.lit(after)).write.mode("overwrite").parquet(f"{base}/seen/{number}")

    each_chunk(sdf, step)

    def read(part: str) -> DataFrame:
        try:
            return spark.read.schema(kind).parquet(f"{base}/{part}")
        except AnalysisException:  # no chunk, no folder
            return spark.createDataFrame([], kind)

    return read("kept"), read("late")
