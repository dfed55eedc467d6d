"""Corpus pipeline: quality, repeated lines, near copies, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before has kept; ``run`` stores each result in the shared folder and reads it
back. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm import decontaminate, line_dedup, packing, quality_gam, simhash
from cohortspark.llm.common import store
from cohortspark.session import tune


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality model scores at 0.3 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_gam.accepted(docs, labels, threshold=0.3)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more hold stay in the first of them only; all rows stay."""
    marks = line_dedup.line_bitmaps(docs, keep="first", min_documents=10)
    text = F.when(F.col("__n_dropped") > 0, F.array_join("__lines", "\n")).otherwise(F.col("text"))
    size = F.when(F.col("__n_dropped") > 0, F.char_length(F.array_join("__lines", "\n")).cast("long")).otherwise(F.col("n_chars"))
    return line_dedup.apply_bitmaps(docs, marks).withColumns({"text": text, "n_chars": size}).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of fingerprints linked at two bits or fewer."""
    return simhash.representatives(docs, width=3, seed=42, max_bits=2)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any ten words in a row of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all rows and their places in sequences of 2048."""
    placed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)
    return placed.select(F.col("doc").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("leaks", leaks), ("sequences", sequences)]

# A learned model and a tokenizer are beyond SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
