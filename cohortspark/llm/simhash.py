"""SimHash near-dedup: pigeonhole blocks, join on blocks, Hamming check.

A fingerprint of 64 bits is cut into ``blocks`` blocks. Two fingerprints that
differ in at most ``max_bits`` bits agree in at least blocks - max_bits of them,
so they meet under one choice of that many blocks. All copies of a fingerprint
count once: the work follows the number of different fingerprints.

A block value that more than ``crowd`` fingerprints share is not paired up. Its
fingerprints are linked through their neighbours at half the distance instead:
two of them are within ``max_bits`` bits if and only if they have a common
neighbour within max_bits / 2 bits, so each gives a fixed number of rows and is
linked to the smallest one it meets. No link is lost and no pairs are built.

Defined cases: null and empty texts have the fingerprint zero, which is linked
like any other. Repeated rows have equal fingerprints and one component. A
component is named by its smallest id; ids that are null do not name one. Other
columns of the input are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import components, map_batches, store

STEP = 1 << 16


def shingle_hashes(text: bytes, width: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``width`` words, in arrays of limited length."""
    words = text.lower().split()  # on bytes: A-Z, and the blanks 20 and 09 to 0D
    if not words:
        return
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ends = ends[min(width, len(words)) - 1:]
    starts, digest = starts[:len(ends)], xxhash.xxh64_intdigest
    for i in range(0, len(ends), STEP):
        spans = zip(starts[i:i + STEP].tolist(), ends[i:i + STEP].tolist(), strict=True)
        yield np.fromiter((digest(flat[s:e], seed) for s, e in spans), np.uint64, len(ends[i:i + STEP]))


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """64 bits, each set if over half of the shingle hashes have it set."""
    count, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text or b"", width, seed):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.uint32)
        n += len(hashes)
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """doc, sig, fp: the fingerprint (as a signed long) of each row's whole text; sig is the hash of the text."""
    def scan(batches):
        for batch in batches:
            got = [fingerprint(t.as_py(), width, seed) for t in batch.column("body")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("sig"), pa.array(np.array(got, np.uint64).view(np.int64))], ["doc", "sig", "fp"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    return map_batches(docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("sig"), text.cast("binary").alias("body")), scan, "doc long, sig long, fp long")


def block_masks(max_bits: int, blocks: int) -> list[int]:
    """Masks of every choice of blocks - max_bits blocks, as signed longs."""
    if not 0 <= max_bits < blocks <= 64:
        raise ValueError("more blocks than max_bits are needed, 64 at most")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [int(np.uint64(sum(c)).astype(np.int64)) for c in combinations(parts, blocks - max_bits)]


def neighbour_masks(radius: int) -> list[int]:
    """All masks of at most ``radius`` bits, as signed longs."""
    return [int(np.uint64(sum(1 << b for b in c)).astype(np.int64)) for r in range(radius + 1) for c in combinations(range(64), r)]


def close_links(points: DataFrame, max_bits: int = 2, blocks: int = 4, crowd: int = 200) -> DataFrame:
    """Links (a, b) that join all fingerprints of ``points`` (fp, no repeats) within ``max_bits`` bits, some through others."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: an odd distance has no middle")
    masks = F.array(*[F.lit(m) for m in block_masks(max_bits, blocks)])
    keys = store(points.select("fp", F.posexplode(masks).alias("choice", "mask")).select(
        "fp", "choice", F.col("fp").bitwiseAND(F.col("mask")).alias("block")), "blocks")
    sizes = keys.groupBy("choice", "block").count().where("count > 1")
    few = keys.join(sizes.where(F.col("count") <= crowd).drop("count"), ["choice", "block"])
    a, b = few.alias("a"), few.alias("b")
    near = a.join(b, [F.col("a.choice") == F.col("b.choice"), F.col("a.block") == F.col("b.block"), F.col("a.fp") < F.col("b.fp"),
                      F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits]).select(
        F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    many = keys.join(sizes.where(F.col("count") > crowd).drop("count"), ["choice", "block"], "left_semi").select("fp").distinct()
    flips = F.array(*[F.lit(m) for m in neighbour_masks(max_bits // 2)])
    met = many.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
    low = met.groupBy("at").agg(F.min("fp").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    star = met.join(low, "at").where("fp <> low").select(F.col("low").alias("a"), F.col("fp").alias("b"))
    return near.unionByName(star)


def groups(prints: DataFrame, max_bits: int = 2, blocks: int = 4, crowd: int = 200) -> DataFrame:
    """doc, sig, fp, root, component: the smallest id reachable by links of at most ``max_bits`` bits; root names the same component by a fingerprint."""
    prints = store(prints, "prints")
    points = store(prints.groupBy("fp").agg(F.min("doc").alias("low")), "points")
    roots = components(close_links(points.select("fp"), max_bits, blocks, crowd))
    named = store(points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")), "roots")
    names = named.groupBy("root").agg(F.min("low").alias("component"))
    return prints.join(named.join(names, "root").select("fp", "root", "component"), "fp").select("doc", "sig", "fp", "root", "component")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 2, **how) -> DataFrame:
    """The rows of ``docs`` less near copies: of each component the row with the smallest id and text hash stays, once; null ids come last."""
    grouped = groups(fingerprints(docs, id_col, text_col, **how), max_bits)
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("doc").isNull(), "doc", "sig")).alias("one"))
    keep = first.select(F.col("one.doc").alias("__doc"), F.col("one.sig").alias("__sig"))
    d = docs.withColumn("__key", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    kept = d.join(keep, d[id_col].eqNullSafe(keep["__doc"]) & (d["__key"] == keep["__sig"]), "left_semi")
    return kept.dropDuplicates([id_col, "__key"]).drop("__key")
