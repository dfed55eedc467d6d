"""Best-fit packing planned on the histogram of lengths.

Documents become token pieces of at most ``capacity`` tokens. The plan sees only
how many pieces have which length: the longest come first, and each goes where
the least room stays (best fit). All sequences with the same room are one entry,
so that the plan has a few entries for each length, however many documents there
are: an entry changes its room at most log2(capacity) times, as what stays is
less than half of it. A piece takes the slot that its rank within its length
has in the plan.

Ranks are counted in chunks of a length, so a length that a third of all pieces
share is not one task. Only the histogram, at most ``capacity`` rows, comes to
the driver, and only the plan, bounded by ``capacity`` too, goes to the tasks.

Defined cases: null text is empty text, one piece that holds the end id alone.
Repeated rows are packed each. Ids that are null stay null. Extra columns are
neither read nor returned.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import map_batches, store
from cohortspark.llm.tokens import byte_bpe


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """doc, sig, piece, start, length, crc (and ids): the pieces of every document, with ``end_id`` behind its tokens.

    Only documents longer than ``capacity`` are cut; then the first piece takes
    what does not fill one. ``crc`` is the CRC-32 of the ids as little-endian
    unsigned 32-bit numbers, ``sig`` the hash of the text.
    """
    names = ["doc", "sig", "piece", "start", "length", "crc"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids

    def cut(batches):
        bpe = byte_bpe(tokenizer, special=True)
        for batch in batches:
            rows: list[tuple] = []
            for doc, sig, body in zip(batch.column("doc").to_pylist(), batch.column("sig").to_pylist(), batch.column("body"), strict=True):
                ids = np.array([*bpe.ids(body.as_py()), end_id], "<u4")
                head = (len(ids) - 1) % capacity + 1
                for k, stop in enumerate(range(head, len(ids) + 1, capacity)):
                    start = max(0, stop - capacity) if k else 0
                    own = ids[start:stop]
                    rows.append((doc, sig, k, start, stop - start, zlib.crc32(own.tobytes())) + ((own.astype(np.int32),) if with_ids else ()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    text = F.coalesce(F.col(text_col), F.lit(""))
    return map_batches(
        docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("sig"), text.alias("body")), cut, "doc long, sig long, piece int, start long, length long, crc long" + ", ids array<int>" * with_ids)


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Plan from piece counts by length: runs (length, first rank, pieces in a sequence, first sequence, offset), and the sequences used.

    Piece ``rank`` of a run lies in sequence first + (rank - first rank) // per
    at offset + (rank - first rank) % per * length.
    """
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError("a piece does not fit")
    rooms: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    runs, used = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if not rooms.get(room):
                insort(order, room)
            rooms.setdefault(room, []).append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(order, length)
            if at == len(order):
                new = -(-left // (capacity // length))
                put(capacity, used, new)
                used += new
                continue
            room = order[at]
            first, n = rooms[room].pop()
            if not rooms[room]:
                order.pop(at)
            per = room // length
            full = min(n, left // per)
            placed = full * per or left
            runs.append((length, rank, per, first, capacity - room))
            put(room - (per if full else left) * length, first, full or 1)
            put(room, first + (full or 1), n - (full or 1))
            rank, left = rank + placed, left - placed
    return runs, used


def place(parts: DataFrame, capacity: int = 2048, chunk_rows: int = 200_000) -> DataFrame:
    """``parts`` (doc, sig, piece, length, ...) plus sequence_id and offset: as few sequences as best fit gives, without gaps."""
    histogram = {r.length: r.n for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # some 4,096 chunks for all, so that a frequent length has many; more where these get too large
    size = min(chunk_rows, max(1, sum(histogram.values()) // 4096))
    chunks = parts.sparkSession.createDataFrame([(k, -(-n // size)) for k, n in histogram.items()], "length long, chunks long")
    parts = parts.join(F.broadcast(chunks), "length").withColumn("chunk", F.pmod(F.xxhash64("doc", "sig", "piece"), "chunks")).drop("chunks")
    counts = store(parts.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n")), "lengths")
    runs, _ = best_fit(histogram, capacity)
    table = np.array(runs, np.int64).reshape(-1, 5)
    shared = parts.sparkSession.sparkContext.broadcast(table)
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select("length", "chunk", "base")
    rank = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("doc", "sig", "piece")) - 1
    ranked = parts.withColumn("rank", rank).join(base, ["length", "chunk"]).withColumn("rank", F.col("rank") + F.col("base")).drop("base", "chunk")
    out = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    def take(batches):
        t = shared.value
        t = t[np.lexsort((t[:, 1], t[:, 0]))]
        scale = int(t[:, 1].max(initial=0)) + 1
        key = t[:, 0] * scale + t[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            run = t[np.searchsorted(key, length * scale + np.minimum(rank, scale - 1), "right") - 1]
            nth = rank - run[:, 1]
            cols = {n: batch.column(n) for n in batch.schema.names if n != "rank"}
            cols |= {"sequence_id": pa.array(run[:, 3] + nth // run[:, 2]), "offset": pa.array(run[:, 4] + nth % run[:, 2] * length)}
            yield pa.RecordBatch.from_pydict({n: cols[n] for n in out.names})

    return map_batches(ranked, take, out)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text",
         with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; see ``pieces`` and ``place``."""
    return place(store(pieces(docs, tokenizer, end_id, capacity, id_col, text_col, with_ids), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids, docs: the packed token sequences of pieces with ids, and the pieces' documents in order."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "doc", "piece", "ids")))
    return placed.groupBy("sequence_id").agg(inside.alias("parts")).select(
        "sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), F.transform("parts", lambda p: p["doc"]).alias("docs"))
