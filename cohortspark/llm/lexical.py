"""Ranked lexical search: NRA over impact-sorted lists, shard by shard.

A first pass counts the terms of the queries in every document. Tasks write them
as shards: for each term the documents of the shard and how often they hold it.
The sums over all shards give the corpus figures and the weight of each term; with
them an impact is a whole number, and a score the sum of the impacts.

In a shard, the list of a term is sorted by falling impact. A query reads its
lists from the top, some entries further in each round, and never looks up a
document in a list (no random access). A document's score lies between the
impacts read so far and these plus, for each list in which it was not met, the
next impact there. With the k-th best lower end no list has to go on for
documents whose upper end lies below it, nor for documents never met once the next
impacts add up to less. Reading goes on, in the lists that still lack one of the
remaining documents, until each of them has both ends equal; ties with the k-th
stay in until the end. So a shard's best are whole and exact, and the best of all
shards are the best of all documents.

Queries are a stated set: they reach the tasks in blocks of at most
``block_words`` words, one broadcast at a time, and every block meets all rows.

Defined cases: null and empty texts have no terms, are no result and count in no
figure; a query without terms has no result. Every query row is a query of its
own, also where an id repeats. Repeated documents are ranked each. Null document
ids come last among equal scores. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import map_batches, store
from cohortspark.llm.decontaminate import blocks_of, words_of

SHARD_POSTINGS = 3_000_000
FIRST_READ = 256
# Documents with a term, all their terms; of documents with a query term id and size; and the lists: term, its length, places and counts.
SHARD = "n long, total long, doc array<long>, size array<long>, term array<int>, length array<long>, place array<int>, times array<int>"
HIT = "query long, item long, doc long, score long"


class Block:
    """The distinct terms of some queries, numbered."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], first: int):
        texts = [words_of(t) for _, t in items]
        self.first, self.ids = first, [i for i, _ in items]
        self.code = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}))}
        self.terms = [sorted({self.code[w] for w in t}) for t in texts]


def postings(docs: DataFrame, block, id_col: str, text_col: str, shard_postings: int) -> DataFrame:
    """SHARD rows for the terms of a broadcast Block."""
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
    names = [x.split()[0] for x in SHARD.split(", ")]

    def scan(batches):
        get = block.value.code.get

        def row(n, total, ids, sizes, terms, times):
            counts = np.array([len(t) for t in terms], np.int64)
            term = np.concatenate([np.zeros(0, np.int64), *terms])
            place, often = np.repeat(np.arange(len(counts)), counts), np.concatenate([np.zeros(0, np.int64), *times])
            by = np.argsort(term, kind="stable")
            head = np.flatnonzero(np.diff(term[by], prepend=-1))
            cols = [n, total, ids, sizes, term[by][head], np.diff(np.append(head, len(by))), place[by], often[by]]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cols, kinds)], names)

        n, total, held, ids, sizes, terms, times = 0, 0, 0, [], [], [], []
        for batch in batches:
            for doc, body in zip(batch.column("doc").to_pylist(), batch.column("body")):
                words = words_of(body.as_py())
                n, total = n + bool(words), total + len(words)
                found = np.array([k for k in map(get, words) if k is not None], np.int64)
                if len(found):
                    term, often = np.unique(found, return_counts=True)
                    ids.append(doc)
                    sizes.append(len(words))
                    terms.append(term)
                    times.append(often)
                    held += len(term)
                if held >= shard_postings:
                    yield row(n, total, ids, sizes, terms, times)
                    n, total, held, ids, sizes, terms, times = 0, 0, 0, [], [], [], []
        if n:
            yield row(n, total, ids, sizes, terms, times)

    return map_batches(docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("binary").alias("body")), scan, SHARD)


def weights(shards: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the weight of each query term; as many numbers as the block has terms."""
    n, total = shards.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    held = shards.select(F.explode(F.arrays_zip("term", "length")).alias("t")).groupBy("t.term").agg(F.sum("t.length").alias("df"))
    weight = np.zeros(terms, np.int64)
    for r in held.collect():
        weight[r.term] = math.floor(1000 * math.log((2 * n + 2) / (2 * r.df + 1)))
    return n, total, weight


def impacts(weight: np.ndarray, times: np.ndarray, size: np.ndarray, n: int, total: int) -> np.ndarray:
    """Whole-number impact of a term that a document of ``size`` terms holds ``times`` times."""
    if 50 * int(size.max(initial=0)) * n < 1 << 62:
        spread = 50 * size * n // total
    else:
        spread = np.array([50 * int(s) * n // total for s in size], np.int64)
    return weight * (1_000_000_000 * times // (1000 * times + 20 * (50 + spread)))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], k: int, n_docs: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and exact scores of all documents that can be among the k best, ties with the k-th included, and the entries read.

    ``lists`` holds (places, impacts) by falling impact; impacts are above 0 and
    a place is once in a list.
    """
    low = np.zeros(n_docs, np.int64)
    met = np.zeros((n_docs, -(-len(lists) // 8)), np.uint8)
    at = [0] * len(lists)
    ahead = np.array([v[0] if len(v) else 0 for _, v in lists], np.int64)  # next impact of each list
    size, reading = FIRST_READ, [t for t, v in enumerate(ahead) if v]
    left = None  # the documents that can still be among the best; none yet while documents not met can be

    def not_met(docs, t):
        return (met[docs, t >> 3] >> (t & 7) & 1) == 0

    while reading:
        for t in reading:
            places, values = lists[t]
            new = slice(at[t], at[t] + size)
            low[places[new]] += values[new]
            met[places[new], t >> 3] |= 1 << (t & 7)
            at[t] = min(at[t] + size, len(places))
            ahead[t] = values[at[t]] if at[t] < len(places) else 0
        size *= 2
        docs = np.flatnonzero(low) if left is None else left
        least = np.partition(low[docs], len(docs) - k)[len(docs) - k] if len(docs) >= k else 0
        if left is None and ahead.sum() >= max(least, 1):
            reading = [t for t in reading if ahead[t]]
            continue
        docs = docs[low[docs] + ahead.sum() >= least]
        high = low[docs].copy()
        for t in np.flatnonzero(ahead):
            high += ahead[t] * not_met(docs, t)
        left = docs[high >= least]
        # a list goes on while a remaining document was not met in it
        reading = [t for t in np.flatnonzero(ahead).tolist() if not_met(left, t).any()]
    left = np.flatnonzero(low) if left is None else left
    return left, low[left], sum(at)


def best_in_shard(row: dict, block: Block, n: int, total: int, weight: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """query number, places and scores of the k best, best first, of each query with a result."""
    term = np.repeat(row["term"], row["length"])
    value = impacts(weight[term], row["times"], row["size"][row["place"]], n, total)
    by = np.lexsort((row["place"], -value, term))
    by = by[value[by] > 0]
    place, value, term = row["place"][by], value[by], term[by]
    bound = np.searchsorted(term, np.arange(len(weight) + 1))
    # places are numbered by rising id, so that ties keep the smaller one
    for q, terms in enumerate(block.terms):
        lists = [(place[bound[t]:bound[t + 1]], value[bound[t]:bound[t + 1]]) for t in terms if bound[t] < bound[t + 1]]
        if lists:
            docs, scores, _ = nra(lists, k, len(row["doc"]))
            top = np.lexsort((row["rank"][docs], -scores))[:k]
            yield q, docs[top], scores[top]


def search_block(docs: DataFrame, items: list, first: int, k: int, id_col: str, text_col: str, shard_postings: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    block = Block(items, first)
    shared = context.broadcast(block)
    shards = store(postings(docs, shared, id_col, text_col, shard_postings), "postings")
    figures = context.broadcast(weights(shards, len(block.code)))

    def look(batches):
        block, (n, total, weight) = shared.value, figures.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("size", "term", "length", "place", "times")}
                ids = batch.column("doc")[i].values
                order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
                row["doc"], row["rank"] = ids, np.empty(len(order), np.int64)
                row["rank"][order] = np.arange(len(order))
                for q, found, scores in best_in_shard(row, block, n, total, weight, k):
                    some = len(found)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(some, block.first + q)), pa.array([block.ids[q]] * some, pa.int64()), ids.take(pa.array(found)),
                        pa.array(scores)], ["query", "item", "doc", "score"])

    return map_batches(shards, look, HIT)


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text", shard_postings: int = SHARD_POSTINGS, block_words: int = 1_000_000) -> DataFrame:
    """query (number of the item row), item, rank, doc, score: the k best documents of every item with a score above 0."""
    hits, first = None, 0
    for block in blocks_of(items, item_col, item_text, block_words):
        part = search_block(docs, block, first, k, id_col, text_col, shard_postings)
        hits = part if hits is None else hits.unionByName(part)
        first += len(block)
    order = [F.desc("score"), F.asc_nulls_last("doc")]
    # each part keeps its k best first, so that no task gets the best of all shards
    parts = hits.withColumn("part", F.spark_partition_id() % 64)
    some = parts.withColumn("r", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order))).where(F.col("r") <= k)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
    return best.select("query", "item", "rank", "doc", "score")
