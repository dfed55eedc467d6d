"""Benchmark decontamination by suffix arrays of the training text.

Each task gathers documents into shards of about ``shard_words`` words and
builds the suffix array of a shard: word positions sorted by the words that
follow, to the depth of the longest item. Every suffix of every test item is
then found in it by binary search, all at once. The interval of a suffix gives
all its places; where it ends early, the neighbours give the longest match.

Words that no item has match nothing and end a suffix; they are one symbol,
0, and suffixes do not start with them. Several words are packed into one
integer, as many as the test vocabulary allows, and suffixes that are still tied
are sorted by the next ones: the array is built by ties halving, not by
comparing texts.

Items are a stated query set: they reach the tasks in blocks of at most
``block_words`` words, one broadcast at a time, and every block meets all rows.
Between two blocks the rows are stored in the shared folder.

Defined cases: null or empty texts and texts without words have no hit; items
without words have no window. Items without id count as hits but are not
listed. Repeated rows are judged alike. An item with fewer words than
``window`` is one window. Other columns stay as they are; names that start with
two underscores are reserved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import map_batches, store

# Bytes 0-9, a-z and all of non-ASCII letters are kept, A-Z lower-cased, all others part words.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD).split()


class Tests:
    """The suffixes of a block of test items, as packed words."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int):
        self.window, self.ids = window, [i for i, _ in items]
        texts = [words_of(t) for _, t in items]
        self.code = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}), 1)}
        self.bits = max(1, len(self.code).bit_length())
        self.step = 62 // self.bits  # words in one integer
        lengths = np.array([len(t) for t in texts], np.int64)
        self.item = np.repeat(np.arange(len(texts)), lengths)
        self.offset = np.concatenate([np.arange(n) for n in lengths]) if len(self.item) else np.zeros(0, np.int64)
        self.left = lengths[self.item] - self.offset  # words from here to the end of the item
        self.depth = int(lengths.max(initial=0))
        flat = [np.concatenate([[self.code[w] for w in t], [0]]).astype(np.int64) for t in texts]
        flat = np.concatenate(flat) if flat else np.zeros(0, np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if len(texts) else np.zeros(0, np.int64)
        self.places = starts[self.item] + self.offset
        self.packed = pack(flat, self.bits, self.step)
        # a window: ``window`` words, or a whole shorter item
        whole = lengths[self.item] < window
        self.size = np.where(whole, self.left, window)
        self.opens = np.where(whole, self.offset == 0, self.left >= window)


def pack(codes: np.ndarray, bits: int, step: int) -> np.ndarray:
    """For each position the next ``step`` codes as one integer, the first one highest; zeros behind the end and after a zero."""
    out = codes.copy()
    open_ = codes > 0
    for k in range(1, step):
        after = np.zeros_like(codes)
        after[:-k or None] = codes[k:]
        after[~open_] = 0
        out = (out << bits) | after
        open_ = open_ & (after > 0)
    return out


def suffix_array(codes: np.ndarray, packed: np.ndarray, bits: int, step: int, depth: int) -> np.ndarray:
    """Positions with a code above 0 in the order of the words that follow, to ``depth`` words or the next 0."""
    order = np.flatnonzero(codes)
    order = order[np.argsort(packed[order], kind="stable")]
    last = (1 << bits) - 1
    first = np.flatnonzero(np.diff(packed[order], prepend=-1))
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))  # equal so far
    at = step
    live = np.arange(len(order))
    while at < depth and len(live):
        # only ties that can still differ: no 0 so far
        key = packed[np.minimum(order[live] + at - step, len(packed) - 1)]
        tied = np.bincount(group[live], minlength=group.max() + 1)[group[live]] > 1
        live = live[tied & (key & last > 0)]
        if not len(live):
            break
        ahead = order[live] + at
        key = np.where(ahead < len(packed), packed[np.minimum(ahead, len(packed) - 1)], 0)
        by = np.lexsort((key, group[live]))
        order[live], key, old = order[live][by], key[by], group[live]
        split = np.append(True, (np.diff(key) != 0) | (np.diff(old) != 0))
        group[live] = group.max() + np.cumsum(split)
        at += step
    return order


def search(tests: Tests, codes: np.ndarray, packed: np.ndarray, order: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each test suffix: interval of the places that share its first ``size`` words, longest match, one place of it."""
    n, bits, step = len(tests.places), tests.bits, tests.step
    lo, hi = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    longest, place = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    inside_lo, inside_hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
    open_ = np.full(n, len(order) > 0)

    def key_at(slot, at):
        p = order[np.clip(slot, 0, len(order) - 1)] + at
        return np.where(p < len(packed), packed[np.minimum(p, len(packed) - 1)], 0)

    def bound(lo, hi, at, want):
        """First slot of [lo, hi) whose key at ``at`` is not below ``want``."""
        lo, hi = lo.copy(), hi.copy()
        while (more := lo < hi).any():
            mid = (lo + hi) >> 1
            less = more & (key_at(mid, at) < want)
            lo = np.where(less, mid + 1, lo)
            hi = np.where(more & ~less, mid, hi)
        return lo

    for at in range(0, max(tests.depth, 1), step):
        if not open_.any():
            break
        p = tests.places + at
        want = np.where(p < len(tests.packed), tests.packed[np.minimum(p, len(tests.packed) - 1)], 0)
        want = np.where(at < tests.left, want, 0)
        # the window may end within these words: places that share what is left of it
        rest = np.clip(size - at, 0, step)
        ends = open_ & (rest > 0) & (size - at <= step)
        shift = bits * (step - rest)
        base = (want >> shift) << shift
        a = bound(lo, hi, at, np.where(ends, base, 0))
        b = bound(lo, hi, at, np.where(ends, base + (1 << shift), 0))
        inside_lo, inside_hi = np.where(ends, a, inside_lo), np.where(ends, b, inside_hi)
        # the longest match lies beside the place where the suffix would be
        low = bound(lo, hi, at, want)
        for slot in (low, low - 1):
            ok = open_ & (slot >= lo) & (slot < hi)
            other = key_at(slot, at)
            same = np.zeros(n, np.int64)
            for k in range(1, step + 1):
                cut = bits * (step - k)
                same += (want >> cut == other >> cut) & (want >> cut & ((1 << bits) - 1) > 0)
            better = ok & (at + same > longest)
            place = np.where(better, order[np.clip(slot, 0, len(order) - 1)], place)
            longest = np.where(better, at + same, longest)
        high = bound(lo, hi, at, want + 1)
        full = (want & ((1 << bits) - 1)) > 0
        open_ = open_ & (low < high) & full
        lo, hi = np.where(open_, low, 0), np.where(open_, high, 0)
    return inside_lo, inside_hi, longest, place


class Shard:
    """Some documents in a row as codes, a 0 behind each."""

    def __init__(self, tests: Tests, texts: list[np.ndarray]):
        self.tests = tests
        self.starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        codes = np.zeros(self.starts[-1], np.int64)
        for s, t in zip(self.starts, texts):
            codes[s:s + len(t)] = t
        self.codes, self.packed = codes, pack(codes, tests.bits, tests.step)
        self.order = suffix_array(codes, self.packed, tests.bits, tests.step, tests.depth)

    def hits(self) -> Iterator[tuple[int, list[tuple[int, int]], list[int]]]:
        """document number, spans of hit words, item numbers; only documents that are hit."""
        t = self.tests
        lo, hi, _, _ = search(t, self.codes, self.packed, self.order, t.size)
        found = np.flatnonzero(t.opens & (hi > lo))
        cover = np.zeros(len(self.codes) + 1, np.int64)
        pairs = []
        done = set()
        for k in found:
            places = self.order[lo[k]:hi[k]]
            if (lo[k], hi[k], t.size[k]) not in done:  # equal windows share an interval
                done.add((lo[k], hi[k], t.size[k]))
                cover[places] += 1
                cover[places + t.size[k]] -= 1
            docs = np.unique(np.searchsorted(self.starts, places, "right") - 1)
            pairs.append(np.stack([docs, np.full(len(docs), t.item[k])], axis=1))
        if not pairs:
            return
        pairs = np.unique(np.concatenate(pairs), axis=0)
        edge = np.flatnonzero(np.diff((np.cumsum(cover) > 0).astype(np.int8), prepend=0))
        hit, first = np.unique(pairs[:, 0], return_index=True)
        cut = np.searchsorted(edge, np.stack([self.starts[hit], self.starts[hit + 1]]))
        for d, p, q, a, b in zip(hit.tolist(), first.tolist(), [*first[1:].tolist(), len(pairs)], *cut.tolist()):
            spans = (edge[a:b] - self.starts[d]).reshape(-1, 2)
            yield d, [(x, y) for x, y in spans.tolist()], pairs[p:q, 1].tolist()

    def longest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each test suffix: words of the longest match, document number, position."""
        _, _, longest, place = search(self.tests, self.codes, self.packed, self.order, self.tests.left)
        doc = np.searchsorted(self.starts, place, "right") - 1
        return longest, doc, place - self.starts[np.maximum(doc, 0)]


def join_spans(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted([*a, *b]):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def shards(batches: Iterator[pa.RecordBatch], tests: Tests, text: str, shard_words: int):
    """Cut the rows of a task into (rows, shard)."""
    get = tests.code.get
    held, texts, size = [], [], 0
    for batch in batches:
        start = 0
        for i, body in enumerate(batch.column(text).cast(pa.binary())):
            words = words_of(body.as_py())
            texts.append(np.fromiter((get(w, 0) for w in words), np.int64, len(words)))
            size += len(words) + 1
            if size >= shard_words:
                yield [*held, batch.slice(start, i + 1 - start)], texts
                held, texts, size, start = [], [], 0, i + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield held, texts


def blocks_of(bench: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[int | None, bytes | None]]]:
    """The items in blocks of at most ``block_words`` words, or one item."""
    block, size = [], 0
    for r in bench.select(F.col(id_col).alias("item"), F.col(text_col).cast("binary").alias("body")).toLocalIterator():
        n = len(words_of(r.body and bytes(r.body)))
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((r["item"], r.body and bytes(r.body)))
        size += n
    yield block


def scan(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 10,
         shard_words: int = 1_000_000, block_words: int = 1_000_000, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (the columns ``carry``, or all) plus what was found: __n_words, __n_hit, __spans of hit words and __items, both sorted."""
    carry = docs.columns if carry is None else carry
    out = docs.select(*carry, F.col(text_col).alias("__text")).selectExpr(
        "*", "0L AS __n_words", "0L AS __n_hit", "CAST(array() AS array<struct<start:int,stop:int>>) AS __spans", "CAST(array() AS array<long>) AS __items")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    for n, items in enumerate(blocks_of(bench, item_col, item_text, block_words)):
        shared = docs.sparkSession.sparkContext.broadcast((items, window))

        def look(batches, shared=shared):
            items, window = shared.value
            tests = Tests(items, window)
            for held, texts in shards(batches, tests, "__text", shard_words):
                table = pa.Table.from_batches(held)
                spans, listed = table["__spans"].to_pylist(), table["__items"].to_pylist()
                for d, new, found in Shard(tests, texts).hits():
                    spans[d] = join_spans([(x["start"], x["stop"]) for x in spans[d]], new)
                    listed[d] = sorted({*listed[d], *(i for k in found if (i := tests.ids[k]) is not None)})
                spans = [[x if isinstance(x, dict) else {"start": x[0], "stop": x[1]} for x in s] for s in spans]
                cols = {"__n_words": pa.array([len(t) for t in texts], pa.int64()),
                        "__n_hit": pa.array([sum(x["stop"] - x["start"] for x in s) for s in spans], pa.int64()),
                        "__spans": pa.array(spans, kind), "__items": pa.array(listed, pa.list_(pa.int64()))}
                for name, col in cols.items():
                    table = table.set_column(table.column_names.index(name), name, col)
                yield from table.to_batches()

        out = map_batches(store(out, "scan") if n else out, look, out.schema)
    return out.drop("__text")


def longest_matches(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text: str = "text", shard_words: int = 1_000_000, block_words: int = 1_000_000) -> DataFrame:
    """item, item_start, length, doc, doc_start: for every test suffix that occurs its longest verbatim match, in words, and a place of it."""
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("__text"))
    parts = None
    for items in blocks_of(bench, item_col, item_text, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def look(batches, shared=shared):
            tests = Tests(shared.value, 1)
            for held, texts in shards(batches, tests, "__text", shard_words):
                ids = pa.Table.from_batches(held)["doc"].to_pylist()
                length, doc, start = Shard(tests, texts).longest()
                k = np.flatnonzero(length)
                yield pa.RecordBatch.from_arrays([
                    pa.array([tests.ids[i] for i in tests.item[k]], pa.int64()), pa.array(tests.offset[k], pa.int32()), pa.array(length[k], pa.int32()),
                    pa.array([ids[d] for d in doc[k]], pa.int64()), pa.array(start[k], pa.int32())], ["item", "item_start", "length", "doc", "doc_start"])

        part = map_batches(rows, look, "item long, item_start int, length int, doc long, doc_start int")
        parts = part if parts is None else parts.unionByName(part)
    best = F.max(F.struct("length", (-F.col("doc")).alias("d"), (-F.col("doc_start")).alias("s"))).alias("best")
    return parts.groupBy("item", "item_start").agg(best).select(
        "item", "item_start", "best.length", (-F.col("best.d")).alias("doc"), (-F.col("best.s")).alias("doc_start"))


def clean(docs: DataFrame, bench: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` without any hit."""
    return scan(docs, bench, **how).where("__n_hit = 0").select(*docs.columns)
