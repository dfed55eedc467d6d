"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes. Every token points to the token of the other
side that overlaps it and reaches farthest to the right; a token whose end both
sides share points to the one of the second side that ends there. Successors are
doubled, for all tokens of a slice of texts at once, until nothing changes: then
each token points to the terminal token of its component, which labels its group.

A link is a pair of tokens whose bytes overlap. Counts of id pairs over the whole
corpus go back to the links in two steps: a task counts the pairs of a shard of
texts, the counts of all shards are added, and each shard gets the totals of its
own pairs. What is stored for a text is the multiset of its pairs, as small steps
between their sorted numbers in the shard.

Defined cases: null and empty texts have no tokens, and neither have texts whose
tokens do not give back a space and the text (a piece that shows a space as
U+2581 cannot be told from that character). Rows are handled each by itself:
repeated ids and texts count each time, null ids stay. Extra columns are neither
read nor returned. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import map_batches, store
from cohortspark.llm.tokens import byte_bpe, piece_bpe

SLICE_BYTES = 1 << 19
SHARD_LINKS = 3_000_000
SHARD = ("shard long, doc array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, "
         "n_pairs array<long>, steps binary, pairs array<long>, counts array<long>")


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray, before_a: np.ndarray, before_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal token (number in the second side) of every token of both sides.

    ``before_a[x]`` counts the tokens of the first side that end at byte x or
    earlier, so it is the number of the token that holds byte x.
    """
    n = len(ends_a)
    succ = np.empty(n + len(ends_b), np.int32)
    succ[:n] = n + before_b[ends_a - 1]
    over = before_a[ends_b - 1]
    succ[n:] = np.where(ends_a[over] > ends_b, over, n + np.arange(len(ends_b)))
    while True:
        jump = succ[succ]
        if np.array_equal(jump, succ):
            return succ[:n] - n, succ[n:] - n
        succ = jump


class Aligned:
    """A slice of texts with both tokenizations; ``kept`` are the texts that have tokens, in order."""

    def __init__(self, first, second, texts: list[str | None]):
        full = [i for i, t in enumerate(texts) if t]
        a = [np.array(first.ids(" " + texts[i]), np.int64) for i in full]
        b = [np.array(x, np.int64) for x in second.ids([texts[i] for i in full])] if full else []
        size = np.array([len(texts[i].encode()) + 1 for i in full], np.int64)
        la, lb = first.vocabulary.lengths, second.vocabulary.lengths
        same = [i for i in range(len(full)) if la[a[i]].sum() == size[i] == lb[b[i]].sum()]
        if same:
            source = np.frombuffer("".join(" " + texts[full[i]] for i in same).encode(), np.uint8)
            differ = first.vocabulary.text(np.concatenate([a[i] for i in same])) != source
            differ |= second.vocabulary.text(np.concatenate([b[i] for i in same])) != source
            starts = np.cumsum(size[same]) - size[same]
            wrong = np.logical_or.reduceat(differ, starts)
            same = [i for i, w in zip(same, wrong) if not w]
        self.kept = [full[i] for i in same]
        none = np.zeros(0, np.int64)
        self.a, self.b = np.concatenate([none, *(a[i] for i in same)]), np.concatenate([none, *(b[i] for i in same)])
        self.n_a, self.n_b = np.array([len(a[i]) for i in same], np.int64), np.array([len(b[i]) for i in same], np.int64)
        self.stops = np.cumsum(size[same])  # of the texts, in bytes
        self.ends_a, self.ends_b = np.cumsum(la[self.a]), np.cumsum(lb[self.b])
        total = int(self.stops[-1]) if same else 0
        is_a, is_b = np.zeros(total + 1, np.int8), np.zeros(total + 1, np.int8)
        is_a[self.ends_a], is_b[self.ends_b] = 1, 1
        self.before_a, self.before_b = np.cumsum(is_a, dtype=np.int32), np.cumsum(is_b, dtype=np.int32)
        self.cuts = np.flatnonzero(is_a | is_b)
        self.label_a, self.label_b = groups_of(self.ends_a, self.ends_b, self.before_a, self.before_b)
        self.heads = np.flatnonzero(self.label_b == np.arange(len(self.label_b)))  # terminal tokens, one for each group
        self.n_groups = np.diff(np.searchsorted(self.ends_b[self.heads], self.stops, "right"), prepend=0)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both tokens of every link, and the links of each text: between two cuts lies one token of each side."""
        at = self.cuts - 1
        return self.a[self.before_a[at]], self.b[self.before_b[at]], np.diff(np.searchsorted(self.cuts, self.stops, "right"), prepend=0)

    def group_bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the tokens of each group stop, in both sides."""
        return self.before_a[self.ends_b[self.heads]].astype(np.int64), self.heads + 1

    def written(self, table: np.ndarray, width: np.ndarray, size_a: int, size_b: int) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` of every text."""
        stop_a, stop_b = self.group_bounds()
        if not len(stop_a):
            return []
        rank = np.cumsum(self.label_b == np.arange(len(self.label_b))) - 1
        group_a, group_b = rank[self.label_a], rank[self.label_b]
        # the tokens of a group in a row, its first side before its second
        at_a = np.arange(len(self.a)) + np.append(0, stop_b)[group_a]
        at_b = np.arange(len(self.b)) + stop_a[group_b]
        row = np.empty(len(self.a) + len(self.b), np.int64)
        size = max(size_a, size_b)
        row[at_a], row[at_b] = self.a, self.b
        row[at_a[stop_a - 1]] += size
        row[at_b[stop_b - 1]] += 2 * size
        letters = width[row]
        flat = table[row][np.arange(table.shape[1]) < letters[:, None]].tobytes()
        ends = np.cumsum(letters)[np.cumsum(self.n_a + self.n_b) - 1]
        return [flat[s:e - 1] for s, e in zip([0, *ends[:-1].tolist()], ends.tolist())]


def decimal_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """ASCII digits of every id below ``size`` with a separator behind them: `,` then `|` then `;`; and their number."""
    digits = len(str(size))
    rows = np.zeros((3 * size, digits + 1), np.uint8)
    n = np.arange(size)
    count = np.maximum(1, np.floor(np.log10(np.maximum(n, 1)) + 1e-9).astype(np.int64) + 1)
    for part, mark in enumerate(b",|;"):
        block = rows[part * size:(part + 1) * size]
        for k in range(digits):
            has = count > k
            block[has, k] = 48 + n[has] // 10 ** (count[has] - 1 - k) % 10
        block[n, count] = mark
    return rows, np.tile(count + 1, 3)


def to_steps(values: np.ndarray) -> bytes:
    """Numbers in groups of seven bits, the high bit set on all but the last group of each."""
    size = 1 + sum((values >= 1 << 7 * k).astype(np.int64) for k in range(1, 9))
    ends = np.cumsum(size)
    k = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size)
    out = (np.repeat(values, size) >> 7 * k) & 127
    out[k < np.repeat(size, size) - 1] |= 128
    return out.astype(np.uint8).tobytes()


def from_steps(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 128)
    if not len(ends):
        return np.zeros(0, np.int64)
    starts = np.append(0, ends[:-1] + 1)
    k = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << 7 * k, starts)


def slices_of(batches: Iterator[pa.RecordBatch], size: int):
    """(ids, texts) in runs of about ``size`` characters."""
    for batch in batches:
        ids, texts = batch.column("doc").to_pylist(), batch.column("body")
        start, held, taken = 0, [], 0
        for i in range(len(ids)):
            text = texts[i].as_py()
            held.append(text)
            taken += len(text or "")
            if taken >= size or i + 1 == len(ids):
                yield ids[start:i + 1], held
                start, held, taken = i + 1, [], 0


def shards(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text", shard_links: int = SHARD_LINKS) -> DataFrame:
    """SHARD: one row for about ``shard_links`` links; numbers of each text, its pairs as steps, and the shard's pairs (a * size of b + b) with counts."""
    def pack(shard: int, held: list[dict], parts: list[np.ndarray]):
        codes = pa.chunked_array([pa.array(p) for p in parts]).combine_chunks() if parts else pa.array([], pa.int64())
        coded = codes.dictionary_encode()
        number = coded.indices.to_numpy().astype(np.int64)
        found = np.bincount(number, minlength=len(coded.dictionary))
        # frequent pairs get small numbers, so steps are small
        by = np.argsort(-found, kind="stable")
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        links = np.concatenate([h["n_links"] for h in held])
        key = np.sort(np.repeat(np.arange(len(links)), links) << 32 | rank[number])
        head = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.diff(np.append(head, len(key)))
        text, value = key[head] >> 32, key[head] & 0xFFFFFFFF
        step = np.diff(value, prepend=0)
        fresh = np.diff(text, prepend=-1) != 0
        step[fresh] = value[fresh]
        row = {"shard": shard, "n_pairs": np.bincount(text, minlength=len(links)),
               "steps": to_steps(np.stack([step, times - 1], axis=1).ravel()),
               "pairs": coded.dictionary.to_numpy()[by], "counts": found[by], "groups": [g for h in held for g in h["groups"]],
               "doc": [d for h in held for d in h["doc"]]}
        row |= {c: np.concatenate([h[c] for h in held]) for c in ("n_a", "n_b", "n_groups", "n_links")}
        kinds = {"shard": pa.int64(), "steps": pa.binary(), "groups": pa.list_(pa.string())}
        names = [x.split()[0] for x in SHARD.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([row[c]], kinds.get(c, pa.list_(pa.int64()))) for c in names], names)

    def scan(batches):
        from pyspark import TaskContext

        a, b = byte_bpe(first, special=False), piece_bpe(second)
        size = max(a.vocabulary.size, b.vocabulary.size)
        table, width = decimal_table(size)
        shard, held, parts, n = TaskContext.get().partitionId() << 32, [], [], 0
        for ids, texts in slices_of(batches, SLICE_BYTES):
            both = Aligned(a, b, texts)
            la, lb, n_links = both.links()
            parts.append(la * b.vocabulary.size + lb)
            row = {c: np.zeros(len(ids), np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
            row["n_a"][both.kept], row["n_b"][both.kept], row["n_groups"][both.kept], row["n_links"][both.kept] = both.n_a, both.n_b, both.n_groups, n_links
            groups = [""] * len(ids)
            for i, g in zip(both.kept, both.written(table, width, a.vocabulary.size, b.vocabulary.size)):
                groups[i] = hashlib.sha256(g).hexdigest()
            held.append(row | {"doc": ids, "groups": groups})
            n += len(la)
            if n >= shard_links:
                yield pack(shard, held, parts)
                shard, held, parts, n = shard + 1, [], [], 0
        if held:
            yield pack(shard, held, parts)

    return map_batches(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body")), scan, SHARD)


def piece_size(model: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model).get_piece_size()


def pair_counts(parts: DataFrame, size_b: int) -> DataFrame:
    """a, b, n: links of the whole corpus that hold an id pair; from SHARD rows."""
    each = parts.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
    return each.select(F.expr(f"pair div {size_b}").alias("a"), (F.col("pair") % size_b).alias("b"), "n")


def align(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text", shard_links: int = SHARD_LINKS) -> tuple[DataFrame, DataFrame]:
    """Numbers of each text, and the corpus-wide pair counts (a, b, n).

    The first has doc, n_a, n_b, n_groups, n_links, n_best (links whose count is
    the highest of their second id), count_sum, groups (SHA-256 of the groups as text).
    """
    parts = store(shards(docs, first, second, id_col, text_col, shard_links), "alignment")
    size_b = piece_size(second)
    counts = store(pair_counts(parts, size_b), "pair-counts")
    # at most one row for each id of the second vocabulary
    best = F.broadcast(counts.groupBy("b").agg(F.max("n").alias("top")))
    totals = counts.join(best, "b").select((F.col("a") * size_b + F.col("b")).alias("pair"), "n", (F.col("n") == F.col("top")).alias("best"))
    own = parts.select("shard", F.posexplode("pairs").alias("at", "pair")).join(totals, "pair")
    # a row holds the pairs of one shard, not more than its links
    back = own.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("at", "n", "best"))).alias("own")).select(
        "shard", F.col("own.n").alias("totals"), F.col("own.best").alias("best"))
    rows = parts.drop("pairs", "counts").join(back, "shard", "left")
    names = ["doc", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

    def look(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: batch.column(c)[i].values
                sizes = get("n_pairs").to_numpy()
                raw = from_steps(batch.column("steps")[i].as_py()).reshape(-1, 2)
                value, times = np.cumsum(raw[:, 0]), raw[:, 1] + 1
                starts = np.cumsum(sizes) - sizes
                # steps start anew with each text
                value -= np.repeat(np.append(0, value)[starts], sizes)
                if len(value):
                    n, top = get("totals").to_numpy()[value], get("best").to_numpy(zero_copy_only=False)[value]
                else:
                    n, top = np.zeros(0, np.int64), np.zeros(0, bool)
                both = [np.diff(np.append(0, np.cumsum(x))[np.append(starts, len(value))]) for x in (times * top, times * n)]
                cols = [get("doc"), get("n_a"), get("n_b"), get("n_groups"), get("n_links"), *map(pa.array, both), get("groups")]
                yield pa.RecordBatch.from_arrays(cols, names)

    return map_batches(rows, look, "doc long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"), counts


def token_groups(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, groups: the ids of both sides in each group, and the bytes it ends at (the space in front counts), of texts with tokens."""
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("stop", pa.int64())]))

    def scan(batches):
        a, b = byte_bpe(first, special=False), piece_bpe(second)
        for ids, texts in slices_of(batches, SLICE_BYTES):
            both = Aligned(a, b, texts)
            stop_a, stop_b = both.group_bounds()
            start_a, start_b = np.append(0, stop_a), np.append(0, stop_b)
            last = np.cumsum(both.n_groups)
            first_byte = np.append(0, both.stops)
            out = [[{"a": both.a[start_a[g]:stop_a[g]], "b": both.b[start_b[g]:stop_b[g]], "stop": int(both.ends_b[both.heads[g]] - first_byte[k])}
                    for g in range(e - n, e)] for k, (n, e) in enumerate(zip(both.n_groups.tolist(), last.tolist()))]
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in both.kept], pa.int64()), pa.array(out, kind)], ["doc", "groups"])

    return map_batches(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body")), scan,
                       "doc long, groups array<struct<a:array<int>,b:array<int>,stop:long>>")
