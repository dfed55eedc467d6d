"""Exact substring dedup by sorted suffixes, over bytes.

Every string of ``length`` bytes that starts at two places is found. Sorting the
suffix of every byte would move each text ``length`` times, so a string is stood
for by one place inside it: of its grams of GRAM bytes the one with the smallest
hash, the leftmost of equals. Equal strings have this place at the same distance
from their start, so only suffixes that start at such places, about one in 70
bytes, have to meet. A place stands for a run of strings, those that start between
``hi`` and ``lo`` bytes before it.

Places whose gram occurs once are dropped by an aggregation over gram hashes, and
places with the same bytes around them are one from there on (all their strings
repeat). The suffixes of the rest are range-partitioned by their leading bytes
with sampled splitters, ties by a hash, so that a frequent beginning is split too.
A bucket sorts its suffixes by multikey quicksort over eight bytes at a time and
takes the common prefixes of neighbours: suffixes that share enough bytes are
neighbours, and of them those that also share the bytes in front, checked for each
distance, are repeats. A bucket's first and last beginning may go on in the next
bucket. What the strings of BLOCK neighbouring distances have in common is
compared across the boundaries by 128-bit hashes, where it occurs twice that of
the parts of the block, and so on down to the strings themselves: a place has a
few rows in each step, not one for each string.

All strings are judged on the input, and every byte that a repeated one covers is
marked. Defined cases: null text is empty text; texts shorter than ``length`` lose
nothing, and matches do not cross texts. Rows that repeat an id and a text are two
texts with the same bytes, so they lose all that is long enough. Null ids are ids
of their own. Extra columns stay; names that start with two underscores are
reserved. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import map_batches, store
from cohortspark.llm.compact_windows import mix, sliding

GRAM = 32
SLICE_BYTES = 1 << 18
PLACE_BITS = 22
BUCKET_ROWS = 30_000
HOT_ROWS = 5_000
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]  # any odd numbers
PLACE = "gram long, around long, doc long, sig long, at long, lo short, hi short"
SPAN = "doc long, sig long, start long, stop long"
SUFFIX = "doc long, sig long, at long, lo short, hi short, lead binary, tie long, ahead binary, behind binary"
BLOCK = 32  # not more than GRAM, so that the strings of a block all reach over their place
PARTS = (8, 2, 1)  # distances in a part of a block, of a part of that, and so on
FOUND = SPAN + ", c1 long, c2 long, parts array<struct<w1:long,w2:long,open:boolean>>"


def grams(data: bytes) -> np.ndarray:
    """A 64-bit hash for the GRAM bytes from each place on."""
    words = mix(np.ndarray(len(data) - 7, "<u8", data, strides=(1,)).astype(np.uint64))
    n = len(data) - GRAM + 1
    return mix(sum(words[8 * k:8 * k + n] * ODD[k] for k in range(GRAM // 8)))


def runs_of(data: bytes, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first string, last string, gram) for texts in a row; a place stands for the strings that start from the first to the last."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, np.zeros(0, np.uint64)
    hashes = grams(data)
    width = length - GRAM + 1
    # the place in the low bits makes the leftmost the smallest of equal ones
    mark = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
    place = (sliding(mark[None], width, np.minimum)[0] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(place)]
    inside = np.flatnonzero(np.arange(len(place)) + length <= bounds[1:][text])
    if not len(inside):
        return none, none, none, np.zeros(0, np.uint64)
    place, text = place[inside], text[inside]
    head = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    tail = np.append(head[1:], len(inside)) - 1
    return place[head], inside[head], inside[tail], hashes[place[head]]


def slices_of(batches: Iterator[pa.RecordBatch], length: int):
    """(doc, sig, bytes) lists in runs of about SLICE_BYTES."""
    docs, sigs, texts, size = [], [], [], 0
    for batch in batches:
        for doc, sig, body in zip(batch.column("doc").to_pylist(), batch.column("sig").to_pylist(), batch.column("body")):
            if len(body.as_buffer()) < length:
                continue
            docs.append(doc)
            sigs.append(sig)
            texts.append(body.as_py())
            size += len(texts[-1])
            if size >= SLICE_BYTES:
                yield docs, sigs, texts
                docs, sigs, texts, size = [], [], [], 0
    if docs:
        yield docs, sigs, texts


def text_runs(texts: list[bytes], length: int):
    """(text numbers, places, first strings, last strings, grams), places counted in each text; long texts in parts that overlap."""
    part = 1 << 20
    if len(texts) > 1 or len(texts[0]) <= part:
        bounds = np.cumsum([0, *map(len, texts)])
        place, first, last, gram = runs_of(b"".join(texts), bounds, length)
        text = np.searchsorted(bounds, place, "right") - 1
        return text, place - bounds[text], first - bounds[text], last - bounds[text], gram
    cols: list[list] = [[], [], [], []]
    for at in range(0, max(1, len(texts[0]) - length + 1), part):
        data = texts[0][at:at + part + length - 1]
        place, first, last, gram = runs_of(data, np.array([0, len(data)]), length)
        place, first, last = place + at, first + at, last + at
        if cols[0] and len(place) and cols[0][-1][-1] == place[0]:  # the same place goes on
            cols[2][-1][-1] = last[0]
            place, first, last, gram = place[1:], first[1:], last[1:], gram[1:]
        if len(place):
            for c, v in zip(cols, (place, first, last, gram)):
                c.append(v)
    place, first, last, gram = (np.concatenate(c) for c in cols)
    return np.zeros(len(place), np.int64), place, first, last, gram


def places(rows: DataFrame, length: int) -> DataFrame:
    """PLACE for every place of ``rows`` (doc, sig, body); ``around`` is a hash of all bytes of its strings."""
    def scan(batches):
        for docs, sigs, texts in slices_of(batches, length):
            groups = [[i] for i, t in enumerate(texts) if len(t) > SLICE_BYTES]
            groups.append([i for i, t in enumerate(texts) if len(t) <= SLICE_BYTES])
            for own in groups:
                if not own:
                    continue
                text, place, first, last, gram = text_runs([texts[i] for i in own], length)
                around = np.fromiter((xxhash.xxh64_intdigest(texts[own[t]][a:b + length], a - p & 0xFFFF)
                                      for t, p, a, b in zip(text.tolist(), place.tolist(), first.tolist(), last.tolist())), np.uint64, len(text))
                doc = pa.array([docs[i] for i in own], pa.int64()).take(pa.array(text))
                sig = np.array([sigs[i] for i in own], np.int64)[text]
                yield pa.RecordBatch.from_arrays([
                    pa.array(gram.view(np.int64)), pa.array(around.view(np.int64)), doc, pa.array(sig), pa.array(place),
                    pa.array((place - last).astype(np.int16)), pa.array((place - first).astype(np.int16))], [x.split()[0] for x in PLACE.split(", ")])

    return map_batches(rows, scan, PLACE)


def multikey_sort(words: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Order of the rows of ``words`` (big-endian words, one key after the other), then of ``tail``: three-way quicksort, key by key."""
    order = np.arange(len(words))
    todo = [(0, len(words), 0)]
    while todo:
        lo, hi, key = todo.pop()
        rows = order[lo:hi]
        if hi - lo <= 2048 or key == words.shape[1]:
            keys = (tail[rows], *(words[rows, k] for k in range(words.shape[1] - 1, key - 1, -1)))
            order[lo:hi] = rows[np.lexsort(keys)]
            continue
        value = words[rows, key]
        pivot = np.partition(value[[0, len(value) // 2, len(value) - 1]], 1)[1]
        less, more = value < pivot, value > pivot
        same = ~(less | more)
        order[lo:hi] = np.concatenate((rows[less], rows[same], rows[more]))
        a, b = lo + int(less.sum()), hi - int(more.sum())
        todo += [(lo, a, key), (a, b, key + 1), (b, hi, key)]
    return order


def padded(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts as rows of ``width`` bytes, zeros behind them, and their lengths."""
    return (np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(len(texts), width),
            np.fromiter(map(len, texts), np.int64, len(texts)))


def spread(state: np.ndarray, letters: np.ndarray) -> np.ndarray:
    return mix(state * ODD[0] + letters.astype(np.uint64) + ODD[1])


class Bucket:
    """Suffixes of a bucket, sorted; ``repeats[i, l]`` tells whether the string that starts l bytes before place i was met twice."""

    def __init__(self, ahead: list[bytes], behind: list[bytes], lo: np.ndarray, hi: np.ndarray, length: int):
        width = -(-length // 8) * 8
        text, size = padded(ahead, width)
        order = multikey_sort(text.view(">u8").astype(np.uint64), size)
        self.order, self.length = order, length
        self.text, self.size, self.lo, self.hi = text[order], size[order], lo[order], hi[order]
        self.left, _ = padded([behind[i] for i in order], length)
        n = len(order)
        differ = self.text[1:] != self.text[:-1]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        self.common = np.minimum(common, np.minimum(self.size[1:], self.size[:-1]))  # of neighbours
        near = np.zeros(n, np.int64)
        near[1:] = self.common
        near[:-1] = np.maximum(near[:-1], self.common)
        self.repeats = np.zeros((n, length), bool)
        live = np.flatnonzero(near >= length - self.hi)  # the others share too little with any
        state, left, low, high = np.zeros(len(live), np.uint64), self.left[live], self.lo[live], self.hi[live]
        for distance in range(int(high.max(initial=-1)) + 1):
            some = np.flatnonzero((low <= distance) & (high >= distance) & (near[live] >= length - distance))
            if len(some):
                node = np.concatenate(([0], np.cumsum(self.common < length - distance)))[live[some]]
                by = np.lexsort((state[some], node))
                same = (node[by][1:] == node[by][:-1]) & (state[some][by][1:] == state[some][by][:-1])
                hit = np.append(False, same) | np.append(same, False)
                self.repeats[live[some[by[hit]]], distance] = True
            if distance < left.shape[1]:
                state = spread(state, left[:, distance])

    def edges(self) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Rows whose beginning may go on in the next bucket, by blocks of distances.

        Rows, first distance, two hashes of what the strings of the block have in common, and two for each of its parts, those of one string last.
        """
        lead = self.text[:, :GRAM]
        edge = np.flatnonzero((lead == lead[0]).all(axis=1) | (lead == lead[-1]).all(axis=1))
        for part in range(0, len(edge), 1024):
            rows = edge[part:part + 1024]
            right = np.zeros((len(rows), self.length + 1), np.uint64)
            left = np.zeros((len(rows), self.length + 1), np.uint64)
            for k in range(self.length):
                right[:, k + 1] = spread(right[:, k], self.text[rows, k])
                left[:, k + 1] = spread(left[:, k], self.left[rows, k])

            def hashes(some, behind, ahead, kind):
                one = left[some, behind] + np.uint64(behind + kind)
                return mix(one ^ ODD[2]), mix(right[some, ahead] + one * ODD[3])

            for first in range(0, int(self.hi[rows].max()) + 1, BLOCK):
                stop = first + BLOCK
                some = np.flatnonzero((self.lo[rows] < stop) & (self.hi[rows] >= first))
                if len(some):
                    both = [hashes(some, d, self.length - d - n + 1, n << 20) for n in PARTS for d in range(first, stop, n)]
                    yield (rows[some], first, *hashes(some, first, self.length - stop + 1, BLOCK << 20),
                           np.stack([x for x, _ in both], axis=1), np.stack([x for _, x in both], axis=1))


def bit_runs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of every run of true cells."""
    wide = np.zeros((rows.shape[0], rows.shape[1] + 2), np.int8)
    wide[:, 1:-1] = rows
    edge = np.diff(wide, axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


def sort_buckets(suffixes: DataFrame, length: int, buckets: int) -> DataFrame:
    """FOUND rows: repeats found in a bucket (c1 null); and for places at its bounds the parts of a block of distances, ``start`` that of the first string and stop null."""
    names = [x.split()[0] for x in FOUND.split(", ")]
    pair = pa.struct([("w1", pa.int64()), ("w2", pa.int64()), ("open", pa.bool_())])

    def look(batches):
        cols: dict[str, list] = {c: [] for c in ("doc", "sig", "at", "lo", "hi", "ahead", "behind")}
        for batch in batches:
            for c, v in cols.items():
                v += batch.column(c).to_pylist()
        if not cols["doc"]:
            return
        lo, hi = np.array(cols["lo"], np.int64), np.array(cols["hi"], np.int64)
        bucket = Bucket(cols["ahead"], cols["behind"], lo, hi, length)
        docs, sigs = pa.array(cols["doc"], pa.int64()).take(pa.array(bucket.order)), np.array(cols["sig"], np.int64)[bucket.order]
        at = np.array(cols["at"], np.int64)[bucket.order]
        row, near, far = bit_runs(bucket.repeats)
        blank = pa.nulls(len(row), pa.int64())
        yield pa.RecordBatch.from_arrays([docs.take(pa.array(row)), pa.array(sigs[row]), pa.array(at[row] - far), pa.array(at[row] - near + length),
                                          blank, blank, pa.nulls(len(row), pa.list_(pair))], names)
        for row, first, c1, c2, w1, w2 in bucket.edges():
            distance = np.arange(first, first + BLOCK)
            # null: distances that are not the row's own, and strings met in this bucket but for one of each
            own = (distance >= bucket.lo[row][:, None]) & (distance <= bucket.hi[row][:, None])
            known = bucket.repeats[row[:, None], distance]
            met = np.flatnonzero(own & known)
            one, two = (w[:, -BLOCK:].ravel()[met] for w in (w1, w2))
            by = np.lexsort((two, one))
            new = np.append(True, (np.diff(one[by]) != 0) | (np.diff(two[by]) != 0))[:len(met)]
            own &= ~known
            own.ravel()[met[by[new]]] = True
            some = own.any(axis=1)
            row, c1, c2, w1, w2, own, known = (v[some] for v in (row, c1, c2, w1, w2, own, known))
            # a part counts if one of its strings does
            own = np.concatenate([own.reshape(len(row), -1, n).any(axis=2) for n in PARTS], axis=1)
            known = np.concatenate((np.ones((len(row), own.shape[1] - BLOCK), bool), known), axis=1)
            flat = pa.StructArray.from_arrays([*(pa.array(w.ravel().view(np.int64)) for w in (w1, w2)), pa.array(~known.ravel())], fields=list(pair), mask=pa.array(~own.ravel()))
            parts = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1, dtype=np.int32) * w1.shape[1]), flat)
            yield pa.RecordBatch.from_arrays([docs.take(pa.array(row)), pa.array(sigs[row]), pa.array(at[row] - first), pa.nulls(len(row), pa.int64()),
                                              pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)), parts], names)

    return map_batches(suffixes.repartitionByRange(buckets, "lead", "tie"), look, FOUND)


def across_buckets(edges: DataFrame, length: int) -> DataFrame:
    """SPAN of the strings at the bounds of buckets that occur twice; from FOUND rows."""
    def twice(rows, key):
        return rows.join(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key), key, "left_semi")

    rows, before, above = twice(edges, ["c1", "c2"]).withColumn("part", F.lit(0)), 0, BLOCK
    for n in PARTS:
        own = F.transform(F.sequence(F.lit(0), F.lit(above // n - 1)), lambda k: F.col("part") * (above // n) + k)
        own = F.transform(own, lambda p: F.struct(p.alias("part"), F.get("parts", p + before).alias("w")))
        rows = rows.select("doc", "sig", "start", "parts", F.explode(F.filter(own, lambda x: x["w"].isNotNull())).alias("x"))
        rows = store(rows.select("doc", "sig", "start", *(["parts"] if n > 1 else []), "x.part", "x.w.w1", "x.w.w2", "x.w.open"), "edges")
        rows, before, above = twice(rows, ["w1", "w2"]), before + BLOCK // n, n
    start = F.col("start") - F.col("part")
    return rows.where("open").select("doc", "sig", start.alias("start"), (start + length).alias("stop"))


def cut_suffixes(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """SUFFIX for the wanted places (doc, sig, at, lo, hi), with the bytes their strings hold in front of the place (backwards) and behind it."""
    lists = wanted.groupBy("doc", "sig").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("places"))
    both = rows.join(lists.select(F.col("doc").alias("d"), F.col("sig").alias("s"), "places"), F.col("doc").eqNullSafe(F.col("d")) & (F.col("sig") == F.col("s")))
    # repeated rows give the same suffixes
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]

    def cut(batches):
        for batch in batches:
            for doc, sig, body, found in zip(batch.column("doc").to_pylist(), batch.column("sig").to_pylist(), batch.column("body"), batch.column("places").to_pylist()):
                text, got = body.as_py(), []
                for p in found:
                    at, lo, hi = p["at"], p["lo"], p["hi"]
                    ahead, behind = text[at:at - lo + length], text[at - hi:at][::-1]
                    got.append((doc, sig, at, lo, hi, ahead[:GRAM], xxhash.xxh64_intdigest(ahead + behind) >> 1, ahead, behind))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got), kinds)], [x.split()[0] for x in SUFFIX.split(", ")])

    return map_batches(both.select("doc", "sig", "body", "places"), cut, SUFFIX)


def repeated_keys(rows: DataFrame, counts: DataFrame, key: list[str], limit: int) -> DataFrame:
    """The rows whose key is in ``counts`` (key, n); keys with more rows than ``limit`` are few and reach the rows where they lie."""
    hot = F.broadcast(counts.where(F.col("n") > limit).select(*key))
    cold = counts.where(F.col("n") <= limit).select(*key)
    return rows.join(hot, key, "left_semi").unionByName(rows.join(hot, key, "left_anti").join(cold, key, "left_semi"))


def repeated_spans(rows: DataFrame, length: int = 200, hot_rows: int = HOT_ROWS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """SPAN (bytes of a text): spans of ``rows`` (doc, sig, body) that repeated strings of ``length`` bytes cover, not merged."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    found = store(places(rows, length), "places")
    # at most 10,000 grams have more places than the limit, the others are joined
    limit = max(hot_rows, found.count() // 10_000)
    counts = store(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "grams")
    found = store(repeated_keys(found, counts, ["gram"], limit), "places-again")
    one = store(found.groupBy("gram", "around").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "sig", "at", "lo", "hi")).alias("one")), "surroundings")
    # a gram with several surroundings has to be sorted
    many = one.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("gram")
    wanted = one.join(many, "gram", "left_semi").select("one.*")
    whole = repeated_keys(found, one.where("n > 1"), ["gram", "around"], limit).select(
        "doc", "sig", (F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + length).alias("stop"))
    suffixes = store(cut_suffixes(rows, wanted, length).dropDuplicates(["doc", "sig", "at"]), "suffixes")
    buckets = max(1, -(-suffixes.count() // bucket_rows))
    sorted_ = store(sort_buckets(suffixes, length, buckets), "buckets")
    inside = sorted_.where("c1 IS NULL").select("doc", "sig", "start", "stop")
    return whole.unionByName(inside).unionByName(across_buckets(sorted_.where("c1 IS NOT NULL"), length))


def joined(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs that the spans cover."""
    by = np.argsort(starts, kind="stable")
    starts, reach = starts[by], np.maximum.accumulate(stops[by])
    head = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    return list(zip(starts[head].tolist(), reach[np.append(head[1:], len(starts)) - 1].tolist()))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, carry: list[str] | None = None, **how) -> DataFrame:
    """``docs`` (the columns ``carry``, or all) plus __kept (the bytes that stay), __n_bytes, __n_removed and __spans (removed runs of bytes)."""
    carry = docs.columns if carry is None else carry
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(body).alias("sig"), body.cast("binary").alias("body"))
    spans = repeated_spans(rows, length, **how).groupBy(F.col("doc").alias("__d"), F.col("sig").alias("__s")).agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("__spans"))
    keyed = docs.select(*carry, F.col(id_col).alias("__doc"), F.xxhash64(body).alias("__sig"), body.cast("binary").alias("__kept"))
    both = keyed.join(spans, F.col("__doc").eqNullSafe(F.col("__d")) & (F.col("__sig") == F.col("__s")), "left").select(
        *carry, "__kept", F.lit(0).cast("long").alias("__n_bytes"), F.lit(0).cast("long").alias("__n_removed"), "__spans")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def cut(batches):
        for batch in batches:
            kept, n_bytes, n_removed, runs = [], [], [], []
            for body, found in zip(batch.column("__kept"), batch.column("__spans")):
                text = body.as_py()
                spans = found.values
                own = joined(spans.field("start").to_numpy(), spans.field("stop").to_numpy()) if found.is_valid and len(spans) else []
                at = [0, *(x for run in own for x in run), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(at[::2], at[1::2])))
                n_bytes.append(len(text))
                n_removed.append(len(text) - len(kept[-1]))
                runs.append([{"start": a, "stop": b} for a, b in own])
            cols = {"__kept": pa.array(kept, pa.binary()), "__n_bytes": pa.array(n_bytes, pa.int64()), "__n_removed": pa.array(n_removed, pa.int64()), "__spans": pa.array(runs, kind)}
            yield pa.RecordBatch.from_arrays([cols.get(c, batch.column(i)) for i, c in enumerate(batch.schema.names)], batch.schema.names)

    return map_batches(both, cut, both.schema)
