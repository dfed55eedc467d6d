"""Substring dedup with compact windows.

Tokens are shingles of five words. Under one hash function every run of tokens
has the hash of its smallest one. The node of a Cartesian tree over the hashes
stands for all runs inside its range that contain its smallest token: one compact
window instead of a square of runs. Only ranges of at least a passage are kept,
about two for each passage length, and this for each of ``hashes`` functions.

A passage that occurs again has the same smallest token there, and on one side of
it at least half a passage of the same neighbours. So a window gets a key for
each side: its smallest token and the smallest of the neighbours there. The
windows go to the buckets of their keys, packed; of a key that a part of a task has
more than HOT_ROWS times only the first one goes there, to which the others are
linked. All are linked to the first one of all. No pairs are built. Of a stretch that
repeats itself, a key's places inside are left out, but for two at each end.

Each linked text is compared with the first one around the place of the key:
common shingles are followed from one to the next by their places in both texts,
so other shared text beside a passage, or elsewhere, does not count against it. What
stays are passages of at least ``words`` words on one side, not more than
``similarity`` shorter on the other, whose shingle sets have a similarity of
``similarity`` or more.

The first text may share only a line with the others, which share more with each
other. A text meets again, round by round, under the run it shares with the first
one made longer by the next shingle on each side, up to the length of a passage:
two texts with the same passage leave the first one's at the same place, or have
all of it in common with it. So every exact repeat is compared, whatever else shares its keys,
at two rows for each row of a round.

An exact repeat is met under every function; one with similarity s under each
with a probability of about s * s, and again only if the changed words leave the
longer run whole. Equal texts are one text until the end. Groups of up to
GROUP_ROWS rows go through all their rounds in one task, with the shingles around
their places only, and the texts that met there are compared at the end.

Defined cases: null, empty and short texts have no passage. Texts are known by a
64-bit hash. Rows that repeat an id and text count once; rows without id are
searched and take part in links, but name no class. Repeats within one text do
not count. Extra columns are neither read nor returned.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import components, free_shuffles, map_batches, store
from cohortspark.llm.decontaminate import words_of

SHINGLE = 5
GAP = 2 * SHINGLE
PART_ROWS = 400_000
GROUP_ROWS = 20_000  # rows of a group that go through its rounds in one task
RUN_WORDS = 1 << 15  # words of texts that are scanned at once
HOT_ROWS = 2048  # rows of a key in one part that go to the bucket of the key
ROWS = "bucket int, role int, keys binary, texts binary, places binary, firsts binary"
FIRST = "role int, key long, one long, one_at int, other long, other_at int"
MET = "grp long, one long, one_at int, other long, other_at int, ahead int, behind int"
SEEN = "one long, one_start int, one_stop int, other long, other_start int, other_stop int, similarity double, grp long, at int, ahead int, behind int"
NEAR = "grp long, text long, at int, ahead int, behind int, round int, left int, right int, near binary"
LINK = "one long, one_start int, one_stop int, other long, other_start int, other_stop int, similarity double"


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (fixed values of the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles_of(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash for every run of SHINGLE words."""
    if len(words) < SHINGLE:
        return np.zeros(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(one) - SHINGLE + 1
    out = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + one[k:k + n])
    return out


def shingles(text: bytes | None) -> np.ndarray:
    return shingles_of(words_of(text))


def sliding(v: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Smallest or largest of every ``width`` neighbours in a row, from running ones of blocks, forward and backward."""
    k, n = v.shape
    blocks = np.pad(v, ((0, 0), (0, -n % width))).reshape(k, -1, width)
    ahead = best.accumulate(blocks, axis=2).reshape(k, -1)
    back = best.accumulate(blocks[:, :, ::-1], axis=2)[:, :, ::-1].reshape(k, -1)
    return best(back[:, :n - width + 1], ahead[:, width - 1:n])


def smallest(v: np.ndarray, least: int) -> np.ndarray:
    """Places, all rows in one, of the tokens that are the smallest of some stretch of ``least`` tokens: one for each window."""
    low = sliding(v, least, np.minimum)
    # a token is the smallest of some stretch around it if the largest of their smallest ones is itself
    high = sliding(np.pad(low, ((0, 0), (least - 1, least - 1))), least, np.maximum)
    return np.flatnonzero(high == v)


def windows(v: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, place of the smallest, stop) of every Cartesian tree node of at least ``least`` tokens, for each row; one for each equal smallest token.

    A node of at least ``least`` tokens has a smallest token that is the smallest
    of some stretch of that length, and so have its two borders, the next smaller
    tokens. So the tree is built over these few tokens only.
    """
    k, n = v.shape
    at = smallest(v, least)
    starts, stops = [], [0] * len(at)
    open_: list[tuple[int, int, int]] = []  # number, place and value of the nodes on the right edge of the tree
    before = -1
    places, rows = (at % n).tolist(), (at // n).tolist()
    for i, (row, place, value) in enumerate(zip(rows, places, v.ravel()[at].tolist())):
        if row != before:
            for j, _, _ in open_:
                stops[j] = n
            open_, before = [], row
        while open_ and open_[-1][2] > value:
            stops[open_.pop()[0]] = place
        if open_ and open_[-1][2] == value:
            starts.append(starts[open_[-1][0]])
        else:
            starts.append(open_[-1][1] + 1 if open_ else 0)
        open_.append((i, place, value))
    for j, _, _ in open_:
        stops[j] = n
    return np.array(rows, np.int64), np.array(starts, np.int64), np.array(places, np.int64), np.array(stops, np.int64)


WIDE = (1 << 20) - 1


def spans_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Start and width in one number; a width that does not fit means to the end of the text."""
    return a << 20 | np.minimum(b - a, WIDE)


def text_keys(texts: list[list[bytes]], words: int, hashes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, number of the text, place of the smallest token) for both sides of the windows of some texts, given as words; all in one array."""
    least = words - SHINGLE + 1
    side = (least - 1) // 2
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    s = shingles_of([w for t in texts for w in t])
    if len(s) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.concatenate(([0], np.cumsum(size)))
    text = np.repeat(np.arange(len(texts)), size)[:len(s)]
    place = np.arange(len(s)) - start[text]
    left_of = size[text] - SHINGLE - place  # shingles behind the place; those that go on in the next text have less than none
    border = left_of < 0
    # smallest of the ``side`` tokens from each place on, under a function of its own
    low = sliding(mix(s ^ np.uint64(0xA5A5A5A5))[None], side, np.minimum)[0]
    keys, found = [], []
    for k, seed in enumerate(mix(np.arange(1, hashes + 1, dtype=np.uint64))):
        v = mix(s + seed)
        v[border] = 0  # less than any other: no window goes beyond
        c = smallest(v[None], least)
        c = c[~border[c]]
        side_no = np.uint64(2 * k)
        left, right = c[place[c] >= side], c[left_of[c] >= side]
        keys += [mix(v[left] ^ low[left - side] + side_no), mix(v[right] ^ low[right + 1] + side_no + np.uint64(1))]
        found += [left, right]
    at, key = np.concatenate(found), np.concatenate(keys)
    kept = ~inner_periods(s, text, key, at, side)
    at = at[kept]
    return key[kept].view(np.int64), text[at], place[at]


def inner_periods(s: np.ndarray, text: np.ndarray, key: np.ndarray, at: np.ndarray, longest: int) -> np.ndarray:
    """Rows inside a stretch that repeats itself after 2 to ``longest`` shingles, but for the first two and the last two of a key.

    A run that two texts have in common there reaches as far from these places as from those
    between them: from the ends where it goes beyond the stretch, else from the first, moved by
    one period at most. Stretches of one repeated shingle are left to ``ends_of``.
    """
    inner, odd = np.zeros(len(at), bool), np.uint64(0x9E3779B97F4A7C15)
    for d in range(2, min(longest, len(s) // 5) + 1):
        equal = s[d:] == s[:-d]
        if np.count_nonzero(equal) < 3 * d:
            continue
        run = np.concatenate(([0], np.cumsum(equal)))
        place = np.flatnonzero(run[3 * d:] - run[:-3 * d] == 3 * d) + 2 * d
        place = place[place + 2 * d < len(s)]
        place = place[(text[place - 2 * d] == text[place + 2 * d]) & (s[place] != s[place - 1])]
        if not len(place):
            continue
        fit, around = np.zeros(len(s), bool), np.zeros(len(s), bool)
        fit[place] = True
        for step in (-2 * d, -d, d, 2 * d):
            around[place + step] = True
        rows, fits = np.flatnonzero(around[at]), np.flatnonzero(fit[at])
        rows = mix(key[rows] + at[rows].astype(np.uint64) * odd)
        near = [np.isin(mix(key[fits] + (at[fits] + step).astype(np.uint64) * odd), rows) for step in (-2 * d, -d, d, 2 * d)]
        inner[fits[np.logical_and.reduce(near)]] = True
    return inner


def ends_of(keys: np.ndarray, texts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Of rows sorted by key, text and place those that differ; of a stretch of one repeated shingle, places side by side, the ends."""
    new = np.append(True, (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1]) | (places[1:] != places[:-1]))[:len(keys)]
    kept = np.flatnonzero(new)
    k, t, p = keys[kept], texts[kept], places[kept]
    joined = (k[1:] == k[:-1]) & (t[1:] == t[:-1]) & (p[1:] == p[:-1] + 1)
    return kept[~(np.append(False, joined) & np.append(joined, False))[:len(kept)]]


def window_keys(text: bytes | None, words: int, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a text's windows and the places of their smallest tokens; of places side by side with one key the first and the last."""
    split = words_of(text)
    keys, own, places = text_keys([split] if len(split) >= words else [], words, hashes)
    by = np.lexsort((places, keys))
    by = by[ends_of(keys[by], own[by], places[by])]
    return keys[by], places[by]


def link_part(keys: np.ndarray, texts: np.ndarray, places: np.ndarray, buckets: int) -> list[pa.RecordBatch]:
    """ROWS of one part. Of a key with more than HOT_ROWS rows here the first row goes to the bucket of the key, the others are linked to it and spread by their texts."""
    by = np.argsort(keys)
    keys, texts, places = keys[by], texts[by], places[by]
    same = keys[1:] == keys[:-1]
    often = np.flatnonzero(np.append(False, same) | np.append(same, False))
    sure = np.ones(len(keys), bool)
    out, firsts = [], np.zeros(0, np.int64)
    if len(often):
        more = often[np.lexsort((places[often], texts[often], keys[often]))]
        texts[often], places[often] = texts[more], places[more]
        k, t, p = keys[often], texts[often], places[often]
        ends = ends_of(k, t, p)
        sure[often] = False
        sure[often[ends]] = True
        often, k, t, p = often[ends], k[ends], t[ends], p[ends]
        head = np.append(True, k[1:] != k[:-1])
        start, own = np.flatnonzero(head), np.cumsum(head) - 1
        size = np.diff(np.append(start, len(k)))
        hot = (size > HOT_ROWS)[own]
        sure[often[hot]] = False
        lead = start[size > HOT_ROWS]
        many = t[start + size - 1][size > HOT_ROWS] != t[lead]
        out.append((2, k[lead], t[lead], p[lead], 1 + many.astype(np.int64), bucket_of(k[lead], buckets)))
        rest = np.flatnonzero(hot & ~head)
        to = bucket_of(mix(t[rest].view(np.uint64)).view(np.int64), buckets)
        order = np.argsort(to, kind="stable")
        rest, to = rest[order], to[order]
        out.append((1, k[rest], t[rest], p[rest], t[start][own[rest]], to))
    keys, texts, places = keys[sure], texts[sure], places[sure]
    out.append((0, keys, texts, places, firsts, bucket_of(keys, buckets)))
    return [in_buckets(*x) for x in out if len(x[1])]


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key, rising with the key."""
    return ((keys >> 32) + (1 << 31)) * buckets >> 32


def in_buckets(role: int, keys: np.ndarray, texts: np.ndarray, places: np.ndarray, firsts: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    """ROWS, one for each bucket of rows that are sorted by it."""
    cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))

    def binary(v: np.ndarray) -> pa.Array:
        offsets = (cut if len(v) else 0 * cut) * v.itemsize
        return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(v))])

    columns = [pa.array(bucket[cut[:-1]], pa.int32()), pa.array(np.full(len(cut) - 1, role), pa.int32())]
    return pa.RecordBatch.from_arrays([*columns, *map(binary, (keys, texts, places.astype(np.int32), firsts))], [x.split()[0] for x in ROWS.split(", ")])


def candidate_rows(docs: DataFrame, words: int, hashes: int, buckets: int) -> DataFrame:
    """ROWS of the window keys of ``docs`` (sig, body)."""
    def scan(batches):
        held, size = [], 0
        for sigs, texts in texts_of(batches, words):
            keys, own, places = text_keys(texts, words, hashes)
            if len(keys):
                held.append((keys, np.array(sigs, np.int64)[own], places))
                size += len(keys)
            if size >= PART_ROWS:
                yield from link_part(*map(np.concatenate, zip(*held)), buckets)
                held, size = [], 0
        if held:
            yield from link_part(*map(np.concatenate, zip(*held)), buckets)

    return map_batches(docs, scan, ROWS)


def texts_of(batches, words: int):
    """(sigs, texts as words) in runs of about RUN_WORDS words; without those too short for a passage."""
    sigs, texts, size = {}, [], 0
    for batch in batches:
        for sig, body in zip(batch.column("sig").to_pylist(), batch.column("body")):
            if sig in sigs:
                continue
            split = words_of(body.as_py())
            if len(split) < words:
                continue
            sigs[sig] = None
            texts.append(split)
            size += len(split)
            if size >= RUN_WORDS:
                yield list(sigs), texts
                sigs, texts, size = {}, [], 0
    if texts:
        yield list(sigs), texts


def meet_first(keys: np.ndarray, texts: np.ndarray, places: np.ndarray, marks: np.ndarray) -> list[tuple[int, np.ndarray, ...]]:
    """FIRST: all rows of some keys that two texts have, with the key's first text and place; and for the first rows of spread ones (``marks`` > 0) the same."""
    by = np.argsort(keys)
    same = keys[by[1:]] == keys[by[:-1]]
    by = by[np.append(False, same) | np.append(same, False) | (marks[by] > 0)]
    by = by[np.lexsort((marks[by], places[by], texts[by], keys[by]))]
    k, t, p, m = keys[by], texts[by], places[by], marks[by]
    if not len(k):
        return []
    start = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    size = np.diff(np.append(start, len(k)))
    top = np.repeat(start, size)
    several = np.repeat((t[start + size - 1] != t[start]) | (np.maximum.reduceat(m, start) == 2), size)
    new = np.append(True, (k[1:] != k[:-1]) | (t[1:] != t[:-1]) | (p[1:] != p[:-1]))
    met, lead = new & several & ((t != t[top]) | (p != p[top])), (m > 0) & several
    return [(role, k[x], t[top][x], p[top][x], t[x], p[x]) for role, x in ((0, met), (2, lead)) if x.any()]


def first_meetings(rows: DataFrame) -> DataFrame:
    """MET: every row of a key that two texts have, with the key's first text and place."""
    kinds, names = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()), [x.split()[0] for x in FIRST.split(", ")]

    def batch_of(role, *columns):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((np.full(len(columns[0]), role), *columns), kinds)], names)

    def meet(batches):
        held, last = [], None
        for batch in batches:
            for bucket, role, *parts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "role", "keys", "texts", "places", "firsts"))):
                keys, texts, places, firsts = (np.frombuffer(x, k) for x, k in zip(parts, (np.int64, np.int64, np.int32, np.int64)))
                if role == 1:
                    yield batch_of(1, keys, firsts, np.zeros(len(keys), np.int32), texts, places)
                    continue
                if bucket != last and held:
                    for found in meet_first(*map(np.concatenate, zip(*held))):
                        yield batch_of(*found)
                    held = []
                last = bucket
                held.append((keys, texts, places, firsts if role == 2 else np.zeros(len(keys), np.int64)))
        if held:
            for found in meet_first(*map(np.concatenate, zip(*held))):
                yield batch_of(*found)

    found = store(map_batches(rows.repartition("bucket").sortWithinPartitions("bucket"), meet, FIRST), "met")
    # the first text of a part may not be the first of all
    lead = found.where("role = 2").select("key", F.col("other").alias("first"), "one", "one_at").distinct()
    spread = found.where("role = 1").select("key", F.col("one").alias("first"), "other", "other_at").distinct()
    spread = spread.join(lead, ["key", "first"]).select("key", "one", "one_at", "other", "other_at").distinct()
    met = found.where("role = 0").select(*spread.columns).unionByName(spread.where("one <> other OR one_at <> other_at"))
    return met.select(F.col("key").alias("grp"), "one", "one_at", "other", "other_at", F.lit(0).alias("ahead"), F.lit(0).alias("behind"))


def meet_again(rows: DataFrame) -> DataFrame:
    """MET: the rows (grp, text, at, ahead, behind) of a group that two texts have, with its first text and place."""
    first = rows.groupBy("grp").agg(F.min(F.struct("text", "at")).alias("top"))
    return rows.join(first, "grp").where("text <> top.text OR at <> top.at").select(
        "grp", F.col("top.text").alias("one"), F.col("top.at").alias("one_at"), F.col("text").alias("other"), F.col("at").alias("other_at"), "ahead", "behind")


def covered(spans: list[int], enough: int) -> np.ndarray:
    """Intervals that at least ``enough`` of the spans cover."""
    s = np.array(spans, np.int64)
    start, width = s >> 20, s & WIDE
    at = np.concatenate((start, np.where(width == WIDE, np.iinfo(np.int64).max, start + width)))
    step = np.concatenate((np.ones(len(s), np.int64), -np.ones(len(s), np.int64)))
    by = np.lexsort((-step, at))
    depth = np.cumsum(step[by])
    inside = depth >= enough
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    return at[by][edge].reshape(-1, 2)


def same(a: np.ndarray, b: np.ndarray) -> int:
    """How many shingles two texts have in common from their starts on."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        stop = min(n, at + step)
        differ = a[at:stop] != b[at:stop]
        k = int(differ.argmax())
        if differ[k]:
            return at + k
        at, step = stop, 4 * step
    return n


def follow(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """Start in a, start in b and length of the common runs met one after the other, with at most GAP places skipped in each between them."""
    out, i, j = [], 0, 0
    while True:
        n = same(a[i:], b[j:])
        if n:
            out.append((i, j, n))
        i, j = i + n, j + n
        u, w = np.nonzero(a[i:i + GAP + 1, None] == b[None, j:j + GAP + 1])
        if not len(u):
            return out
        # the fewest places skipped, then the least drift
        best = np.lexsort((abs(u - w), u + w))[0]
        i, j = i + int(u[best]), j + int(w[best])


def chain(a: np.ndarray, b: np.ndarray, p: int, q: int) -> np.ndarray:
    """The common runs before and after the place p of ``a`` and q of ``b``, which are equal; runs that meet there are one."""
    after = [(p + i, q + j, n) for i, j, n in follow(a[p:], b[q:])]
    before = [(p - i - n, q - j - n, n) for i, j, n in follow(a[:p][::-1], b[:q][::-1])][::-1]
    if before and before[-1][0] + before[-1][2] == p and before[-1][1] + before[-1][2] == q:
        i, j, n = before.pop()
        after[0] = (i, j, n + after[0][2])
    return np.array(before + after, np.int64)


def stretches(blocks: np.ndarray, least: int, similarity: float) -> list[tuple[int, int]]:
    """First and last run of the longest stretch that is similar enough, then of what lies before and behind it."""
    i, j, n = blocks.T
    if max(i[-1] + n[-1] - i[0], j[-1] + n[-1] - j[0]) < least:
        return []
    total = np.cumsum(n)
    # common >= similarity * all together, as a difference of a value at the end and one at the start
    end = (1 + similarity) * total - similarity * (i + j + 2 * n) + 1e-9
    start = (1 + similarity) * (total - n) - similarity * (i + j)
    out, todo = [], [(0, len(n))]
    while todo:
        lo, hi = todo.pop()
        if lo >= hi:
            continue
        top = np.maximum.accumulate(end[lo:hi][::-1])  # rises towards the front
        last = hi - 1 - np.searchsorted(top, start[lo:hi])
        size = np.maximum(i[last] + n[last] - i[lo:hi], j[last] + n[last] - j[lo:hi])
        k = int(size.argmax())
        if size[k] >= least:
            out.append((lo + k, int(last[k])))
            todo += [(lo, lo + k), (int(last[k]) + 1, hi)]
    return out


def align(a: np.ndarray, b: np.ndarray, least: int, similarity: float, seeds: list[tuple[int, int]]) -> tuple[list[tuple[int, int, int, int, float]], list[tuple[int, int]]]:
    """Near-duplicate stretches around ``seeds`` (places of equal shingles), and the common run around each seed: places before and behind it."""
    found, around, known = set(), [], {}
    for p, q in seeds:
        at = next((r for r in known.get(q - p, ()) if r[0] <= p < r[1]), None)
        if at is None:
            blocks = chain(a, b, p, q)
            for i, j, n in blocks.tolist():
                known.setdefault(j - i, []).append((i, i + n))
            at = next(r for r in reversed(known[q - p]) if r[0] <= p < r[1])
            for x, y in stretches(blocks, least, similarity):
                (i, j, _), (u, w, m) = blocks[x].tolist(), blocks[y].tolist()
                part = (i, u + m, j, w + m)
                if (common := jaccard(a, b, *part)) >= similarity:
                    found.add((*part, common))
                else:  # places that repeat count once
                    found.update((i, i + n, j, j + n, 1.0) for i, j, n in blocks[x:y + 1].tolist() if n >= least)
        around.append((p - at[0], at[1] - 1 - p))
    # in repetitive texts a passage shows again inside a longer one, shifted
    kept: list[tuple[int, int, int, int, float]] = []
    for r in sorted(found, key=lambda r: (r[0] - r[1] + r[2] - r[3], r)):
        if not any(k[0] <= r[0] and r[1] <= k[1] and k[2] <= r[2] and r[3] <= k[3] for k in kept):
            kept.append(r)
    return sorted(kept), around


def jaccard(a: np.ndarray, b: np.ndarray, s: int, e: int, x: int, y: int) -> float:
    if np.array_equal(a[s:e], b[x:y]):
        return 1.0
    own, their = set(a[s:e].tolist()), set(b[x:y].tolist())
    return len(own & their) / len(own | their)


def passages(a: np.ndarray, b: np.ndarray, least: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """Stretches of ``a`` and ``b`` that are near-duplicates: start and stop in each, and the similarity of their sets."""
    where: dict[int, list[int]] = {}
    for q, v in enumerate(b.tolist()):
        where.setdefault(v, []).append(q)
    return align(a, b, least, similarity, [(p, q) for p, v in enumerate(a.tolist()) for q in where.get(v, ())])[0]


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    factor = 0x9E3779B97F4A7C15  # any odd number
    return tuple(np.cumprod(np.full(n, f, np.uint64)) for f in (factor, pow(factor, -1, 1 << 64)))


def run_keys(s: np.ndarray, place: np.ndarray, ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Keys of the runs of shingles from ``ahead`` places before some places to ``behind`` places after them."""
    power, back = powers(1 << len(s).bit_length())
    power = power[:len(s)]
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(s * power)))
    run = (total[place + behind + 1] - total[place - ahead]) * back[place - ahead]
    return mix(mix(run) + (ahead << 32 | behind).astype(np.uint64)).view(np.int64)


def verify(met: DataFrame, texts: DataFrame, words: int, similarity: float, longer: bool = True) -> DataFrame:
    """SEEN for the near-duplicate passages around the places of MET, and if ``longer`` for the groups in which its rows meet again; with the texts from ``texts`` (sig, letters).

    Two texts with an exact passage around their places may both differ from the
    first one inside it. They do so at the same place, at the end of the run they
    share with it, and meet again under the run that is one shingle longer.
    """
    least = words - SHINGLE + 1
    # passages of a round are found for themselves
    pairs = met.groupBy("one", "other").agg(F.sort_array(F.collect_list(F.struct("round", "one_at", "other_at", "ahead", "behind"))).alias("seeds"))
    t1, t2 = texts.selectExpr("sig AS one", "letters AS letters1"), texts.selectExpr("sig AS other", "letters AS letters2")
    rows = pairs.join(t2, "other").join(t1, "one").select("one", "other", "seeds", "letters1", "letters2")
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    names = [x.split()[0] for x in SEEN.split(", ")]

    def look(batches):
        last, kept = None, None
        for batch in batches:
            got, again = [], []
            seeds, ends = batch.column("seeds").flatten(), np.append(0, np.cumsum(batch.column("seeds").value_lengths().to_numpy()))
            turns, one_at, other_at, aheads, behinds = (seeds.field(k).to_numpy() for k in range(5))
            cuts = np.unique(np.concatenate((ends, np.flatnonzero(np.diff(turns)) + 1)))
            at_end = np.searchsorted(cuts, ends).tolist()
            for k, (one, other, b1, b2) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("one", "other", "letters1", "letters2")))):
                if one != last:
                    last, kept = one, letters_in(b1)
                a, b = kept, kept if one == other else letters_in(b2)
                own, around = slice(ends[k], ends[k + 1]), []
                for lo, hi in zip(cuts[at_end[k]:at_end[k + 1]], cuts[at_end[k] + 1:]):
                    found, part = align(a, b, least, similarity, list(zip(one_at[lo:hi].tolist(), other_at[lo:hi].tolist())))
                    around += part
                    if one != other:
                        got += [(one, s, e + SHINGLE - 1, other, x, y + SHINGLE - 1, j, None, None, None, None) for s, e, x, y, j in found]
                if not longer:
                    continue
                at, (before, after) = other_at[own].astype(np.int64), np.array(around, np.int64).T
                # a passage around the place reaches no farther than ``least`` - 1 places
                left, right = (before + 1 < least) & (before < at), (after + 1 < least) & (at + after + 1 < len(b))
                x, y = np.concatenate((before[left] + 1, aheads[own][right])), np.concatenate((behinds[own][left], after[right] + 1))
                runs = np.unique((np.concatenate((at[left], at[right])) * words + x) * words + y)  # none reaches as far as ``words``
                runs = runs // words // words, runs // words % words, runs % words
                again.append((np.full(len(runs[0]), other), run_keys(b, *runs), *runs))
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got), kinds)], names)
            if again:
                other, *rest = (np.concatenate(c) for c in zip(*again))
                none = [pa.nulls(len(other), k) for k in kinds[:7]]
                none[3] = pa.array(other, kinds[3])
                yield pa.RecordBatch.from_arrays([*none, *(pa.array(c, k) for c, k in zip(rest, kinds[7:]))], names)

    return map_batches(rows, look, SEEN)


def near_places(rows: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """NEAR: the rows (grp, text, at, ahead, behind) with the shingles up to a passage before and behind the place, 32 bits of each."""
    reach = words - SHINGLE
    lists = rows.groupBy("text").agg(F.collect_list(F.struct("grp", "at", "ahead", "behind", "round")).alias("places"))
    both = lists.join(texts.selectExpr("sig AS text", "letters"), "text").select("text", "letters", "places")

    def look(batches):
        for batch in batches:
            lists = batch.column("places")
            grp, at, ahead, behind, turn = (lists.flatten().field(k) for k in range(5))
            size = lists.value_lengths().to_numpy()
            ends, near, right = np.append(0, np.cumsum(size)), [], []
            for k, letters in enumerate(batch.column("letters")):
                s, own = letters_in(letters.as_py()), at.to_numpy()[ends[k]:ends[k + 1]]
                wide = np.pad(s.astype(np.uint32), reach)
                near += [x.tobytes() for x in np.lib.stride_tricks.sliding_window_view(wide, 2 * reach + 1)[own]]
                right.append(np.minimum(len(s) - 1 - own, reach))
            yield pa.RecordBatch.from_arrays([grp, pa.array(np.repeat(batch.column("text").to_numpy(), size)), at, ahead, behind, turn,
                                              pa.array(np.minimum(at.to_numpy(), reach), pa.int32()), pa.array(np.concatenate(right), pa.int32()), pa.array(near, pa.binary())],
                                             [x.split()[0] for x in NEAR.split(", ")])

    return map_batches(both, look, NEAR)


def meet_longer(grp: np.ndarray, text: np.ndarray, at: np.ndarray, ahead: np.ndarray, behind: np.ndarray, turn: np.ndarray, left: np.ndarray, right: np.ndarray, near: np.ndarray) -> np.ndarray:
    """one, one_at, other, other_at, round of all rounds of whole groups, sorted by group, text and place; ``near`` has the shingles around each place.

    As in the rounds of ``verify``, a row meets the first one of its group and goes
    on under the run that is one shingle longer on each side.
    """
    reach = near.shape[1] // 2
    letters = mix(near + np.arange(1, near.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate((np.zeros((len(near), 1), np.uint64), np.cumsum(letters, axis=1)), axis=1)
    runs: dict[tuple[int, int], list[np.ndarray]] = {}
    for x, y in np.unique(np.stack((ahead, behind)), axis=1).T.tolist():
        runs[x, y] = [np.flatnonzero((ahead == x) & (behind == y))]
    met, step = [np.zeros((5, 0), np.int64)], 0
    while runs:
        longer: dict[tuple[int, int], list[np.ndarray]] = {}
        for (x, y), parts in runs.items():
            rows = np.unique(np.concatenate(parts))
            key = mix(mix(total[rows, reach + y + 1] - total[rows, reach - x]) + grp[rows].view(np.uint64))
            by = np.lexsort((rows, key))
            rows, key = rows[by], key[by]
            head = np.append(True, key[1:] != key[:-1])
            start, own = np.flatnonzero(head), np.cumsum(head) - 1
            top, last = rows[start], rows[np.append(start[1:], len(rows)) - 1]
            some = ~head & (text[top] != text[last])[own]
            one, other = top[own][some], rows[some]
            if not len(one):
                continue
            met.append(np.stack((text[one], at[one], text[other], at[other], turn[one] + step))[:, text[one] != text[other]])
            differ = np.ones((len(one), 2, reach + 1), bool)  # behind the last place, too
            differ[:, 0, :-1] = (near[one, :reach] != near[other, :reach])[:, ::-1]
            differ[:, 1, :-1] = near[one, reach + 1:] != near[other, reach + 1:]
            before, after = np.minimum(differ.argmax(axis=2).T, np.stack((np.minimum(left[one], left[other]), np.minimum(right[one], right[other]))))
            for n in np.unique(before[before < left[other]]).tolist():
                longer.setdefault((n + 1, y), []).append(other[(before == n) & (n < left[other])])
            for n in np.unique(after[after < right[other]]).tolist():
                longer.setdefault((x, n + 1), []).append(other[(after == n) & (n < right[other])])
        runs, step = longer, step + 1
    return np.concatenate(met, axis=1)


def meet_in_groups(near: DataFrame) -> DataFrame:
    """one, one_at, other, other_at, round: the meetings of all rounds to come of the groups of NEAR, each in one task."""
    names = ["grp", "text", "at", "ahead", "behind", "round", "left", "right"]

    def walk(batches):
        def meet(held):
            cols = [held.column(c).to_numpy().astype(np.int64) for c in names]
            letters = np.frombuffer(b"".join(held.column("near").to_pylist()), np.uint32).reshape(len(held), -1).astype(np.uint64)
            met = np.unique(meet_longer(*cols, letters), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(met, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()))], ["one", "one_at", "other", "other_at", "round"])

        held = None
        for batch in batches:
            held = pa.concat_batches([held, batch]) if held else batch
            last = np.searchsorted(held.column("grp").to_numpy(), held.column("grp")[-1].as_py()) if len(held) >= GROUP_ROWS else 0
            if last:
                yield meet(held[:last])
                held = held[last:]
        if held:
            yield meet(held)

    return map_batches(near.repartition("grp").sortWithinPartitions("grp", "text", "at"), walk, "one long, one_at int, other long, other_at int, round int")


def shared_points(spans: list[tuple[int, int]], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points that name the largest sets of spans with ``words`` places in common, and for each span the numbers of its first point and of the one behind its last."""
    start = np.array([s for s, _ in spans], np.int64)
    end = np.maximum(start, np.array([e for _, e in spans], np.int64) - words)
    at, is_end = np.concatenate((start, end)), np.repeat([0, 1], len(start))
    by = np.lexsort((is_end, at))
    at, is_end = at[by], is_end[by]
    points = at[1:][(is_end[1:] == 1) & (is_end[:-1] == 0)]
    return points, np.searchsorted(points, start), np.searchsorted(points, end, "right")


def shared_parts(spans: list[tuple[int, int]], words: int) -> list[tuple[int, int, int]]:
    """(start, stop, point): the largest sets of spans that have ``words`` places in common, named by a point, for each span."""
    points, low, high = shared_points(spans, words)
    return [(*span, int(p)) for span, a, b in zip(spans, low, high) for p in points[a:b]]


def tree_of(low: int, high: int, size: int) -> tuple[list[int], list[int]]:
    """In a binary tree over ``size`` points, a power of two: the nodes above the point ``low``, and the fewest that hold ``low`` to ``high`` - 1.

    Of two ranges with a point in common one starts inside the other, so one of
    its nodes of the first kind is one of the other's of the second kind.
    """
    above = [size + low >> k for k in range(size.bit_length())]
    a, b, inside = size + low, size + high, []
    while a < b:
        if a & 1:
            inside.append(a)
            a += 1
        if b & 1:
            b -= 1
            inside.append(b)
        a, b = a >> 1, b >> 1
    return above, inside


def tree_nodes(batches):
    """A row for each node of ``tree_of`` of the ranges of some kinds of texts."""
    for batch in batches:
        got = [(kind, n, place, one, node, held) for kind, n, place, one, *part in zip(*(c.to_pylist() for c in batch.columns))
               for held, nodes in enumerate(tree_of(*part)) for node in nodes]
        if got:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got), kinds)], ["kind", "n", "place", "one", "node", "inside"])


def count_links(links: DataFrame, copies: DataFrame, words: int) -> DataFrame:
    """sig, others: documents of other texts in the passage classes of a text; ``copies`` (sig, copies) has the documents of each.

    A class is a passage of a first text with all texts that have it. The passages
    of a text in a first one are a range of its classes, so it has one row for a
    range and a few for the range's nodes in a tree, however many classes it spans.
    Texts with the same ranges are counted together, by bitmaps.
    """
    def cut(batches):
        for batch in batches:
            got = []
            for one, spans in zip(batch.column("one").to_pylist(), batch.column("spans").to_pylist()):
                spans = [(x["one_start"], x["one_stop"]) for x in spans]
                points, low, high = shared_points(spans, words)
                size = 1 << (len(points) - 1).bit_length()
                got += [(one, *span, a, b, size) for span, a, b in zip(spans, low.tolist(), high.tolist())]
                got.append((one, None, None, 0, size, size))  # the first text has them all
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got), [pa.int64()] + 5 * [pa.int32()])], ["one", "one_start", "one_stop", "low", "high", "size"])

    spans = links.groupBy("one").agg(F.sort_array(F.collect_set(F.struct("one_start", "one_stop"))).alias("spans"))
    ranges = store(map_batches(spans, cut, "one long, one_start int, one_stop int, low int, high int, size int"), "ranges")
    part = F.struct("one", "low", "high", "size").alias("part")
    held = links.select("one", "one_start", "one_stop", "other").join(ranges, ["one", "one_start", "one_stop"]).select(F.col("other").alias("sig"), part)
    held = held.unionByName(ranges.where("one_start IS NULL").select(F.col("one").alias("sig"), part))
    held = store(held.distinct(), "held").join(copies, "sig")
    kinds = held.groupBy("sig", "copies").agg(F.sort_array(F.collect_list("part")).alias("parts")).withColumn("kind", F.xxhash64("parts"))
    kinds = store(kinds, "kinds")
    kind = store(kinds.groupBy("kind").agg(F.first("parts").alias("parts"), F.sum("copies").alias("n")), "kind")
    # numbers from 1 on, side by side for sets that share a class
    kind = store(kind.sort("parts", "kind").withColumn("place", F.monotonically_increasing_id()), "numbered")
    block = kind.groupBy(F.shiftright("place", 33).alias("block")).agg(F.count(F.lit(1)).alias("m"))
    block = block.select("block", F.coalesce(F.sum("m").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    kind = kind.withColumn("block", F.shiftright("place", 33)).join(F.broadcast(block), "block").select("kind", "n", "parts", place.alias("place"))
    each = store(kind.select("kind", "n", "place", F.explode("parts").alias("part")), "classes").select("kind", "n", "place", "part.*")
    each = store(map_batches(each, tree_nodes, "kind long, n long, place long, one long, node int, inside int"), "nodes")
    # a bitmap for each binary digit of the number of documents
    digits = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda k: F.expr("n").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), k)) != 0)
    bits = each.select("one", "node", (1 - F.col("inside")).alias("inside"), F.bitmap_bucket_number("place").alias("bucket"), F.bitmap_bit_position("place").alias("bit"), F.explode(digits).alias("digit"))
    bits = bits.groupBy("one", "node", "inside", "bucket", "digit").agg(F.bitmap_construct_agg("bit").alias("bits"))
    found = each.select("kind", "one", "node", "inside").join(bits, ["one", "node", "inside"]).groupBy("kind", "bucket", "digit").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("m"))
    found = found.groupBy("kind").agg(F.sum(F.call_function("shiftleft", F.col("m"), F.col("digit"))).alias("all"))
    return kinds.join(found, "kind").select("sig", (F.col("all") - F.col("copies")).alias("others"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 50, similarity: float = 0.8, hashes: int = 6) -> tuple[DataFrame, DataFrame]:
    """Documents with repeated passages, and the verified links between texts.

    The first has doc, sig, class (the smallest id reachable), n_links (other
    documents in the same passage classes, copies included), spans (words from, to): only documents that repeat
    something. The second is LINK, in words, between text hashes.
    """
    with free_shuffles(docs.sparkSession):
        return find_repeated(docs, id_col, text_col, words, similarity, hashes)


def find_repeated(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: float, hashes: int) -> tuple[DataFrame, DataFrame]:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("sig"), text.alias("body"))
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = first_meetings(candidate_rows(rows.select("sig", "body"), words, hashes, buckets))
    link = [x.split()[0] for x in LINK.split(", ")]

    owners = store(rows.select("doc", "sig", F.octet_length("body").alias("size")).distinct(), "owners")
    one_of = owners.groupBy("sig").agg(F.min(F.struct(F.col("doc").isNull(), "doc")).alias("m")).select("sig", F.col("m.doc").alias("doc"))
    asked = met.select(F.explode(F.array("one", "other")).alias("sig")).distinct().join(one_of, "sig").select(F.col("sig").alias("s"), F.col("doc").alias("d"))
    texts = rows.join(asked, rows.doc.eqNullSafe(asked.d) & (rows.sig == asked.s)).select("sig", "body").dropDuplicates(["sig"])
    texts = store(map_batches(texts, letters_of, "sig long, letters binary"), "texts")
    links, small, turn = None, None, 0
    while True:
        seen = store(verify(met.withColumn("round", F.lit(turn)), texts, words, similarity), "passages")
        part = seen.where("grp IS NULL").select(*link)
        links = part if links is None else links.unionByName(part)
        again = seen.where("grp IS NOT NULL").select("grp", F.col("other").alias("text"), "at", "ahead", "behind").distinct()
        size = again.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("low"), F.max("text").alias("high")).where("low <> high").select("grp", "n")
        again = store(again.join(size, "grp"), "again")
        # groups that fit into a task go through their rounds there
        turn += 1
        few = again.where(F.col("n") <= GROUP_ROWS).drop("n").withColumn("round", F.lit(turn))
        small = few if small is None else small.unionByName(few)
        again = again.where(F.col("n") > GROUP_ROWS)
        if again.isEmpty():
            break
        met = store(meet_again(again.drop("n")), "met")
    met = store(meet_in_groups(near_places(small, texts, words)).distinct().select("*", F.lit(0).alias("ahead"), F.lit(0).alias("behind")), "met")
    links = links.unionByName(verify(met, texts, words, similarity, longer=False).select(*link))
    links = store(links.distinct(), "links-found")

    roots = components(links.select(F.col("one").alias("a"), F.col("other").alias("b")))
    spans = links.select(F.col("one").alias("sig"), F.struct(F.col("one_start").alias("start"), F.col("one_stop").alias("stop")).alias("span")).unionByName(
        links.select(F.col("other").alias("sig"), F.struct(F.col("other_start").alias("start"), F.col("other_stop").alias("stop")).alias("span")))
    spans = spans.groupBy("sig").agg(F.sort_array(F.collect_set("span")).alias("spans"))
    # equal texts repeat each other as a whole, if they are long enough
    copies = owners.groupBy("sig").agg(F.count(F.lit(1)).alias("copies"), F.min("doc").alias("low"))
    others = count_links(links, copies.select("sig", "copies"), words)
    long = owners.where(F.col("size") >= 2 * words - 1).join(copies.where("copies > 1").select("sig"), "sig", "left_semi")
    few = rows.join(long.select(F.col("doc").alias("d"), F.col("sig").alias("s")), F.col("doc").eqNullSafe(F.col("d")) & (F.col("sig") == F.col("s")), "left_semi")
    whole = map_batches(few.select("sig", "body"), count_words, "sig long, n int").distinct().where(F.col("n") >= words)
    state = copies.join(spans, "sig", "left").join(others, "sig", "left").join(whole, "sig", "left").join(roots.withColumnRenamed("node", "sig"), "sig", "left")
    state = state.where("spans IS NOT NULL OR n IS NOT NULL").select(
        "sig", "low", F.coalesce("root", "sig").alias("root"),
        (F.coalesce("others", F.lit(0)) + F.when(F.col("n").isNotNull(), F.col("copies") - 1).otherwise(0)).alias("n_links"),
        F.when(F.col("n").isNotNull(), F.array(F.struct(F.lit(0).alias("start"), F.col("n").alias("stop")))).otherwise(F.col("spans")).alias("spans"))
    state = store(state, "repeats")
    names = state.groupBy("root").agg(F.min("low").alias("class"))
    named = state.join(names, "root").select("sig", "class", "n_links", "spans")
    return owners.join(named, "sig").select("doc", "sig", "class", "n_links", "spans"), links


def letters_of(batches):
    """48 bits of the shingles of each text, which several steps compare."""
    for batch in batches:
        letters = [shingles(t.as_py()).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for t in batch.column("body")]
        yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(letters, pa.binary())], ["sig", "letters"])


def letters_in(letters: bytes) -> np.ndarray:
    wide = np.zeros((len(letters) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(letters, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64)[:, 0]


def count_words(batches):
    for batch in batches:
        n = [len(words_of(t.as_py())) for t in batch.column("body")]
        yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(n, pa.int32())], ["sig", "n"])
