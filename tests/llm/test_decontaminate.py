"""Suffix arrays against plain window comparison."""

import random
import re
import time

import numpy as np
import pytest

from cohortspark.llm import decontaminate as D


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window):
    out = []
    for i, t in docs:
        w, hit, listed = words(t), set(), set()
        for k, x in items:
            v = words(x)
            n = min(window, len(v))
            for p in range(len(v) - n + 1 if v else 0):
                for q in range(len(w) - n + 1):
                    if w[q:q + n] == v[p:p + n]:
                        hit.update(range(q, q + n))
                        listed |= {k} - {None}
        out.append((i, len(w), len(hit), tuple(sorted(listed)), tuple(sorted(hit))))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(7)
    vocabulary = ["Ab", "É", "é", "c3", "x", "y", "z", "naïve"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 5, 9, 14])))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "?!"), (53, items[3][1]), (None, "lost item words here now"), (54, items[4][1])]
    docs = [(i, None if i == 3 else "" if i == 4 else ("\n" if i % 2 else ", ").join(rng.choice([*vocabulary, "out", "side"]) for _ in range(rng.choice([1, 3, 30, 200]))))
            for i in range(60)]
    docs += [(100, f"Well: {items[5][1].upper()}"), (101, "so LOST item; words here-now ok"), (101, "so LOST item; words here-now ok"), (None, items[2][1])]
    return docs, items


@pytest.mark.parametrize(("window", "shard", "block"), [(4, 10_000, 10_000), (4, 50, 20), (10, 300, 10_000)])
def test_same_as_windows(spark, window, shard, block):
    docs, items = cases()
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id long, text string, item_id int, start string").repartition(3)
    bench = spark.createDataFrame([(k, x, "z") for k, x in items], "item_id long, text string, window string")
    got = D.scan(df, bench, window=window, shard_words=shard, block_words=block)
    assert got.columns[:4] == df.columns
    rows = sorted(((r.doc_id, r["__n_words"], r["__n_hit"], tuple(r["__items"]), tuple(k for s in r["__spans"] for k in range(s.start, s.stop)))
                   for r in got.collect()), key=repr)
    assert rows == brute(docs, items, window)
    left = D.clean(df, bench, window=window)
    assert left.columns == df.columns
    assert left.count() == sum(not n for _, _, n, _, _ in brute(docs, items, window))


def test_array_is_sorted_and_search_finds_all():
    rng = np.random.default_rng(2)
    tests = D.Tests([(0, b"a b a b a b a b a b a b a b"), (1, b"c a b d")], 3)
    text = rng.integers(0, 5, 3000)
    text[500:900] = 1
    shard = D.Shard(tests, [text[:1000], text[1000:1001], text[1001:1001], text[1001:]])
    tail = lambda p: tuple(x for x in [*(list(shard.codes[p:p + tests.depth]))])
    cut = lambda t: t[:t.index(0)] if 0 in t else t
    tails = [cut(tail(p)) for p in shard.order]
    assert tails == sorted(tails) and len(tails) == np.count_nonzero(shard.codes)


def test_longest_matches(spark):
    docs, items = cases()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["item"], r.item_start): r for r in D.longest_matches(df, bench, shard_words=100).collect() if r["item"] is not None}
    texts = {i: words(t) for i, t in docs}
    flat = [f" {' '.join(w)} " for w in texts.values()]
    for k, x in items:
        v = words(x)
        for p in range(len(v) if k is not None else 0):
            n = max((m for m in range(len(v) - p + 1) if any(f" {' '.join(v[p:p + m])} " in f for f in flat if m)), default=0)
            r = got.get((k, p))
            assert (r.length if r else 0) == n
            if r and r.doc is not None:
                assert texts[r.doc][r.doc_start:r.doc_start + n] == v[p:p + n]


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.clean(df, none).count() == 1
    assert D.scan(df.limit(0), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


def test_many_tiny_documents_that_are_hit():
    tests = D.Tests([(7, b"word")], 10)
    texts = [np.array([1], np.int64)] * 80_000
    start = time.time()
    hits = list(D.Shard(tests, texts).hits())
    assert time.time() - start < 3
    assert hits == [(i, [(0, 1)], [0]) for i in range(80_000)]
