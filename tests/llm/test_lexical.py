"""Ranked lexical search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cohortspark.llm import lexical

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k):
    rows = [(d, Counter(terms(t))) for d, t in docs]
    n, total = sum(bool(c) for _, c in rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(w for _, c in rows for w in c)
    out = []
    for q, (item, text) in enumerate(items):
        scored = []
        for d, c in rows:
            score = 0
            for w in set(terms(text)) & set(c):
                m = 50 + 50 * sum(c.values()) * n // total
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, k, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS rank")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS doc_id")
    return sorted(map(tuple, lexical.search(d, i, k, **how).select("item", "rank", "doc", "score").collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(n)]
    return docs + [(n + i, docs[i % 7][1]) for i in range(n // 3)], words, rng


def test_equals_plain_scores(spark):
    docs, words, rng = corpus(1, 300)
    docs += [(5, docs[5][1]), (None, docs[6][1]), (None, None), (9000, ""), (9001, "!!! ..."), (9002, "ÀÉ Öß W1 w1 0 _a_"), (9003, "w2 " * 20_000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(25)] + [(3, "w1 W2"), (None, "w1 öß Öß ÀÉ"), (90, None), (91, "zzz"), (92, "")]
    for how in ({}, {"shard_postings": 500}, {"block_words": 60, "shard_postings": 900}):
        assert run(spark, docs, items, 50, **how) == brute(docs, items, 50)
    assert run(spark, docs, items, 3, shard_postings=500) == brute(docs, items, 3)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")], 5) == []
    assert run(spark, [(1, "a")], [], 5) == []
    assert run(spark, [(1, None)], [(1, "a")], 5) == []


@pytest.mark.parametrize("seed", range(30))
def test_nra_is_exact_and_reads_in_order(seed):
    rng = np.random.default_rng(seed)
    n, k, lists = int(rng.integers(1, 6000)), int(rng.integers(1, 20)), []
    total = np.zeros(n, np.int64)
    for _ in range(int(rng.integers(1, 30))):
        places = rng.permutation(n)[:int(rng.integers(0, n + 1))]
        values = np.sort(rng.integers(1, int(rng.choice([3, 1000, 10**9])), len(places)))[::-1]
        total[places] += values
        lists.append((places, values))
    docs, scores, read = lexical.nra(lists, k, n)
    some = total[total > 0]
    least = np.sort(some)[-k] if len(some) >= k else 1
    assert sorted(docs.tolist()) == np.flatnonzero(total >= least).tolist() and (total[docs] == scores).all()
    assert read <= sum(len(p) for p, _ in lists)


def test_nra_stops_early():
    places = np.arange(100_000)
    falling = np.concatenate(([10**9] * 10, np.arange(100_000 - 10, 0, -1)))
    docs, _, read = lexical.nra([(places, falling), (places, falling)], 5, 100_000)
    assert sorted(docs.tolist()) == list(range(10)) and read < 2_000
