"""Exact substring dedup against a set of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cohortspark.llm import suffixes

LENGTH = 200


def brute(docs, length=LENGTH):
    texts = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(t[i:i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        cover = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                cover[i:i + length] = True
        kept = bytes(b for b, c in zip(t, cover) if not c)
        out.append((d, len(t), int(cover.sum()), int((np.diff(cover.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, docs, **how):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS doc", "1 AS at", "'y' AS spans")
    got = suffixes.remove_repeats(df.repartition(5), length=LENGTH, **how)
    assert got.columns[:5] == df.columns
    return sorted(((r.doc_id, r["__n_bytes"], r["__n_removed"], len(r["__spans"]), hashlib.sha256(r["__kept"]).hexdigest()) for r in got.collect()), key=repr)


def words(rng, n, some=3000):
    return " ".join(f"w{rng.randrange(some)}" for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    base = [words(rng, rng.randint(0, 250)) for _ in range(40)]
    passage, line = words(rng, 60), words(rng, 45)
    docs = list(base)
    docs += [base[3]] * 5 + [base[4] + " tail"] * 2
    for k in range(30):  # near copies, changed at one byte or cut somewhere
        t = base[k % 10]
        at = rng.randrange(len(t) + 1)
        docs.append(t[:at] + rng.choice(["", "x", "\n\n", "é"]) + t[at + rng.randrange(3):])
    docs += [words(rng, rng.randint(0, 30)) + " " + passage + " " + words(rng, rng.randint(0, 30)) for _ in range(25)]
    docs += [words(rng, 10) + line[:rng.randrange(150, len(line))] + words(rng, 10) for _ in range(40)]
    docs += [passage + words(rng, 3) + passage, "a" * 900, "a" * 199, "a" * 200, "ab" * 400, "xyz" * 70 + "q" + "xyz" * 70]
    docs += ["好" * 67, "好" * 66, "\0" * 450, passage[:150] + "\0" * 60, passage[:150], "", line[:200], line[1:201], "z" + line[:199]]
    return [(i, t) for i, t in enumerate(docs)] + [(None, None), (None, passage), (7, docs[7]), (8, "other text"), (9, None)]


@pytest.mark.parametrize("seed, how", [(1, {}), (2, {"bucket_rows": 40}), (3, {"bucket_rows": 7, "hot_rows": 3})])
def test_equals_all_strings(spark, seed, how):
    docs = corpus(seed)
    assert run(spark, docs, **how) == brute(docs)


def test_frequent_beginning_over_many_buckets(spark):
    rng = random.Random(9)
    shared = words(rng, 40)[:210]
    docs = [(i, words(rng, 12) + shared[:rng.randrange(120, 211)] + words(rng, 12)) for i in range(150)]
    assert run(spark, docs, bucket_rows=10) == brute(docs)


def test_a_place_at_the_bounds_has_few_rows(spark, monkeypatch):
    """Many texts share one passage over many buckets: no step has a row for each string of a place."""
    rng = random.Random(11)
    shared = words(rng, 90)[:420]
    docs = [(i, words(rng, 40) + " " + shared + " " + words(rng, 40)) for i in range(120)]
    steps, store = [], suffixes.store

    def counted(df, label):
        out = store(df, label)
        if label in ("buckets", "edges"):
            steps.append(out.where("c1 IS NOT NULL").count() if label == "buckets" else out.count())
        return out

    monkeypatch.setattr(suffixes, "store", counted)
    got = run(spark, docs, bucket_rows=20)
    assert len(steps) >= 2 and steps[0] >= 100 and max(steps[1:]) <= 5 * steps[0]
    assert got == brute(docs)


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "short")]) == brute([(1, None), (2, "short")])


def test_long_text_in_parts():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 100, 7_000_000, dtype=np.uint8).tobytes()
    own, place, first, last, gram = suffixes.text_runs([text], LENGTH)
    assert (own == 0).all() and first[0] == 0 and last[-1] == len(text) - LENGTH
    assert (first[1:] == last[:-1] + 1).all() and (np.diff(place) > 0).all()
    assert ((place >= first) & (place + suffixes.GRAM <= first + LENGTH)).all() and ((place >= last) & (place + suffixes.GRAM <= last + LENGTH)).all()


def test_multikey_sort():
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(0, 3, rng.integers(0, 24), dtype=np.uint8)) for _ in range(20_000)]
    rows, size = suffixes.padded(texts, 24)
    order = suffixes.multikey_sort(rows.view(">u8").astype(np.uint64), size)
    assert [texts[i] for i in order] == sorted(texts)
