"""SimHash groups against all pairs."""

import random
import re

import pytest
import xxhash

from cohortspark.llm import simhash as S
from cohortspark.llm.common import components


def print_of(text, width=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [words[i:i + width] for i in range(len(words) - width + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(points, bits):
    """Component of each (id, fingerprint) by comparing all pairs."""
    up = list(range(len(points)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if (points[i][1] ^ points[j][1]).bit_count() <= bits:
                up[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(points):
        if d is not None:
            low[top(i)] = min(d, low.get(top(i), d))
    return sorted(((d, f, low.get(top(i))) for i, (d, f) in enumerate(points)), key=repr)


def texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(80)] + ["É", "é", "Ünï"]
    out = [None, "", " \t\n", "one", "One TWO", "one two", "a\x0bb\x0cc\rd", "a b c d"]
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 400]))]
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy).upper() if rng.random() < .2 else "  ".join(copy))
    return out + [" ".join(f"v{i}" for i in range(70_000))]


def test_fingerprints_and_components(spark):
    docs = [(i, t) for i, t in enumerate(texts())] + [(3, "one"), (None, "alone on its own here"), (None, None)]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, fp int")
    got = S.groups(S.fingerprints(df), 2).collect()
    want = classes([(i, print_of(t)) for i, t in docs], 2)
    assert sorted(((r.doc, r.fp % (1 << 64), r.component) for r in got), key=repr) == want


@pytest.mark.parametrize(("crowd", "blocks"), [(200, 3), (200, 4), (2, 4)])
def test_links_lose_nothing(spark, crowd, blocks):
    rng = random.Random(1)
    points = set()
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(12):
            points.add(f)
            for _ in range(rng.choice([1, 2, 3])):
                f ^= 1 << rng.randrange(64)
    points = sorted(points)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = S.close_links(df, 2, blocks, crowd)
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 2 or crowd == 2 for a, b in links.collect())
    root = dict(map(tuple, components(links).collect()))
    got = {p % (1 << 64): root.get(p, p) for p in signed}
    want = classes([(p, p) for p in points], 2)
    assert len({(got[p], c) for p, _, c in want}) == len(set(got.values())) == len({c for _, _, c in want})


def test_one_row_of_each_group_stays(spark):
    rows = [(5, "x y z w", 1, "a"), (2, "x y z w", 2, "b"), (2, "x y z w", 2, "b"), (None, "x y z w", 3, "c"), (7, None, 4, "d"), (8, "", 5, "e"),
            (9, "quite another text stands here", 6, "f"), (None, "only null ids here at all", 7, "g"), (None, "only null ids here at all", 8, "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, low string")
    out = S.representatives(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(2, "x y z w"), (7, None), (9, rows[6][1]), (None, rows[7][1])], key=repr)
    assert S.representatives(df.limit(0)).count() == 0


def test_odd_distance_is_refused(spark):
    with pytest.raises(ValueError):
        S.close_links(spark.createDataFrame([(1,)], "fp long"), 3)
