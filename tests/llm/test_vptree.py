"""Vantage-point trees against comparing all pairs."""

import numpy as np
import pytest

from cohortspark.llm import vptree as V


def rows():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 16))
    out = [(i, (centers[rng.integers(12)] + .4 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(900)]
    out += [(1000 + i, out[50][1]) for i in range(300)]  # a very common vector
    out += [(1300, [2 * x for x in out[7][1]]), (1350, out[3][1]), (1350, out[3][1]), (None, out[3][1]), (1400, None), (1450, []), (1500, [0.0] * 16),
            (1550, [float("nan")] + [1.0] * 15), (1600, [float("inf")] + [1.0] * 15), (1650, [None] + [1.0] * 15), (1700, [1.0, 2.0]), (1701, [2.0, 1.0]),
            (1750, [1e-30] * 16), (1800, [1e30] * 15 + [-1e30])]
    return out


def brute(data, k):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in data if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    ok = {(i, tuple(v)): v for i, v in ok}
    out = {}
    for (i, _), q in ok.items():
        if i % 50 == 0:
            found = [(-V.cosine(q[None], v[None])[0], j) for (j, _), v in ok.items() if j != i and len(v) == len(q)]
            out[i] = [(j, -s) for s, j in sorted(found)[:k]]
    return out


def run(spark, data, k, factor, shard_rows=128, block_rows=7):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in data], "vec_id long, embedding array<float>, dim int, score int").repartition(3)
    found = V.nearest(V.index(df, k=k, shard_rows=shard_rows), df.where("vec_id % 50 = 0"), k=k, factor=factor, block_rows=block_rows)
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_factor_one_is_exact(spark):
    got, want = run(spark, rows(), 5, 1.0), brute(rows(), 5)
    assert got.keys() == {q for q, f in want.items() if f}
    for q, found in got.items():
        assert [s for _, s in found] == pytest.approx([s for _, s in want[q]], abs=1e-12)
        if q not in (1300,):
            assert found == want[q]


def test_larger_factor_measures_less_and_finds_most():
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(40, 8))
    x = centers[rng.integers(40, size=4000)] + .2 * rng.normal(size=(4000, 8))
    order, inner, outer = V.build(x)
    q, points = V.unit(x[:100]), V.unit(x)[order]
    done = {}
    for factor in (1.0, 1.5, 4.0):
        s = V.Search(points, inner, outer, q, 6, factor)
        s.walk(np.arange(100), 0, len(x))
        done[factor] = s
    best = np.argsort(-(q @ points.T), axis=1, kind="stable")[:, :6]
    recall = {f: np.mean([len(set(a) & set(b)) / 6 for a, b in zip(s.found, best)]) for f, s in done.items()}
    assert recall[1.0] == 1 and recall[1.5] > .9
    assert done[4.0].measured < done[1.5].measured < done[1.0].measured < 100 * 4000


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    data = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    want, got = brute(data, 5), run(spark, data, 5, 1.0)
    assert np.mean([len({j for j, _ in got[q]} & {j for j, _ in f}) / 5 for q, f in want.items()]) >= .9


def test_empty_and_single(spark):
    assert run(spark, [], 5, 1.0) == {}
    assert run(spark, [(50, [1.0, 0.0])], 5, 1.0) == {}
    assert run(spark, [(50, [1.0, 0.0]), (1, [1.0, 1.0])], 5, 1.0) == {50: [(1, pytest.approx(.5 ** .5))]}


def test_ties_and_noisy_copies_have_exact_ids(spark):
    rng = np.random.default_rng(11)
    signs = [(i, rng.choice([-1.0, 1.0], 8).tolist()) for i in rng.permutation(600).tolist()]
    assert run(spark, signs, 5, 1.0, shard_rows=700) == brute(signs, 5)
    # float32 copies of one direction with noise in the last bit, and of several lengths
    base = rng.normal(size=16).astype(np.float32)
    noisy = [(i, np.nextafter(base, np.float32(rng.choice([-9, 9])) * np.ones(16, np.float32)).tolist() if i % 3 else
              (base * np.float32(2.0 ** rng.integers(-3, 4))).tolist()) for i in range(300)]
    noisy += [(1000 + i, (base * (1 + 1e-7 * rng.integers(-1, 2, 16))).astype(np.float32).tolist()) for i in range(400)]
    assert run(spark, noisy, 5, 1.0, shard_rows=1000) == brute(noisy, 5)
