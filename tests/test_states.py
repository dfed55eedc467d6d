"""Mergeable statistics: exact sums, moments, and quantiles within their rank error."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.operators import states as S

PROBS = {"q01": .01, "q25": .25, "q50": .5, "q99": .99}


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, x double")


def test_sum_is_exact_in_any_order(spark):
    rng = random.Random(1)
    values = [1e16, 1.0, -1e16, 1e-9, 3.5e300, -3.5e300, 2.0 ** -900, 0.1, -0.0, 2.0 ** 52 + 1, 1e22, -1e22, 2.0 ** 60, 7.0]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(-30, 30) for _ in range(3000)]
    rng.shuffle(values)
    got = S.describe(S.state(frame(spark, [("a", v) for v in values]).repartition(7), "x", ["g"]), ["g"]).first()
    assert got["sum"] == pytest.approx(math.fsum(values), rel=1e-15) and got.n == len(values)
    small = [1e16, 1.0, 1.0, -1e16]
    assert S.describe(S.state(frame(spark, [("a", v) for v in small]), "x")).first()["sum"] == 2.0


def test_chunks_merge_to_the_whole(spark):
    rng = np.random.default_rng(2)
    rows = [("abc"[int(i)], float(v)) for i, v in zip(rng.integers(0, 3, 30_000), rng.lognormal(3, 1, 30_000) + 1e6)]
    rows += [("a", None), ("d", None), ("e", 5.0), (None, 1.0), (None, 3.0), ("a", math.nan), ("b", math.inf)]
    whole = frame(spark, rows)
    parts = [S.state(whole.where(F.abs(F.xxhash64("x")) % 3 == i), "x", ["g"]) for i in range(3)]
    merged = {r.g: r for r in S.describe(S.merge(parts, ["g"]), ["g"], PROBS).collect()}
    once = {r.g: r for r in S.describe(S.state(whole, "x", ["g"]), ["g"], PROBS).collect()}
    assert set(merged) == set(once) == {"a", "b", "c", "d", "e", None}
    for g, r in merged.items():
        o = once[g]
        assert (r.n, r.n_not_finite, r["sum"], r["mean"], r["min"], r["max"]) == (o.n, o.n_not_finite, o["sum"], o["mean"], o["min"], o["max"])
        for c in ("variance", "skewness", "kurtosis", "error_of_mean"):
            assert r[c] == (o[c] if o[c] is None else pytest.approx(o[c], rel=1e-6, abs=1e-9)), c
        values = np.sort([v for k, v in rows if k == g and v is not None and math.isfinite(v)])
        for name, p in PROBS.items():
            if len(values):
                low, high = np.searchsorted(values, r[name], "left") / len(values), np.searchsorted(values, r[name], "right") / len(values)
                assert low - 2 * r.rank_error <= p <= high + 2 * r.rank_error
    assert merged["d"].n == 0 and merged["d"]["sum"] is None and merged["d"].q50 is None
    assert merged["a"].n_not_finite == 1 and merged[None]["mean"] == 2.0


def test_without_groups_and_empty(spark):
    rows = frame(spark, [("a", 1.0), ("b", 2.0), ("c", 6.0)])
    got = S.describe(S.merge([S.state(rows, "x"), S.state(rows.limit(0), "x")]), probs={"m": .5}).first()
    assert (got.n, got["sum"], got["mean"], got["min"], got["max"], got.m) == (3, 9.0, 3.0, 1.0, 6.0, 2.0)
    assert got.variance == pytest.approx(7.0)
    assert S.describe(S.state(rows.limit(0), "x", ["g"]), ["g"]).count() == 0
    none = S.describe(S.state(rows.limit(0), "x")).first()
    assert none.n == 0 and none["sum"] is None


def test_states_can_be_stored(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") % 3).cast("string").alias("g"), F.col("id").cast("double").alias("x"))
    S.state(rows, "x", ["g"]).write.parquet(str(tmp_path / "s"))
    back = S.describe(S.merge([spark.read.parquet(str(tmp_path / "s"))], ["g"]), ["g"], PROBS)
    assert {r.g: (r.n, r["sum"]) for r in back.collect()} == {"0": (334, 166833.0), "1": (333, 166167.0), "2": (333, 166500.0)}
