"""The additive model on made-up and on labelled rows."""

import zlib

import numpy as np
import pytest

from cohortspark.llm import quality_gam as Q

FOLDER = "/root/testdata/sf0.01"


def test_tables_learn_single_features_and_a_pair():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 4))
    truth = lambda v: 2.0 * (np.abs(v[:, 0]) < .7) - 1 + 3.0 * ((v[:, 1] > 0) ^ (v[:, 2] > 0)) - 1.5 > 0  # a sum of one feature and one pair
    y = truth(x).astype(float)
    alone = Q.fit(x, y, pairs=0)
    both = Q.fit(x, y, pairs=3)
    test = rng.normal(size=(4000, 4))
    want = truth(test)
    right = lambda m: ((m.score(test) > .5) == want).mean()
    assert (1, 2) in both.pairs and right(both) > right(alone) + .1 and right(both) > .9
    by_hand = both.base + sum(t[np.searchsorted(e, test[7, j], "right")] for j, (e, t) in enumerate(zip(both.edges, both.tables)))
    by_hand += sum(t[np.searchsorted(both.pair_edges[i], test[7, i], "right"), np.searchsorted(both.pair_edges[j], test[7, j], "right")]
                   for (i, j), t in both.pairs.items())
    assert both.score(test)[7] == pytest.approx(1 / (1 + np.exp(-by_hand)))


def test_trees():
    g, h = np.array([5., 5, -5, -5, 5]), np.ones(5)
    assert Q.shallow_tree(g, h, 2).tolist() == pytest.approx([10 / 3, 10 / 3, -5 / 4, -5 / 4, -5 / 4])
    assert Q.shallow_tree(g, h, 1).tolist() == pytest.approx([5 / 6] * 5)
    win, cells = Q.cross_tree(np.array([[9., -9], [-9, 9]]), np.ones((2, 2)))
    assert cells.tolist() == [[4.5, -4.5], [-4.5, 4.5]] and win > 0


def test_features_take_whole_texts():
    assert Q.features(b"") == Q.features(None) == [0.0] * len(Q.FEATURES)
    assert len(Q.features(b"x")) == len(Q.features(b"a b\n" * 50_000)) == len(Q.FEATURES)
    assert Q.features(b"a b c d " * 1000) != Q.features(b"a b c d " * 1000 + b"!")


def test_held_out_accuracy_and_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumnRenamed("lang", "quality")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = Q.score(docs, Q.learn(docs, labels))
    assert scored.columns == [*docs.columns, "__score"]
    rows = {r.doc_id: r["__score"] for r in scored.collect()}
    assert len(rows) == docs.count() and all(0 <= s <= 1 for s in rows.values())
    kept = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.quality is not None]
    assert np.mean([(rows[r.doc_id] >= .3) == (r.quality == 1) for r in kept]) > .9
    flags = {r.doc_id: r.h for r in docs.select("doc_id", Q.held_out().alias("h")).collect()}
    assert flags == {d: zlib.crc32(str(d).encode()) % 5 == 0 for d in rows}


def test_an_id_that_repeats_brings_no_more_rows_than_the_sample(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("1L AS doc_id", "concat('text ', id) AS text").unionByName(spark.createDataFrame([(2, "a b")], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(Q, "fit", lambda x, y: seen.append((len(x), len(y))) or Q.Model(0.0, [], []))
    Q.learn(docs, labels, sample=50)
    assert seen == [(50, 50)]


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "a b", 3), (3, "A! " * 9, 4), (3, "A! " * 9, 4)], "doc_id long, text string, y int")
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, None), (None, 1), (9, 1)], "doc_id long, quality int")
    got = Q.score(docs, Q.learn(docs, labels)).collect()
    assert len(got) == 5 and got[0]["__score"] == got[1]["__score"] and got[3]["__score"] == got[4]["__score"]
    half = Q.score(docs, Q.learn(docs, labels.limit(0))).collect()
    assert {r["__score"] for r in half} == {.5}
    assert Q.accepted(docs.limit(0), labels).columns == docs.columns
    assert Q.accepted(docs.limit(0), labels).count() == 0
