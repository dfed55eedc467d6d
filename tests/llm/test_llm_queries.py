"""Registered queries and pipeline stages on the smallest tables, against SQL or plain Python."""

import math
import os
import sys
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
import test_alignment as alignment  # noqa: E402
import test_compact_windows as windows  # noqa: E402
import test_decontaminate as leaks  # noqa: E402
import test_host_trust as hosts  # noqa: E402
import test_licenses as licenses  # noqa: E402
import test_line_dedup as lines  # noqa: E402
import test_packing as packing  # noqa: E402
import test_simhash as simhash  # noqa: E402
import test_suffixes as suffixes  # noqa: E402
import test_vptree as vptree  # noqa: E402

from cohortspark.llm import quality_gam, queries  # noqa: E402
from cohortspark.llm.common import store  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def table(name):
    return duckdb.sql(f"SELECT * FROM '{FOLDER}/{name}.parquet'").fetchall()


def got(spark, name):
    return queries.queries()[name](spark, FOLDER)


@pytest.fixture(scope="module")
def docs():
    return [(r[0], r[1]) for r in table("documents")]


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    cur = con.execute(queries.oracles()[name])
    df = got(spark, name)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(cur.fetchall(), key=repr)


def test_url_filter(spark):
    out = [(r.page_id, r.host, r.path, r.rule, r.verdict, round(r.trust or 0, 4), round(r.distrust or 0, 4)) for r in got(spark, "op2_url_filter").collect()]
    assert sorted(out, key=repr) == hosts.brute(table("pages"), queries.URL_RULES)


def test_quality(spark):
    rows = {r.doc_id: r for r in got(spark, "op3_quality").collect()}
    assert len(rows) == len(table("documents"))
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= .3)
    # the learned tables, looked up one by one
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = quality_gam.learn(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"), label_col="quality", sample=20_000)
    for d, text in ((r[0], r[1]) for r in table("documents")):
        x = quality_gam.features((text or "").encode())
        total = model.base
        for v, edges, values in zip(x, model.edges, model.tables):
            total += values[bisect_right(edges.tolist(), v)]
        for (i, j), values in model.pairs.items():
            total += values[bisect_right(model.pair_edges[i].tolist(), x[i])][bisect_right(model.pair_edges[j].tolist(), x[j])]
        assert rows[d].score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, total)))), abs=1e-12)


def check_packed(rows, docs, capacity=2048):
    want = Counter()
    for i, t in docs:
        ids = [*packing.slow(t), 0]
        head = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(head, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        ends = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= capacity
    assert len(by) == packing.first_fit([r.length for r in rows], capacity)


def test_pack(spark, docs):
    check_packed(got(spark, "op5_pack").collect(), docs)


def test_nearest(spark):
    want = vptree.brute([(r[0], r[1]) for r in table("embeddings")], 5)
    out = defaultdict(list)
    for r in got(spark, "op6_nearest").orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
    assert dict(out) == want


def test_simhash(spark, docs):
    out = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got(spark, "op7_simhash").collect()), key=repr)
    assert out == simhash.classes([(i, simhash.print_of(t)) for i, t in docs], 2)


def test_repeats(spark, docs):
    out = {r.doc_id: r for r in got(spark, "op9_repeats").collect()}
    exact = windows.repeats(docs, 50)
    assert set(exact) <= set(out)
    for i, need in exact.items():
        covered = {k for p in out[i].passages.split(",") for k in range(*map(int, p.split("-")))}
        assert need <= covered


def test_licenses(spark, docs):
    out = sorted((tuple(r) for r in got(spark, "op10_license_scan").collect()), key=repr)
    assert out == sorted(((i, *licenses.brute(t)) for i, t in docs), key=repr)


def test_align(spark, docs):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    out = got(spark, "op11_align").select(*names).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(alignment.brute(docs)[0], key=repr)


def test_suffix_dedup(spark, docs):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    out = got(spark, "op13_suffix_dedup").select(*names).collect()
    assert sorted(map(tuple, out), key=repr) == suffixes.brute(docs)


def test_pipeline_stages(spark, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_copies", "leaks", "sequences"]
    steps = dict(corpus_pipeline.STAGES)
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, state = df.columns, df

    def rows(d):
        return sorted(((r.doc_id, r.text) for r in d.collect()), key=repr)

    def run(name):
        out = store(steps[name](spark, state, FOLDER), name)
        assert out.columns == columns
        assert out.where("n_chars <> char_length(text)").count() == 0
        return out

    kept = run("quality")
    model = quality_gam.learn(df, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    score = model.score(np.array([quality_gam.features(t.encode()) for _, t in docs]))
    assert rows(kept) == sorted([d for d, s in zip(docs, score) if s >= .3], key=repr)

    before, state = rows(kept), kept
    out = run("lines")
    # the first document of a line is that with the smallest id, as ids differ
    assert rows(out) == sorted(((i, t) for i, _, _, t in lines.brute(before, "first", 10)), key=repr)

    before, state = rows(out), out
    out = run("near_copies")
    classes = simhash.classes([(i, simhash.print_of(t)) for i, t in before], 2)
    assert {i for i, _ in rows(out)} == {c for _, _, c in classes} and set(rows(out)) <= set(before)

    before, state = rows(out), out
    out = run("leaks")
    hit = {r[0] for r in leaks.brute(before, [(r[0], r[1]) for r in table("benchmark")], 10) if r[2]}
    assert rows(out) == [d for d in before if d[0] not in hit]

    check_packed(steps["sequences"](spark, out, FOLDER).collect(), rows(out))
    assert corpus_pipeline.run(spark, FOLDER).count() >= out.count()


def test_pipeline_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() == 0 and (name == "sequences" or out.columns == docs.columns)
