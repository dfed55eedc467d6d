"""Dedupe over chunks: what is kept, what is late, and nothing lost."""

import datetime as dt

from cohortspark.streaming import streams as S

T0 = dt.datetime(2024, 1, 10)


def run(spark, tmp_path, chunks, delay="2 hours"):
    schema = "k string, ts timestamp, v int"
    folder = str(tmp_path / "in")
    for i, rows in enumerate(chunks):
        df = spark.createDataFrame([(k, None if h is None else T0 + dt.timedelta(hours=h), v) for k, h, v in rows], schema)
        df.coalesce(1).write.mode("append").parquet(folder)
    kept, late = S.dedupe_with_late(S.stream_files(spark, folder, schema, files_per_chunk=1), ["k"], "ts", delay)
    out = lambda d: sorted(((r.chunk, r.k, r.v) for r in d.collect()), key=repr)
    return out(kept), out(late)


def test_repeats_and_late_rows(spark, tmp_path):
    chunks = [[("a", 0, 1), ("a", 0, 1), ("b", 1, 2), (None, 1, 3)], [("a", 1, 4), ("c", 5, 5), (None, 2, 6)], [("b", 1, 7), ("d", 4, 8), ("e", None, 9), ("c", 5, 10)],
              [("c", 9, 11), ("f", 9, 12)], [("a", 9, 13), ("c", 9, 14)]]
    kept, late = run(spark, tmp_path, chunks)
    assert kept == sorted([(0, "a", 1), (0, "b", 2), (0, None, 3), (1, "c", 5), (2, "d", 8), (3, "f", 12), (4, "a", 13)], key=repr)
    # a is no longer remembered when rows before 3 hours are late, c still is at 9 hours
    assert late == [(2, "b", 7), (2, "e", 9)]


def test_falling_times_lose_no_key(spark, tmp_path):
    chunks = [[(f"k{i}", 100 - 10 * c, i) for i in range(5 * c, 5 * c + 7)] for c in range(4)]
    kept, late = run(spark, tmp_path, chunks)
    assert {k for _, k, _ in kept + late} == {f"k{i}" for i in range(22)} and {c for c, _, _ in late} == {1, 2, 3}


def test_no_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    kept, late = run(spark, tmp_path, [])
    assert kept == late == []
