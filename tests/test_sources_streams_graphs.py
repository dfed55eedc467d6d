"""Files, tables, streams, graphs and the assessment layer."""

import math
import os

import pytest
from pyspark.sql import functions as F

from cohortspark.operators import apply as P
from cohortspark.operators import graph as G
from cohortspark.plans import assessment as A
from cohortspark.sources import files as I
from cohortspark.sources import types as K
from cohortspark.sources import warehouse as W
from cohortspark.streaming import streams as S
from conftest import rows


def write(path, text):
    os.makedirs(os.path.dirname(str(path)), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def test_read_csv_infers_over_all_rows(spark, tmp_path):
    p = write(tmp_path / "a.csv", 'id,n,when,flag,txt,big\n1,"1,234",2020-01-02,T,NA,3000000000\n2,5.5,2020-02-30x,F,b,1\n3,7,,,"c, d",\n')
    df = I.read_csv(spark, p)
    assert dict(df.dtypes) == {"id": "int", "n": "double", "when": "string", "flag": "boolean", "txt": "string", "big": "bigint"}
    assert rows(df.select("n", "txt"), "n") == [(5.5, "b"), (7.0, "c, d"), (1234.0, None)]
    assert I.infer_schema(spark, p)["when"] == "character"  # the late text cell counts
    assert I.read_csv(spark, p, col_types="i_c__c").columns == ["id", "when", "big"]


def test_guess_types_by_shape(spark):
    cells = {"a": ["1", "2"], "b": ["1", "x"], "c": ["1.5", "NA"], "d": ["10:20", "11:30 PM"], "e": ["2020-01-01T10:00:00", ""], "f": ["", "NA"], "g": ["true", "F"], "h": ["2021-02-29", "2021-02-28"]}
    df = spark.createDataFrame(list(zip(*cells.values())), ", ".join(f"{k} string" for k in cells))
    assert K.guess_types(df) == {"a": "integer", "b": "character", "c": "double", "d": "time", "e": "datetime", "f": "character", "g": "logical", "h": "character"}
    assert K.cols_condense({"a": "double", "b": "double", "c": "date"}) == {".default": "double", "c": "date"}


def test_problems_and_stop(spark):
    df = spark.createDataFrame([(1, "1"), (2, "x"), (3, None)], "id int, v string")
    assert rows(K.problems(df, {"v": "integer"}, ["id"])) == [(2, "v", "integer", "x")]
    with pytest.raises(ValueError, match="'x' in v"):
        K.stop_for_problems(df, {"v": "integer"})


def test_fixed_width_and_table(spark, tmp_path):
    p = write(tmp_path / "f.txt", "ab  12  x\ncd   3  y\n")
    assert rows(I.read_fwf(spark, p, ["a", "n", "c"])) == [("ab", 12, "x"), ("cd", 3, "y")]
    assert rows(I.read_fwf(spark, p, I.fwf_positions([1, 5], [2, 6], ["a", "n"]))) == [("ab", 12), ("cd", 3)]
    assert I.fwf_cols(a=2, b=3) == [("a", 0, 2), ("b", 2, 5)]
    assert rows(I.read_table(spark, p, ["a", "n", "c"])) == [("ab", 12, "x"), ("cd", 3, "y")]


def test_folder_of_files_skips_empty_ones(spark, tmp_path, capsys):
    write(tmp_path / "d/x/1.csv", "id,score\n1,10\n")
    write(tmp_path / "d/x/2.csv", "id,score\n2,x\n")
    write(tmp_path / "d/y/3.csv", "score,id,extra\n30,3,z\n")
    write(tmp_path / "d/empty.csv", "")
    out = I.read_assessment_files(spark, str(tmp_path / "d"))
    assert rows(out.select("id", "score", "extra")) == [(1, "10", None), (2, "x", None), (3, "30", "z")]
    assert "empty.csv" in capsys.readouterr().out


def test_json_records_missing_keys(spark, tmp_path):
    p = write(tmp_path / "r.json", '[{"Name":"Ada","Age":32,"Job":"Clerk"},{"Name":"Ben","Age":21},{},{"Name":"Cy","Job":"Cook"}]')
    df = I.read_json(spark, p, "Name string, Age int, Job string", records=True)
    assert rows(df) == sorted([("Ada", 32, "Clerk"), ("Ben", 21, None), (None, None, None), ("Cy", None, "Cook")], key=repr)


def test_tables_and_catalog(spark, tmp_path):
    with pytest.raises(ValueError):
        W.tibble(spark, a=[1, 2, 3], b=[1, 2])
    t = W.tibble(spark, a=[1, 2], b=5, c=F.col("a") * F.col("b"))
    assert rows(t) == [(1, 5, 5), (2, 5, 10)]
    assert W.deframe(W.enframe(spark, {"x": 1, "y": 2})) == {"x": 1, "y": 2}
    with pytest.raises(ValueError):
        W.collect(spark.range(10), max_rows=3)
    t.createOrReplaceTempView("small_t")
    assert W.table_exists(spark, "small_t")
    W.drop_table(spark, "small_t")
    assert not W.table_exists(spark, "small_t")
    assert rows(P.run_sql(spark, "SELECT :v AS v", v="a' OR 1=1")) == [("a' OR 1=1",)]


def test_bucketed_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_db LOCATION '{tmp_path}/db'")
    W.write_table(spark.range(20).withColumn("v", F.col("id") % 3), "t_db.b", "overwrite", cluster_by=(4, ["id"]))
    joined = spark.table("t_db.b").join(spark.table("t_db.b").withColumnRenamed("v", "w").hint("merge"), "id")
    assert joined.count() == 20 and "Exchange hashpartitioning(id" not in W.explain(joined)
    W.drop_table(spark, "t_db.b")


def test_small_side_of_lookups_is_not_hinted(spark):
    from cohortspark.operators.ordered import attach
    left, right = spark.range(10), spark.range(5).withColumn("v", F.lit(1))
    assert "ResolvedHint" not in attach(left, right, ["id"])._jdf.queryExecution().analyzed().toString()


def test_filters_and_columns_reach_the_scan(spark):
    t = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    from cohortspark.operators import verbs as V
    plan = W.explain(V.select(V.filter(t, F.col("o_totalprice") > 1000.0), "o_orderkey"))
    assert "GreaterThan(o_totalprice,1000.0)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_first_rows_limits_before_the_shuffle(spark):
    from cohortspark.operators import verbs as V
    t = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = W.explain(V.first_rows(t, 2, ["-o_totalprice", "o_orderkey"], ["o_orderstatus"]))
    assert "WindowGroupLimit" in plan and plan.index("Partial") >= 0


# ------------------------------------------------------------------ streams

def test_chunks_are_bound_in_order_and_side_effects_seen(spark, tmp_path):
    for i in range(3):
        write(tmp_path / f"in/{i}.csv", f"{i},a\n{i + 10},b\n")
    out = S.stream_csv(spark, str(tmp_path / "in"), "k int, s string", lambda c, i: c.where("s = 'a'").select("k"), "k int")
    assert rows(out.select("k")) == [(0,), (1,), (2,)] and out.select("chunk").distinct().count() == 3
    seen = []
    S.each_chunk(S.stream_files(spark, str(tmp_path / "in"), "k int, s string", "csv", 1), lambda c, i: seen.append((i, c.count())))
    assert sorted(seen) == [(0, 2), (1, 2), (2, 2)]


def test_late_rows_are_dropped(spark, tmp_path):
    src = str(tmp_path / "ev")
    schema = "ts timestamp, k string"
    mk = lambda vals: spark.createDataFrame(vals, "t string, k string").select(F.col("t").cast("timestamp").alias("ts"), "k").coalesce(1)
    chunks = [["00:10", "05:00"], ["05:30"], ["00:20", "05:40"], ["09:00"]]
    import time
    for i, at in enumerate(chunks):
        mk([(f"2024-01-01 {t}:00", "a") for t in at]).write.parquet(f"{src}/{i}")
        for f in os.listdir(f"{src}/{i}"):
            os.utime(f"{src}/{i}/{f}", (time.time() - 100 + i * 10,) * 2)
    sdf = S.stream_files(spark, src + "/*", schema, files_per_chunk=1)
    agg = S.stream_window_agg(sdf, "ts", "1 hour", watermark="1 hour", n=F.count(F.lit(1)))
    path = S.run_stream(agg)
    got = {str(r.start)[11:13]: r.n for r in spark.read.parquet(path).collect()}
    assert got == {"00": 1, "05": 3}  # the 00:20 row came after the watermark; 09 is still open


def test_stream_dedupe(spark, tmp_path):
    src = str(tmp_path / "dd")
    d = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:01:00"), (2, "2024-01-01 00:02:00")], "k int, t string").select("k", F.col("t").cast("timestamp").alias("ts"))
    d.write.parquet(src)
    path = S.run_stream(S.stream_dedupe(S.stream_files(spark, src, d.schema), ["k"], "ts", "1 day"))
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2]


# ------------------------------------------------------------------- graphs

def edges(spark, pairs, w=None):
    return spark.createDataFrame([(a, b, float(w[i]) if w else 1.0) for i, (a, b) in enumerate(pairs)], "src bigint, dst bigint, weight double")


def brute_components(pairs, ids):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(root[a], root[b])
            for v in (a, b):
                if root[v] != m:
                    root[v], changed = m, True
    return root


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components_match_brute_force(spark, shape):
    pairs = {"chain": [(i, i + 1) for i in range(40) if i != 20], "star": [(0, i) for i in range(1, 30)] + [(50, 51)],
             "random": [((i * 37) % 60, (i * 53 + 7) % 60) for i in range(35)]}[shape]
    ids = {v for p in pairs for v in p}
    assert {r.id: r.component for r in G.components(edges(spark, pairs)).collect()} == brute_components(pairs, ids)


def test_paths_levels_and_search(spark):
    e = edges(spark, [(0, 1), (1, 2), (0, 2), (2, 3), (5, 6)], [1, 1, 5, 2, 1])
    assert {r.id: r.distance for r in G.shortest_paths(e, 0).collect()} == {0: 0.0, 1: 1.0, 2: 2.0, 3: 4.0, 5: math.inf, 6: math.inf}
    assert G.st_connected(e, 0, 3) and not G.st_connected(e, 3, 0) and not G.st_connected(e, 0, 6)
    assert {r.id: r.level for r in G.topo_levels(e).collect()} == {0: 0, 1: 1, 2: 2, 3: 3, 5: 0, 6: 1}
    with pytest.raises(ValueError, match="loop"):
        G.topo_levels(edges(spark, [(0, 1), (1, 0)]))
    assert rows(G.link_components(G.components(e)).select("src", "dst")) == [(0, 5)]
    assert rows(G.degree(e, kind="out"))[0] == (0, 2) and dict(rows(G.degree(e, kind="in")))[0] == 0


# --------------------------------------------------------------- assessment

@pytest.fixture(scope="module")
def scores(spark):
    data = [(1, "R", 3, "Fall", 2010, 100.0, 20), (1, "R", 3, "Spring", 2010, 110.0, 40), (1, "R", 4, "Fall", 2011, 108.0, 30),
            (2, "R", 3, "Fall", 2010, 120.0, 60), (2, "R", 3, "Spring", 2010, 121.0, 55), (3, "R", 3, "Winter", 2010, 90.0, 10)]
    df = spark.createDataFrame(data, "student_id bigint, subject string, grade int, season string, academic_year int, score double, percentile int")
    return df.withColumn("start_ts", F.make_timestamp(F.col("academic_year"), F.lit(9), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))


def test_growth_against_norms(spark, scores):
    pairs = A.growth_pairs(scores, [("Fall", "Spring", 0), ("Fall", "Fall", 1)])
    assert rows(pairs.select("student_id", "start_season", "end_season", "start_score", "end_score")) == [(1, "Fall", "Fall", 100.0, 108.0), (1, "Fall", "Spring", 100.0, 110.0), (2, "Fall", "Spring", 120.0, 121.0)]
    norms = spark.createDataFrame([("R", 3, "Fall", "Spring", 100, 8.0, 4.0), ("R", 3, "Fall", "Spring", 115, 6.0, 2.0)], "subject string, grade int, start_season string, end_season string, start_score int, expected_growth double, sd_growth double")
    out = A.normed_growth(pairs.where("end_season = 'Spring'"), norms)
    # a score above the norm range uses the top row
    assert rows(out.select("student_id", "growth", "met", "z")) == [(1, 10.0, True, 0.5), (2, 1.0, False, -2.5)]


def test_quartile_edges_and_baseline(spark, scores):
    q = spark.createDataFrame([(24,), (25,), (50,), (75,), (None,)], "p int")
    assert [r[0] for r in q.select(A.quartile("p")).collect()] == [1, 2, 3, 4, None]
    base = A.preferred_baseline(scores, [("Spring", 1), ("Fall", 0)])
    got = {(r.student_id, r.target_year): (r.base_season, r.base_score) for r in base.collect()}
    assert got[(1, 2011)] == ("Spring", 110.0) and got[(1, 2010)] == ("Fall", 100.0)


def test_imputation_between_known_terms(spark, scores):
    got = {(r.student_id, r.season, r.academic_year): (r.score, r.imputed) for r in A.impute_scores(scores).collect()}
    assert got[(1, "Winter", 2010)] == (105.0, True) and got[(1, "Fall", 2010)] == (100.0, False)
    assert (3, "Fall", 2010) not in got


def test_checks_and_layouts(spark, scores):
    assert all(r.ok for r in A.check_scores(scores).collect())
    bad = A.check_scores(scores.withColumn("grade", F.when(F.col("student_id") == 3, 99).otherwise(F.col("grade"))))
    assert {r.rule: r.n_bad for r in bad.collect()}["grade in range"] == 1
    assert not A.check_scores(scores.drop("score")).first()["ok"]
    assert A.detect_layout(scores, {"x": {"zz"}, "y": {"score", "grade"}}) == "y"
    assert [r[0] for r in spark.createDataFrame([("K",), ("kinder",), ("3",), ("zz",)], "g string").select(A.standardize_kinder("g")).collect()] == [0, 0, 3, None]


def test_state_link_and_gain(spark, scores):
    link = spark.createDataFrame([("R", 3, "Fall", 0, 110, "low", 0.2), ("R", 3, "Fall", 110, 200, "high", 0.8)], "subject string, grade int, season string, score_lo int, score_hi int, level string, pass_prob double")
    out = A.link_to_state(scores.where("season = 'Fall' AND grade = 3"), link)
    assert rows(out.select("student_id", "level")) == [(1, "low"), (2, "high")]
    norms = spark.createDataFrame([("R", 3, "Fall", 105.0, 40), ("R", 3, "Fall", 115.0, 60), ("R", 3, "Fall", 130.0, 80)], "subject string, grade int, season string, score double, percentile int")
    need = A.gain_needed(scores.where("season = 'Fall' AND grade = 3"), norms, 50)
    assert rows(need.select("student_id", "gain_needed")) == [(1, 15.0), (2, 0.0)]


def test_permutation_p_values(spark):
    d = spark.range(60).select("id", F.when(F.col("id") < 30, "low").otherwise("high").alias("g"), F.when(F.col("id") < 30, 0.0).otherwise(10.0).alias("m"))
    out = {r.g: r for r in A.permutation_stats(d, "g", "m", "id", n=40, seed=1).collect()}
    assert out["low"].diff == -5.0 and out["low"].p_value == pytest.approx(1 / 41) and out["high"].n == 30


def test_bundle_verbs(scores):
    bundle = A.AssessmentSet(scores)
    assert A.is_assessment_set(bundle) and not A.is_assessment_set(scores)
    out = bundle.filter(F.col("grade") == 3).group_by("season").summarise(n=F.count(F.lit(1)))
    assert rows(out) == [("Fall", 2), ("Spring", 2), ("Winter", 1)]
