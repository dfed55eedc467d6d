"""Level tables give what level lists give, also with more levels than a cross table may have columns."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from cohortspark.operators import factors as C
from cohortspark.operators import reshape as R
from cohortspark.operators import tabyl as X


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(["b", "a", None, "c", "b", "d", "a", "b"])], "i int, c string")


def listed(table):
    return [r.c for r in table.orderBy("level").collect()] if sorted(r.level for r in table.collect()) == list(range(1, table.count() + 1)) else None


def test_tables_equal_lists(data):
    a, f = C.levels_inorder(data, "c", "i"), C.levels_infreq(data, "c")
    ta, tf = C.table_inorder(data, "c", "i"), C.table_infreq(data, "c")
    assert listed(ta) == a == ["b", "a", "c", "d"] and listed(tf) == f and listed(C.table_sorted(data, "c")) == ["a", "b", "c", "d"]
    assert listed(C.fct_rev(ta)) == C.fct_rev(a)
    for n in (1, 3, -1, 9):
        assert listed(C.fct_shift(ta, n)) == C.fct_shift(a, n)
    for after in (0, 1, 5):
        assert listed(C.fct_relevel(ta, "d", "a", after=after)) == C.fct_relevel(a, "d", "a", after=after)
    assert listed(C.fct_drop(data.where("i > 2"), "c", ta)) == C.fct_drop(data.where("i > 2"), "c", a)
    assert listed(C.fct_expand(ta, "z", "a", "y")) == C.fct_expand(a, "z", "a", "y")
    assert listed(C.lvls_union(["q", "a"], ta)) == C.lvls_union(["q", "a"], a)
    assert sorted(listed(C.fct_shuffle(ta, 3))) == sorted(a)
    want = rows(C.level_number(data, "c", a))
    assert rows(C.level_number(data, "c", ta)) == want and (2, None, None) in want


def test_more_levels_than_columns(spark, small_limit):
    n = X.MAX_LEVELS + 50
    d = spark.range(n).select("id", F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"))
    out = C.as_factor(d, "c", "id")
    assert out.where("c_level <> id + 1").count() == 0 and out.count() == n
    assert C.level_number(d, "c", C.fct_rev(C.table_sorted(d, "c"))).where(f"c_level <> {n} - id").count() == 0
    long = X.tabyl_long(d.withColumn("g", F.col("id") % 2), "g", "c", share="row")
    assert long.count() == n and long.agg(F.round(F.sum("share"), 6)).first()[0] == 2.0
    wide = R.spread_map(d.withColumn("g", F.col("id") % 2), "c", "id").collect()
    assert sorted((r.g, len(r.cells)) for r in wide) == [(0, n // 2), (1, n // 2)] and wide[0].cells


def test_long_tables_equal_wide_ones(spark):
    d = spark.createDataFrame([("x", "p"), ("x", "q"), ("x", "q"), ("y", None), (None, "p")], "a string, b string")
    assert rows(X.tabyl_long(d, "a", "b")) == sorted([("x", "p", 1), ("x", "q", 2), ("y", None, 1), (None, "p", 1)], key=repr)
    assert rows(X.tabyl_long(d, "a", "b", show_na=False, share="all")) == [("x", "p", 1, 1 / 3), ("x", "q", 2, 2 / 3)]
    assert rows(X.tabyl_long(d.withColumn("c", F.lit(1)), "a", "b", "c", share="col").where("b = 'p'")) == sorted([(1, "x", "p", 1, .5), (1, None, "p", 1, .5)], key=repr)
    with pytest.raises(Exception, match="duplicate rows"):
        R.spread_map(spark.createDataFrame([(1, "a", 1), (1, "a", 2)], "k int, n string, v int"), "n", "v").collect()
    cast = R.dcast_map(d.withColumn("v", F.lit(2)), ["a"], "b", "v", F.sum).where("a = 'x'").first()
    assert cast.cells == {"p": 2, "q": 4}
