"""Split groups must give what one plain window gives."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortspark.operators import joins as J
from cohortspark.operators import ordered as O
from cohortspark.operators import reshape as R
from cohortspark.operators import apply as P
from cohortspark.session import HOT_ROWS_CONF
from conftest import rows


@pytest.fixture(scope="module")
def data(spark):
    """One group holds a third of the rows; values have ties, NA and NaN."""
    df = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("k"),
        (F.xxhash64("id") % 50).alias("h"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.abs(F.xxhash64("id", F.lit(1)) % 900)).alias("ts"))
    v = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("h").cast("double"))
    return df.withColumn("v", v).withColumn("x", F.when(F.col("id") % 7 != 0, F.col("h"))).withColumn("s", F.concat(F.lit("s"), F.col("h"))).cache()


ORDER = ["-ts", "s", "id"]
OPS = {
    "row_number": lambda d: O.row_number(d, "r", ORDER, ["k"]),
    "row_number_nan": lambda d: O.row_number(d, "r", ["-v", "id"], ["k"]),
    "row_number_all": lambda d: O.row_number(d, "r", ["s", "-id"]),
    "ntile": lambda d: O.ntile(d, "r", 7, ["x", "id"], ["k"]),
    "ntile_all": lambda d: O.ntile(d, "r", 11, ["x", "id"]),
    "ranks": lambda d: O.ranks(d, "x", ["k"], min_rank="a", dense_rank="b", avg_rank="c", max_rank="m", percent_rank="p", cume_dist="q"),
    "ranks_all": lambda d: O.ranks(d, "s", desc=True, min_rank="a", dense_rank="b", avg_rank="c", percent_rank="p", cume_dist="q"),
    "cumsum": lambda d: O.cumulate(d, "h", "sum", "r", ORDER, ["k"]),
    "cumsum_na": lambda d: O.cumulate(d.withColumn("y", F.when(F.col("id") != 2400, F.col("h"))), "y", "sum", "r", ["id"], ["k"]),
    "cummin": lambda d: O.cumulate(d, "h", "min", "r", ORDER, ["k"]),
    "cummax": lambda d: O.cumulate(d, "h", "max", "r", ORDER, ["k"]),
    "cumall": lambda d: O.cumulate(d.withColumn("y", F.col("id") < 2000), "y", "all", "r", ["id"], ["k"]),
    "cumany": lambda d: O.cumulate(d.withColumn("y", F.col("id") > 2000), "y", "any", "r", ["id"], ["k"]),
    "lag": lambda d: O.lag(d, "x", "r", ORDER, ["k"], 3),
    "lag_far": lambda d: O.lag(d, "s", "r", ORDER, ["k"], 150, "none"),
    "lead": lambda d: O.lead(d, "x", "r", ORDER, ["k"], 2, -1),
    "lead_far": lambda d: O.lead(d, "s", "r", ORDER, ["k"], 130),
    "diff": lambda d: O.diff(d, "h", "r", ORDER, ["k"]),
    "fill": lambda d: O.fill(d.withColumn("y", F.when(F.col("id") % 400 == 3, F.col("id"))), ["y"], ["id"], ["k"]),
    "fill_up": lambda d: O.fill(d.withColumn("y", F.when(F.col("id") % 400 == 3, F.col("id"))), ["y", "x"], ["id"], ["k"], "up"),
    "fill_both": lambda d: O.fill(d, ["x"], ORDER, ["k"], "downup"),
    "moving": lambda d: O.moving(d, {"r": F.sum("h"), "n": F.count(F.lit(1))}, -5, 0, ORDER, ["k"]),
    "moving_around": lambda d: O.moving(d, {"r": F.max("h")}, -60, 75, ORDER, ["k"]),
    "quantiles": lambda d: O.quantiles(d, "x", {"a": 0.0, "m": 0.5, "p": 0.9, "z": 1.0}, ["k"]),
    "quantiles_all": lambda d: O.quantiles(d, "x", {"m": 0.37}),
    "which": lambda d: O.which(d, "x", "r", ORDER, ["k"], True),
    "nest_chunks": lambda d: R.nest(d.select("k", "id"), ["k"], "c", ["id"], rows_per_cell=30),
}


@pytest.mark.parametrize("name", list(OPS))
def test_split_equals_plain(spark, data, name):
    plain = rows(OPS[name](data))
    spark.conf.set(HOT_ROWS_CONF, "40")
    try:
        split = rows(OPS[name](data))
    finally:
        spark.conf.unset(HOT_ROWS_CONF)
    assert len(plain) == len(split) and repr(plain) == repr(split)


def test_hot_group_is_cut_and_balanced(spark, data, small_limit):
    lay = O.layout(data, ["k"], ["id"])
    assert lay.hot
    sizes = [r["count"] for r in lay.split_rows().where("k = 'hot'").groupBy(O.PIECE).count().collect()]
    assert sum(sizes) == 1000 and len(sizes) > 10 and max(sizes) < 200


def test_small_groups_get_a_plain_window(spark, data):
    lay = O.layout(data, ["k"], ["id"])
    assert not lay.hot
    plan = lay.df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_plain_matches_spark_windows(spark, data, small_limit):
    w = W.partitionBy("k").orderBy(F.desc("ts"), "s", "id")
    got = O.lag(O.row_number(data, "r", ORDER, ["k"]), "x", "l", ORDER, ["k"]).select("id", "r", "l")
    want = data.select("id", F.row_number().over(w).cast("bigint").alias("r"), F.lag("x").over(w).alias("l"))
    assert rows(got) == rows(want)


def test_nearest_and_asof_split(spark, data):
    x = data.where("id % 2 = 0").select("id", "k", "h")
    y = data.where("id % 2 = 1").select("k", F.col("h").alias("yh"), F.col("id").alias("yid"))
    run = lambda: (rows(J.nearest_join(x, y, ["k"], "h", y_on="yh", order=["yid"])), rows(J.asof_last(x, y.groupBy("k", "yh").agg(F.min("yid").alias("yid")), ["k"], "h", "yh")))
    plain = run()
    spark.conf.set(HOT_ROWS_CONF, "40")
    split = run()
    spark.conf.unset(HOT_ROWS_CONF)
    assert plain == split
    best = {}
    for k, yh, yid in [tuple(r) for r in y.collect()]:
        best.setdefault(k, []).append((yh, yid))
    for i, k, h, yh, yid in plain[0]:
        want = min(best[k], key=lambda p: (abs(p[0] - h), p[0], p[1])) if k in best else (None, None)
        assert (yh, yid) == want


def test_order_is_required(spark, data):
    with pytest.raises(ValueError):
        O.row_number(data, "r", [], ["k"])


def test_nest_refuses_a_group_that_is_too_large(spark, data, small_limit):
    with pytest.raises(ValueError, match="rows_per_cell"):
        R.nest(data, ["k"])


def test_group_apply_combines_chunks(spark, data, small_limit):
    import pandas as pd
    schema = "k string, n bigint, top double"
    part = lambda p: pd.DataFrame({"k": [p.k.iloc[0]], "n": [len(p)], "top": [p.h.max()]})
    merge = lambda p: pd.DataFrame({"k": [p.k.iloc[0]], "n": [p.n.sum()], "top": [p.top.max()]})
    got = P.group_apply(data.select("id", "k", "h"), ["k"], part, schema, merge)
    want = data.groupBy("k").agg(F.count(F.lit(1)), F.max("h").cast("double"))
    assert rows(got) == rows(want)
    with pytest.raises(ValueError, match="combine"):
        P.group_apply(data, ["k"], part, schema)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "k string, v int, id int")
    assert O.row_number(empty, "r", ["id"], ["k"]).count() == 0
    assert O.quantiles(empty, "v", {"m": 0.5}, ["k"]).count() == 0


def test_several_windows_on_one_layout(spark, data):
    run = lambda: rows(O.windows(data.select("id", "k", "x"), ["id"], ["k"], n=O.w_row_number(), prev=O.w_lag("x"), nxt=O.w_lead("x", 2),
                                 total=O.w_cum("id", "sum"), known=O.w_fill("x")))
    plain = run()
    spark.conf.set(HOT_ROWS_CONF, "40")
    split = run()
    spark.conf.unset(HOT_ROWS_CONF)
    assert plain == split


@pytest.mark.parametrize("start, end", [(-5, 0), (-60, 75), (3, 7), (-9, -2), (-1000, 1000), (0, 0), (500, 600)])
def test_moving_frames_equal_plain_windows(spark, data, start, end):
    from pyspark.sql import Window

    frames = {"total": ("sum", "h"), "n": ("count", "x"), "low": ("min", "h"), "high": ("max", "x"), "m": ("mean", "h")}
    w = Window.partitionBy("k").orderBy(*O.sort_columns(data, ORDER)).rowsBetween(start, end)
    d = data.withColumn("h", F.col("h").cast("bigint"))
    fn = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "mean": F.avg}
    want = repr(rows(d.withColumns({n: fn[kind](c).over(w) for n, (kind, c) in frames.items()}).drop("x")))  # NaN equals itself
    for limit in (None, "40"):
        if limit:
            spark.conf.set(HOT_ROWS_CONF, limit)
        try:
            assert repr(rows(O.moving_frames(d, frames, start, end, ORDER, ["k"]).drop("x"))) == want
        finally:
            spark.conf.unset(HOT_ROWS_CONF)


def test_moving_copies_no_more_than_the_reach(spark, small_limit):
    from pyspark.sql import Window

    d = spark.range(600).select(F.lit("g").alias("k"), "id")
    got = O.moving(d, {"n": F.count(F.lit(1)), "s": F.sum("id")}, -150, 90, ["id"], ["k"])
    w = Window.partitionBy("k").orderBy("id").rowsBetween(-150, 90)
    assert rows(got) == rows(d.withColumns({"n": F.count(F.lit(1)).over(w), "s": F.sum("id").over(w)}))


def test_moving_frames_without_groups_and_empty(spark):
    d = spark.range(10).select("id")
    got = O.moving_frames(d, {"s": ("sum", "id")}, -3, 0, ["id"])
    assert rows(got) == [(i, sum(range(max(0, i - 3), i + 1))) for i in range(10)]
    assert O.moving_frames(d.limit(0), {"s": ("sum", "id")}, -3, 0, ["id"]).count() == 0
    with pytest.raises(ValueError):
        O.moving_frames(d, {"s": ("sum", "id")}, 2, 1, ["id"])


def test_window_function_with_carried_state(spark, data):
    import pandas as pd

    d = data.select("id", "k", "h").withColumn("h", F.col("h").cast("double"))

    def smooth(p, state=None):
        """Exponential smoothing: half of the value before, half of the own."""
        out, last = [], state[1] if state else 0.0
        for v in p["h"]:
            last = last / 2 + v / 2
            out.append(last)
        return pd.Series(out)

    carry = P.Carry(lambda p: (.5 ** len(p), smooth(p).iloc[-1]), lambda a, b: (a[0] * b[0], a[1] * b[0] + b[1]))
    run = lambda: {r.id: r.s for r in P.window_apply(d, ["k"], ["id"], smooth, "s", "double", carry=carry).collect()}
    plain = run()
    whole = {r.id: r.s for r in P.window_apply(d, ["k"], ["id"], smooth, "s", "double").collect()}
    spark.conf.set(HOT_ROWS_CONF, "40")
    try:
        split = run()
        with pytest.raises(ValueError):
            P.window_apply(d, ["k"], ["id"], smooth, "s", "double")
    finally:
        spark.conf.unset(HOT_ROWS_CONF)
    assert plain == whole and split == pytest.approx(whole)
    assert P.window_apply(d.limit(0), ["k"], ["id"], smooth, "s", "double", carry=carry).count() == 0
