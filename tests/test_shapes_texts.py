"""Reshaping and functions on small worked inputs."""

import datetime as dt
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from cohortspark.functions import arrays as A
from cohortspark.functions import dates as D
from cohortspark.functions import jsons as Z
from cohortspark.functions import numbers as M
from cohortspark.functions import strings as S
from cohortspark.operators import factors as C
from cohortspark.operators import reshape as R
from conftest import rows


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def col_of(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[1] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_race_gather_orders_number_keys(spark):
    d = spark.createDataFrame([("A", 1.0, 2.0), ("B", 3.0, None)], "Name string, `50` double, `100` double")
    long = R.gather(d, "Time", "Score", ["-Name"], na_rm=True, convert=True)
    assert dict(long.dtypes)["Time"] == "int"
    assert rows(long) == [("A", 100, 2.0), ("A", 50, 1.0), ("B", 50, 3.0)]
    assert rows(R.melt(d, ["Name"])) == [("A", "100", 2.0), ("A", "50", 1.0), ("B", "100", None), ("B", "50", 3.0)]


def test_spread_refuses_two_rows_for_a_cell(spark):
    d = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "y", 3)], "i string, k string, v int")
    with pytest.raises(Exception, match="duplicate rows"):
        R.spread(d, "k", "v").collect()
    wide = R.spread(d.where("v <> 2"), "k", "v", fill=0)
    assert rows(wide) == [("a", 1, 0), ("b", 0, 3)]


def test_activities_gather_separate_spread(spark):
    d = spark.createDataFrame([(1, "t", 0.1, 0.2, 0.3, 0.4)], "id int, trt string, `work.T1` double, `talk.T1` double, `work.T2` double, `talk.T2` double")
    long = R.separate(R.gather(d, "key", "time", ["-id", "-trt"]), "key", ["location", "time_of"], r"\.")
    wide = R.spread(long, "location", "time")
    assert rows(wide) == [(1, "t", "T1", 0.2, 0.1), (1, "t", "T2", 0.4, 0.3)]


def test_separate_pieces_and_positions(spark):
    d = spark.createDataFrame([("a-b-c",), ("a",), (None,)], "x string")
    assert rows(R.separate(d, "x", ["p", "q"], "-")) == sorted([("a", "b-c"), ("a", None), (None, None)], key=repr)
    m = spark.createDataFrame([("m04",), ("f1524",)], "x string")
    assert rows(R.separate(m, "x", ["sex", "age"], [1])) == [("f", "1524"), ("m", "04")]
    assert rows(R.separate(m, "x", ["sex", "age"], [-2])) == [("f15", "24"), ("m", "04")]


def test_unite_extract_parse_number(spark):
    d = spark.createDataFrame([("a", None)], "x string, y string")
    assert rows(R.unite(d, "z", ["x", "y"])) == [("a_NA",)]
    assert rows(R.extract(spark.createDataFrame([("a-1",), ("b",)], "x string"), "x", ["l", "n"], r"([a-z])-(\d)")) == [("a", "1"), (None, None)]
    assert col_of(spark, ["$1,234.5", "20%", "wk 7", "none", "-3"], R.parse_number) == [1234.5, 20.0, 7.0, None, -3.0]
    assert col_of(spark, ["1.234,5 EUR"], lambda c: R.parse_number(c, ".", ",")) == [1234.5]


def test_complete_full_seq_uncount(spark):
    d = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "g int, i string, v int")
    assert rows(R.complete(d, "g", "i", fill={"v": 0})) == [(1, "a", 5), (1, "b", 0), (2, "a", 0), (2, "b", 6)]
    assert [r[0] for r in rows(R.full_seq(spark.createDataFrame([(1.0,), (2.0,)], "x double"), "x", 0.25))] == [1.0, 1.25, 1.5, 1.75, 2.0]
    assert rows(R.uncount(d, "g").select("i")) == [("a",), ("b",), ("b",)]


def test_nest_and_unnest(spark):
    d = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "g string, x int")
    nested = R.nest(d, ["g"], "data", ["x"])
    assert [[r.x for r in row.data] for row in nested.orderBy("g").collect()] == [[1, 2], [3]]
    assert rows(R.unnest(nested, "data")) == rows(d)
    assert rows(R.flatten_text(d, ["g"], "x", "+")) == [("a", "1+2"), ("b", "3")]


def test_row_to_names_and_remove_empty(spark):
    d = spark.createDataFrame([(1, None, None), (2, "ID", "Value"), (3, "1", "4"), (4, "2", "5")], "pos int, X_1 string, X_2 string")
    out = R.row_to_names(d, 2, ["pos"])
    assert out.columns == ["pos", "ID", "Value"] and rows(out) == [(3, "1", "4"), (4, "2", "5")]
    e = spark.createDataFrame([(1, None, "a"), (None, None, None), (3, None, "b")], "v1 int, v2 int, v3 string")
    assert rows(R.remove_empty(e)) == [(1, "a"), (3, "b")]


def test_clean_and_make_names():
    dirty = ["firstName", "ábc@!*", "% successful (2009)", "REPEAT VALUE", "REPEAT VALUE", ""]
    assert R.clean_name_list(dirty) == ["first_name", "abc", "percent_successful_2009", "repeat_value", "repeat_value_2", "x"]
    assert R.make_names(["a b", "1x", "% y"]) == ["a.b", "X1x", "X..y"]


def test_text_examples(spark):
    assert one(spark, S.str_sub(F.lit("abcdef"), 3, 3), S.str_sub(F.lit("abcdef"), 2, -2), S.str_sub_set(F.lit("abcdef"), 3, 3, "X")) == ("c", "bcde", "abXdef")
    assert one(spark, S.str_pad(F.lit("abc"), 10), S.str_pad(F.lit("abc"), 10, "both"), S.str_pad(F.lit("defghi"), 4)) == ("       abc", "   abc    ", "defghi")
    assert one(spark, S.str_trunc(F.lit("This is a long string"), 10), S.str_trunc(F.lit("Short"), 10)) == ("This is...", "Short")
    assert one(spark, S.str_trim(F.lit("  a   ")), S.str_trim(F.lit("  a "), "left"), S.str_squish(F.lit(" a  b\n c "))) == ("a", "a ", "a b c")
    assert one(spark, S.str_to_upper(F.lit("I like horses.")), S.str_to_title(F.lit("I like horses.")), S.str_to_lower(F.lit("I LIKE"), "tr")) == ("I LIKE HORSES.", "I Like Horses.", "ı lıke")


PHONE = r"([2-9][0-9]{2})[- .]([0-9]{3})[- .]([0-9]{4})"
STRINGS = ["apple", "219 733 8965", "329-293-8753", "Work: 579-499-7527; Home: 543.355.3679"]


def test_phone_patterns(spark):
    assert col_of(spark, STRINGS, lambda c: S.str_detect(c, PHONE)) == [False, True, True, True]
    assert col_of(spark, STRINGS, lambda c: S.str_count(c, PHONE)) == [0, 1, 1, 2]
    assert [r and tuple(r) for r in col_of(spark, STRINGS, lambda c: S.str_locate(c, PHONE))] == [None, (1, 12), (1, 12), (7, 18)]
    assert [[tuple(p) for p in r] for r in col_of(spark, STRINGS, lambda c: S.str_locate_all(c, PHONE))][3] == [(7, 18), (27, 38)]
    assert col_of(spark, STRINGS, lambda c: S.str_extract_all(c, PHONE))[3] == ["579-499-7527", "543.355.3679"]
    assert col_of(spark, STRINGS, lambda c: S.str_match(c, PHONE, 3)[2]) == [None, "733", "293", "499"]
    assert col_of(spark, STRINGS, lambda c: S.str_replace(c, PHONE, "XXX"))[3] == "Work: XXX; Home: 543.355.3679"
    assert col_of(spark, STRINGS, lambda c: S.str_replace_all(c, PHONE, r"\3$"))[3] == "Work: 7527$; Home: 3679$"


def test_split_words_glue(spark):
    assert one(spark, S.str_split(F.lit("a-b-c"), "-"), S.str_split(F.lit("a-b-c"), "-", 2), S.str_split(F.lit("abc"), "")) == (["a", "b", "c"], ["a", "b-c"], ["a", "b", "c"])
    assert one(spark, S.words_of(F.lit("This is a sentence.")), S.word(F.lit("a b c"), -1), S.word(F.lit("a b c"), 5)) == (["This", "is", "a", "sentence"], "c", None)
    d = spark.createDataFrame([("Jo", 1.256, None)], "n string, x double, z string")
    assert d.select(S.glue("{n} has {x:.1f} of {z}!")).first()[0] == "Jo has 1.3 of NA!"
    assert one(spark, S.collapse(F.array(F.lit("a"), F.lit("b"), F.lit("c")), ", ", " and "), S.collapse(F.array(F.lit("a")), ", ", " and ")) == ("a, b and c", "a")


def test_collation_and_accents(spark):
    composed, combined = "á", "á"
    assert one(spark, S.str_detect(F.lit(composed), combined, "fixed"), S.str_detect(F.lit(composed), combined, "coll")) == (False, True)
    assert one(spark, S.asciify(F.lit("Çà été Øl ß á")), S.normalize(F.lit(combined))) == ("Ca ete Ol ss a", composed)


def test_cases_and_ordinals(spark):
    x = F.lit("someText with ABCWords")
    assert one(spark, *[S.to_any_case(x, c) for c in ("snake", "small_camel", "big_camel", "all_caps", "sentence")]) == (
        "some_text_with_abc_words", "someTextWithAbcWords", "SomeTextWithAbcWords", "SOME_TEXT_WITH_ABC_WORDS", "Some text with abc words")
    assert col_of(spark, [1, 2, 3, 4, 11, 12, 13, 21, 102, 111], S.to_ordinal, "int") == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "102nd", "111th"]
    assert one(spark, S.to_ordinal(F.lit(5), "de"), S.to_ordinal(F.lit(5), "fr"), S.to_ordinal(F.lit(1), "sv")) == ("5te", "5e", "1:a")


def test_number_and_duration_text(spark):
    assert one(spark, S.fmt_pct(F.lit(0.256)), S.fmt_dollar(F.lit(-1234.5)), S.fmt_bytes(F.lit(1536)), S.fmt_pvalue(F.lit(0.0002))) == ("25.6%", "-$1,234.50", "1.5 kB", "<0.001")
    assert one(spark, S.pretty_ms(F.lit(1337000)), S.pretty_ms(F.lit(12))) == ("22m 17s", "12ms")


def test_keyed_hash_is_the_standard_one(spark):
    assert one(spark, S.hmac_sha256(F.encode(F.lit("some text"), "UTF-8"), "a key"))[0] == hmac.new(b"a key", b"some text", hashlib.sha256).hexdigest()
    long_key = "k" * 100
    assert one(spark, S.hmac_sha256(F.encode(F.lit("x"), "UTF-8"), long_key))[0] == hmac.new(long_key.encode(), b"x", hashlib.sha256).hexdigest()


def test_date_parsing(spark):
    day = dt.date(2011, 6, 4)
    assert one(spark, D.ymd(F.lit("20110604")), D.mdy(F.lit("06-04-2011")), D.dmy(F.lit("04/06/2011")), D.ymd(F.lit("2011-13-01")), D.mdy(F.lit("June 4, 2011"))) == (day, day, day, None, day)
    stamps = one(spark, D.ymd_hms(F.lit("2011-06-04 12:00:00"), "Pacific/Auckland").cast("string"), D.ymd_hm(F.lit("2011/8/10 14:05")).cast("string"))
    assert stamps == ("2011-06-04 00:00:00", "2011-08-10 14:05:00")
    assert one(spark, D.parse_date(F.lit("1 janvier 2010"), "%e %B %Y", "fr"), D.hms_seconds(F.lit("01:02 PM")), D.hms_seconds(F.lit("25:00"))) == (dt.date(2010, 1, 1), 46920, None)


def test_month_ends(spark):
    jan31 = F.lit("2013-01-31").cast("date")
    clamped = one(spark, *[D.add_months_clamped(jan31, i) for i in range(4)])
    assert [str(d) for d in clamped] == ["2013-01-31", "2013-02-28", "2013-03-31", "2013-04-30"]
    assert one(spark, D.add_period(jan31, months=1), D.add_period(jan31, months=2), D.rollback(jan31)) == (None, dt.date(2013, 3, 31), dt.date(2012, 12, 31))


def test_rounding_and_spans(spark):
    t = F.lit("2011-08-10 14:17:31").cast("timestamp")
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    assert one(spark, text(D.floor_date(t, "minute", 15)), text(D.ceiling_date(t, "hour")), text(D.round_date(t, "day")), text(D.floor_date(t, "week"))) == (
        "2011-08-10 14:15:00", "2011-08-10 15:00:00", "2011-08-11 00:00:00", "2011-08-07 00:00:00")
    a, b = F.lit("2011-01-01").cast("date"), F.lit("2012-03-10").cast("date")
    assert one(spark, D.time_length(a, b, "day"), D.int_div_months(D.interval(a, b)), D.int_mod_days(D.interval(a, b)), D.as_period_text(D.interval(a, b))) == (434.0, 14, 9, "1y 2m 9d")
    assert one(spark, D.dst(F.lit("2020-07-01 12:00").cast("timestamp"), "Europe/Paris"), D.dst(F.lit("2020-01-01 12:00").cast("timestamp"), "Europe/Paris"), D.dst(F.lit("2020-01-01").cast("timestamp"), "Pacific/Auckland")) == (True, False, True)
    assert one(spark, D.excel_numeric_to_date(F.lit(41103.01)), D.excel_numeric_to_date(F.lit(41103.01), "mac pre-2011"), text(D.excel_numeric_to_date(F.lit(41103.01), include_time=True))) == (
        dt.date(2012, 7, 13), dt.date(2016, 7, 14), "2012-07-13 00:14:24")
    assert one(spark, D.academic_year(b), D.academic_year(b, style="label"), D.season_fix(F.lit("Late FALL 2010"))) == (2011, "2011-2012", "Fall")


def test_numbers(spark):
    assert col_of(spark, [2.5, 3.5, -2.5], M.round_half_up, "double") == [3.0, 4.0, -3.0]
    assert col_of(spark, [2.5, 3.5], M.r_round, "double") == [2.0, 4.0]
    assert col_of(spark, [123456.0, 0.0123456, 0.0, None], lambda c: M.signif(c, 3), "double") == [123000.0, 0.0123, 0.0, None]
    assert col_of(spark, [-1.0, 5.0, None], lambda c: M.clamp(c, 0.0, 3.0), "double") == [0.0, 3.0, None]
    assert [round(v, 6) for v in col_of(spark, [0.0, 1.96], M.norm_cdf, "double")] == [0.5, 0.975002]
    assert [round(v, 6) for v in col_of(spark, [5.0, 10.0], M.factorial, "double")] == [120.0, 3628800.0]
    d = spark.createDataFrame([(1.0,), (2.0,), (5.0,), (None,)], "x double")
    assert [r[1] for r in rows(M.rescale(d, "x", "y"), "x")] == [None, 0.0, 0.25, 1.0]


def test_arrays(spark):
    x = F.array(*[F.lit(i) for i in (3, 1, 4, 1, 5)])
    assert one(spark, A.arr_keep(x, lambda v: v > 1), A.arr_detect(x, lambda v: v > 3), A.arr_detect_index(x, lambda v: v > 3), A.arr_head_while(x, lambda v: v < 4), A.arr_tail_while(x, lambda v: v != 4)) == (
        [3, 4, 5], 4, 3, [3, 1], [1, 5])
    assert one(spark, A.arr_accumulate(x, F.lit(0), lambda a, v: a + v, "int"), A.arr_reduce(x, 0, lambda a, v: a + v), A.arr_match(x, [1, 5]), A.unbox(x)) == ([3, 4, 8, 9, 14], 14, [None, 1, None, 1, 2], None)
    assert [tuple(p) for p in one(spark, A.arr_cross(F.array(F.lit(1), F.lit(2)), F.array(F.lit("a"))))[0]] == [(1, "a"), (2, "a")]


def test_json(spark):
    texts = ['{"a": 1}', '{"a": 1}}', "[1, 2", "1,2", "1],[2", '"x"', "", None]
    assert col_of(spark, texts, Z.json_valid) == [True, False, False, False, False, True, False, None]
    d = spark.createDataFrame([(1, (2, (3,)))], "a int, b struct<c:int,d:struct<e:int>>")
    assert Z.flatten_struct(d).columns == ["a", "b.c", "b.d.e"]


def test_categories(spark):
    d = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [("c",)] * 3 + [("d",)] + [(None,)], "f string")
    assert C.levels_infreq(d, "f") == ["a", "b", "c", "d"]
    count = lambda df: {r[0]: r[1] for r in C.fct_count(df, "f").collect()}
    assert count(C.fct_lump(d, "f", n=2)) == {"a": 5, "b": 3, "c": 3, "Other": 1, None: 1}
    assert count(C.fct_lump(d, "f", prop=0.3)) == {"a": 5, "Other": 7, None: 1}
    assert C.fct_relevel(["a", "b", "c"], "c") == ["c", "a", "b"] and C.fct_shift(["a", "b", "c"]) == ["b", "c", "a"]
    assert C.lvls_union(["a", "b"], ["b", "c"]) == ["a", "b", "c"]
    assert count(C.fct_anon(d, "f", 3)).keys() == {"1", "2", "3", "4", None}


def test_distribution_families_match_known_values(spark):
    known = [("chisq", (1,), 3.841459, 0.95), ("t", (10,), 2.228139, 0.975), ("t", (10,), -2.228139, 0.025), ("f", (1, 10), 4.964603, 0.95),
             ("gamma", (2, 1), 1.0, 0.264241), ("gamma", (2, 1), 9.0, 0.998766), ("beta", (2, 3), 0.5, 0.6875), ("binom", (10, 0.5), 3.0, 0.171875), ("binom", (10, 0.5), 10.0, 1.0),
             ("pois", (3,), 2.0, 0.42319), ("chisq", (50,), 67.504807, 0.95)]
    for family, par, x, p in known:
        assert col_of(spark, [x, None], lambda c: F.round(M.dist_cdf(c, family, *par), 5), "double") == [pytest.approx(p, abs=2e-5), None]
    for family, par in (("chisq", (4,)), ("t", (7,)), ("beta", (2, 5)), ("f", (3, 8)), ("gamma", (3, 2))):
        back = col_of(spark, [0.01, 0.5, 0.99], lambda c: M.dist_cdf(M.dist_quantile(c, family, *par), family, *par), "double")
        assert back == pytest.approx([0.01, 0.5, 0.99], abs=1e-8)
