"""Queries: dates, times, spans, school years."""

from pyspark.sql import functions as F

from cohortspark.functions import dates as D
from cohortspark.plans.registry import query


def day(c):
    return F.date_format(c, "yyyy-MM-dd")


def clock(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


_SQL_DAY = "strftime({0}, '%Y-%m-%d')"
_SQL_CLOCK = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def sd(x):
    return _SQL_DAY.format(x)


def sc(x):
    return _SQL_CLOCK.format(x)


@query("parse_date_orders", f"SELECT o_orderkey, {sd('o_orderdate')} AS a, {sd('o_orderdate')} AS b, {sd('o_orderdate')} AS c, {sd('o_orderdate')} AS d, {sd('o_orderdate')} AS e FROM orders")
def parse_date_orders(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", day(D.ymd(F.date_format(d, "yyyyMMdd"))).alias("a"), day(D.mdy(F.date_format(d, "MMMM d, yyyy"))).alias("b"),
                           day(D.dmy(F.date_format(d, "dd/MM/yyyy"))).alias("c"), day(D.ydm(F.date_format(d, "yyyy.dd.MM"))).alias("d"), day(D.dym(F.date_format(d, "dd-yy-MMM"))).alias("e"))


@query("parse_date_times", f"SELECT event_id, {sc('ts')} AS a, {sc('ts - INTERVAL 9 HOUR')} AS b, strftime(ts, '%Y-%m-%d %H:%M') AS c FROM events")
def parse_date_times(t):
    text = F.date_format("ts", "yyyy/MM/dd HH:mm:ss")
    return t.events.select("event_id", clock(D.ymd_hms(text)).alias("a"), clock(D.ymd_hms(text, "Asia/Tokyo")).alias("b"),
                           F.date_format(D.mdy_hm(F.date_format("ts", "MM-dd-yyyy HH:mm")), "yyyy-MM-dd HH:mm").alias("c"))


@query("parse_mixed_orders", f"SELECT o_orderkey, {sd('o_orderdate')} AS d FROM orders")
def parse_mixed_orders(t):
    d = F.col("o_orderdate")
    text = F.when(F.col("o_orderstatus") == "F", F.date_format(d, "yyyy-MM-dd")).when(F.col("o_orderstatus") == "O", F.date_format(d, "MMM dd, yyyy")).otherwise(
        F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
    return t.orders.select("o_orderkey", day(D.parse_date_time(text, ["ymd", "mdy", "ymd HMS"])).alias("d"))


@query("guess_date_order", "SELECT 'ymd' AS \"order\", COUNT(*) AS n FROM orders UNION ALL SELECT 'mdy', 0 UNION ALL SELECT 'ymd HMS', 0")
def guess_date_order(t):
    text = t.orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("x"))
    return D.guess_formats(text, "x", ["ymd", "mdy", "ymd HMS"])


@query("parse_with_format", f"SELECT o_orderkey, {sd('o_orderdate')} AS a, {sd('o_orderdate')} AS b, {sc('o_orderdate - INTERVAL 9 HOUR')} AS c FROM orders")
def parse_with_format(t):
    d = F.col("o_orderdate")
    french = F.concat(F.dayofmonth(d).cast("string"), F.lit(" "), F.element_at(F.array(*[F.lit(m) for m in D.MONTH_NAMES["fr"]]), F.month(d)), F.lit(" "), F.year(d).cast("string"))
    return t.orders.select("o_orderkey", day(D.parse_date(F.date_format(d, "dd 'of' MMMM yyyy"), "%d of %B %Y")).alias("a"), day(D.parse_date(french, "%e %B %Y", "fr")).alias("b"),
                           clock(D.parse_datetime(F.date_format(d, "yyyy-MM-dd HH:mm:ss"), "%Y-%m-%d %H:%M:%S", tz="Asia/Tokyo")).alias("c"))


@query("time_of_day", """SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS s, strftime(ts, '%H:%M:%S') AS txt, CAST(hour(ts) * 3600 + minute(ts) * 60 AS BIGINT) AS half, strftime(ts, '%H:%M:%S') AS typed FROM events""")
def time_of_day(t):
    s = D.hms_seconds(F.date_format("ts", "HH:mm:ss"))
    return t.events.select("event_id", s.cast("bigint").alias("s"), D.hms_text(s).alias("txt"), D.hms_seconds(F.date_format("ts", "hh:mm a")).cast("bigint").alias("half"),
                           D.parse_hms(F.date_format("ts", "HH:mm:ss")).cast("string").alias("typed"))


@query("round_time_of_day", """SELECT event_id, CAST(round_even(s / 900.0, 0) * 900 AS BIGINT) AS r, CAST(FLOOR(s / 900.0) * 900 AS BIGINT) AS f FROM (SELECT event_id, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS s FROM events)""")
def round_time_of_day(t):
    s = D.hms_seconds(F.date_format("ts", "HH:mm:ss"))
    return t.events.select("event_id", D.round_hms(s, 900).cast("bigint").alias("r"), D.trunc_hms(s, 900).cast("bigint").alias("f"))


@query("make_dates", f"""SELECT p_partkey, CASE WHEN d <= 28 THEN printf('2023-02-%02d', d) END AS a, printf('%04d-03-%02d 10:20:30', 1970 + p_size, CASE WHEN d > 30 THEN 1 ELSE d END) AS b
FROM (SELECT p_partkey, p_size, p_size % 31 + 1 AS d FROM part)""")
def make_dates(t):
    base = t.part.select("p_partkey", (F.col("p_size") + 1970).alias("y"), (F.col("p_size") % 31 + 1).alias("d"))
    return base.select("p_partkey", day(D.make_date(F.lit(2023), F.lit(2), "d")).alias("a"),
                       clock(D.make_datetime("y", F.lit(3), F.when(F.col("d") > 30, 1).otherwise(F.col("d")), 10, 20, 30)).alias("b"))


@query("date_parts", f"""SELECT event_id, year(ts) AS y, month(ts) AS mo, day(ts) AS d, hour(ts) AS h, minute(ts) AS mi, second(ts) AS s, {sd('ts')} AS dt FROM events""")
def date_parts(t):
    return t.events.select("event_id", *[f("ts").cast("bigint").alias(n) for f, n in ((D.year, "y"), (D.month, "mo"), (D.mday, "d"), (D.hour, "h"), (D.minute, "mi"), (D.second, "s"))],
                           day(D.date("ts")).alias("dt"))


@query("week_and_labels", """SELECT o_orderkey, dayofweek(o_orderdate) + 1 AS wday, strftime(o_orderdate, '%a') AS wlab, dayofyear(o_orderdate) AS yday, CAST(CEIL(dayofyear(o_orderdate) / 7.0) AS BIGINT) AS week,
weekofyear(o_orderdate) AS iso, strftime(o_orderdate, '%b') AS mlab FROM orders""")
def week_and_labels(t):
    d = "o_orderdate"
    return t.orders.select("o_orderkey", D.wday(d).cast("bigint").alias("wday"), D.wday(d, True).alias("wlab"), D.yday(d).cast("bigint").alias("yday"), D.week(d).cast("bigint").alias("week"),
                           D.isoweek(d).cast("bigint").alias("iso"), D.month_label(d).alias("mlab"))


@query("quarters", """SELECT o_orderkey, quarter(o_orderdate) AS q, quarter(o_orderdate + INTERVAL 6 MONTH) AS fq, CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END::BIGINT AS sem,
ROUND(year(o_orderdate + INTERVAL 6 MONTH) + quarter(o_orderdate + INTERVAL 6 MONTH) / 10.0, 1) AS yq FROM orders""")
def quarters(t):
    d = "o_orderdate"
    return t.orders.select("o_orderkey", D.quarter(d).cast("bigint").alias("q"), D.quarter(d, 7).cast("bigint").alias("fq"), D.semester(d).cast("bigint").alias("sem"), F.round(D.quarter(d, 7, True), 1).alias("yq"))


@query("date_flags", """SELECT o_orderkey, hour(ts) < 12 AS am, hour(ts) >= 12 AS pm, year(ts) % 4 = 0 AS leap, day(last_day(ts))::BIGINT AS days,
local >= april + CAST((7 - dayofweek(april)) % 7 AS INT) AND local < october - CAST(dayofweek(october) AS INT) AS dst
FROM (SELECT *, CAST(ts AS DATE) - 1 AS local, make_date(year(CAST(ts AS DATE) - 1), 4, 1) AS april, make_date(year(CAST(ts AS DATE) - 1), 10, 31) AS october
FROM (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS ts FROM orders))""")
def date_flags(t):
    return t.orders.select("o_orderkey", D.am("o_orderdate").alias("am"), D.pm("o_orderdate").alias("pm"), D.leap_year("o_orderdate").alias("leap"),
                           D.days_in_month("o_orderdate").cast("bigint").alias("days"), D.dst(F.col("o_orderdate").cast("timestamp"), "America/Chicago").alias("dst"))


@query("daylight_saving", """SELECT o_orderkey, epoch(timezone('America/Chicago', timezone('UTC', o_orderdate))) - epoch(o_orderdate) = -18000 AS dst FROM orders""")
def daylight_saving(t):
    return t.orders.select("o_orderkey", D.dst(F.col("o_orderdate").cast("timestamp"), "America/Chicago").alias("dst"))


@query("update_date_parts", f"SELECT event_id, strftime(ts, '%Y-%m-15 00:%M:%S') AS x FROM events")
def update_date_parts(t):
    return t.events.select("event_id", clock(D.update_parts("ts", day=15, hour=0)).alias("x"))


@query("floor_dates", f"""SELECT event_id, {sc("date_trunc('hour', ts)")} AS h, {sc("time_bucket(INTERVAL 15 MINUTE, ts)")} AS q15, {sc("date_trunc('week', ts + INTERVAL 1 DAY) - INTERVAL 1 DAY")} AS w,
{sc("date_trunc('month', ts)")} AS m FROM events""")
def floor_dates(t):
    return t.events.select("event_id", clock(D.floor_date("ts", "hour")).alias("h"), clock(D.floor_date("ts", "minute", 15)).alias("q15"), clock(D.floor_date("ts", "week")).alias("w"),
                           clock(D.floor_date("ts", "month")).alias("m"))


@query("ceiling_round_dates", f"""SELECT o_orderkey, {sd("CASE WHEN date_trunc('month', o_orderdate) = o_orderdate THEN o_orderdate ELSE date_trunc('month', o_orderdate) + INTERVAL 1 MONTH END")} AS up,
{sd("CASE WHEN epoch(o_orderdate) - epoch(date_trunc('month', o_orderdate)) < epoch(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH) - epoch(o_orderdate) THEN date_trunc('month', o_orderdate) ELSE date_trunc('month', o_orderdate) + INTERVAL 1 MONTH END")} AS near,
{sd("make_date(year(o_orderdate), (month(o_orderdate) - 1) // 2 * 2 + 1, 1)")} AS bimonth FROM orders""")
def ceiling_round_dates(t):
    d = "o_orderdate"
    return t.orders.select("o_orderkey", day(D.ceiling_date(d, "month")).alias("up"), day(D.round_date(d, "month")).alias("near"), day(D.floor_date(d, "month", 2)).alias("bimonth"))


@query("rollback_dates", f"SELECT o_orderkey, {sd('last_day(o_orderdate - INTERVAL 1 MONTH)')} AS prev, {sd(chr(100) + 'ate_trunc(' + chr(39) + 'month' + chr(39) + ', o_orderdate)')} AS first FROM orders")
def rollback_dates(t):
    return t.orders.select("o_orderkey", day(D.rollback("o_orderdate")).alias("prev"), day(D.rollback("o_orderdate", True)).alias("first"))


@query("month_arithmetic", f"""SELECT o_orderkey, {sd('o_orderdate + INTERVAL 1 MONTH')} AS clamped, CASE WHEN day(o_orderdate + INTERVAL 1 MONTH) = day(o_orderdate) THEN {sd('o_orderdate + INTERVAL 1 MONTH + INTERVAL 3 DAY')} END AS period,
{sc('o_orderdate + INTERVAL 525600 MINUTE + INTERVAL 90 SECOND')} AS duration FROM orders""")
def month_arithmetic(t):
    d = "o_orderdate"
    return t.orders.select("o_orderkey", day(D.add_months_clamped(d, 1)).alias("clamped"), day(D.add_period(d, months=1, days=3)).alias("period"),
                           clock(D.add_duration(d, years=1, seconds=90)).alias("duration"))


@query("interval_tests", """SELECT o_orderkey, o_orderdate <= TIMESTAMP '1998-12-31' AND o_orderdate + INTERVAL 60 DAY >= TIMESTAMP '1998-01-01' AS meets, o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31' AS inside FROM orders""")
def interval_tests(t):
    ts = lambda x: F.lit(x).cast("timestamp")
    mine = D.interval(F.col("o_orderdate").cast("timestamp"), D.add_duration("o_orderdate", days=60))
    year98 = D.interval(ts("1998-01-01"), ts("1998-12-31"))
    return t.orders.select("o_orderkey", D.int_overlaps(mine, year98).alias("meets"), D.within(F.col("o_orderdate").cast("timestamp"), year98).alias("inside"))


@query("interval_lengths", """SELECT o_orderkey, CAST(datediff('day', o_orderdate, DATE '2002-01-01') AS DOUBLE) AS days, ROUND(datediff('day', o_orderdate, DATE '2002-01-01') / 7.0, 6) AS weeks,
datesub('month', o_orderdate, TIMESTAMP '2002-01-01') AS months FROM orders""")
def interval_lengths(t):
    iv = D.interval(F.to_date("o_orderdate"), F.lit("2002-01-01").cast("date"))
    return t.orders.select("o_orderkey", D.int_length(iv, "day").alias("days"), F.round(D.int_length(iv, "week"), 6).alias("weeks"), D.int_div_months(iv).cast("bigint").alias("months"))


@query("interval_as_period", """SELECT o_orderkey, printf('%dy %dm %dd', m // 12, m % 12, datediff('day', CAST(o_orderdate + to_months(CAST(m AS INT)) AS DATE), DATE '2002-01-01')) AS p FROM
(SELECT o_orderkey, o_orderdate, datesub('month', o_orderdate, TIMESTAMP '2002-01-01') AS m FROM orders)""")
def interval_as_period(t):
    iv = D.interval(F.to_date("o_orderdate"), F.lit("2002-01-01").cast("date"))
    return t.orders.select("o_orderkey", D.as_period_text(iv).alias("p"))


@query("decimal_dates", f"""SELECT o_orderkey, ROUND(year(o_orderdate) + (dayofyear(o_orderdate) - 1) / CASE WHEN year(o_orderdate) % 4 = 0 THEN 366.0 ELSE 365.0 END, 6) AS dec, {sd('o_orderdate')} AS back FROM orders""")
def decimal_dates(t):
    dec = D.decimal_date("o_orderdate")
    return t.orders.select("o_orderkey", F.round(dec, 6).alias("dec"), day(D.date_decimal(dec)).alias("back"))


@query("time_zones", f"SELECT event_id, {sc(chr(116) + 's + INTERVAL 9 HOUR')} AS tokyo, {sc('ts - INTERVAL 9 HOUR')} AS forced, (hour(ts + INTERVAL 9 HOUR) * 3600 + minute(ts) * 60 + second(ts))::BIGINT AS sec FROM events")
def time_zones(t):
    tz = "Asia/Tokyo"
    return t.events.select("event_id", clock(D.with_tz("ts", tz)).alias("tokyo"), clock(D.force_tz("ts", tz)).alias("forced"), D.local_time("ts", tz).cast("bigint").alias("sec"))


@query("serial_dates", f"""SELECT c_custkey, {sd('DATE ' + chr(39) + '1899-12-30' + chr(39) + ' + CAST(FLOOR(40000 + c_acctbal) AS INT)')} AS a, {sd('DATE ' + chr(39) + '1904-01-01' + chr(39) + ' + CAST(FLOOR(40000 + c_acctbal) AS INT)')} AS b,
{sd('DATE ' + chr(39) + '1970-01-01' + chr(39) + ' + CAST(c_custkey AS INT)')} AS c FROM customer""")
def serial_dates(t):
    n = F.col("c_acctbal") + 40000
    return t.customer.select("c_custkey", day(D.excel_numeric_to_date(n)).alias("a"), day(D.excel_numeric_to_date(n, "mac pre-2011")).alias("b"), day(D.as_date("c_custkey")).alias("c"))


@query("serial_date_times", f"SELECT event_id, {sc('ts')} AS back FROM events")
def serial_date_times(t):
    serial = (F.unix_timestamp("ts") - F.unix_timestamp(F.lit("1899-12-30").cast("timestamp"))) / 86400
    return t.events.select("event_id", clock(D.excel_numeric_to_date(serial, include_time=True)).alias("back"))


@query("stamped_dates", "SELECT event_id, strftime(ts, '%d %B %Y at %H:%M') AS x FROM events")
def stamped_dates(t):
    return t.events.select("event_id", D.stamp("ts", "01 March 1999 at 12:30").alias("x"))


@query("current_times")
def current_times(t):
    return t.orders.agg(F.max("o_orderdate").alias("last")).select((D.today() > F.to_date("last")).alias("later"), (D.now() > F.col("last")).alias("later_still"))


@query("academic_years", """SELECT o_orderkey, y AS first, y || '-' || (y + 1) AS label, (y - 1980) * 100 AS term FROM (SELECT o_orderkey, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS y FROM orders)""")
def academic_years(t):
    d = "o_orderdate"
    first = D.academic_year(d).cast("bigint")
    return t.orders.select("o_orderkey", first.alias("first"), D.academic_year(d, style="label").alias("label"), D.term_id(first, 1980, 100).alias("term"))


@query("seasons", """SELECT o_orderkey, s, CASE s WHEN 'Fall' THEN 1 WHEN 'Winter' THEN 2 ELSE 3 END::BIGINT AS n FROM (SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (7, 8, 9, 10) THEN 'Fall' WHEN month(o_orderdate) IN (11, 12, 1, 2) THEN 'Winter' ELSE 'Spring' END AS s FROM orders)""")
def seasons(t):
    m = F.month("o_orderdate")
    text = F.when(m.between(7, 10), "term: AUTUMN 1").when(m.isin(11, 12, 1, 2), "winter term").otherwise("spring")
    s = D.season_fix(text)
    return t.orders.select("o_orderkey", s.alias("s"), D.season_number(s).cast("bigint").alias("n"))
