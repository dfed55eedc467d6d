"""Dates, times, spans and school years. The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.na import bind, col

_SEP = r"[^0-9A-Za-z]*"
_PART = {"y": r"(\d{4}|\d{2})", "m": r"(\d{1,2}|[A-Za-z]{3,9}\.?)", "d": r"(\d{1,2})"}
_CUT = "\u001f"  # between the groups of a match, which hold digits and letters only
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

# Month names of further locales: fixed values.
MONTH_NAMES = {
    "fr": ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"],
    "de": ["Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"],
    "es": ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"],
}


def _month_number(text: Column) -> Column:
    at = F.instr(F.lit(_MONTHS), F.lower(F.substring(text, 1, 3)))
    return F.when(text.rlike(r"^\d"), text.try_cast("int")).when((at > 0) & (at % 3 == 1), ((at + 2) / 3).cast("int"))


def _matched(c: Column, order: str, tail: str, clock: int, fn) -> Column:
    """``fn`` of the groups of a text that fits the order, NA for others; the text is made and matched once, however often ``fn`` uses its groups."""
    rx = r"^\s*" + _SEP.join(_PART[p] for p in order) + tail
    groups = _CUT.join(f"${i + 1}" for i in range(len(order) + clock))
    # the rest after the end is taken along: $ also stands before a last line break
    split = lambda text: F.when(text.rlike(rx), F.split(F.regexp_replace(text, rx + r"[\s\S]*", groups), _CUT))
    return bind(bind(c, split), lambda g: fn({p: F.get(g, i) for i, p in enumerate(order)}, [F.get(g, len(order) + i) for i in range(clock)]))


def _date_text(part: dict[str, Column]) -> Column:
    year = part["y"].try_cast("int")
    year = F.when(F.length(part["y"]) == 4, year).when(year < 69, year + 2000).otherwise(year + 1900)
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), two(_month_number(part["m"])), F.lit("-"), two(part["d"].try_cast("int")))


def _parse(c, order: str) -> Column:
    return _matched(col(c), order, r"\s*$", 0, lambda part, _: _date_text(part).try_cast("date"))


def ymd(c) -> Column:
    return _parse(c, "ymd")


def mdy(c) -> Column:
    return _parse(c, "mdy")


def dmy(c) -> Column:
    return _parse(c, "dmy")


def ydm(c) -> Column:
    return _parse(c, "ydm")


def myd(c) -> Column:
    return _parse(c, "myd")


def dym(c) -> Column:
    return _parse(c, "dym")


def _parse_hms(c, order: str, fields: int, tz: str) -> Column:
    clock = [r"(\d{1,2})", r"(\d{1,2})", r"(\d{1,2}(?:\.\d+)?)"][:fields]
    tail = r"[^0-9A-Za-z]*[T ]?\s*" + r"[^0-9]*".join(clock) + r"\s*Z?\s*$"

    def moment(part: dict[str, Column], hms: list[Column]) -> Column:
        pad = [F.lpad(h, 2, "0") for h in hms[:2]]
        second = F.when(F.locate(".", hms[2]) == 2, F.concat(F.lit("0"), hms[2])).otherwise(
            F.lpad(hms[2], F.greatest(F.length(hms[2]), F.lit(2)), "0")) if fields == 3 else F.lit("00")
        text = F.concat(_date_text(part), F.lit(" "), F.concat_ws(":", pad[0], pad[1] if fields > 1 else F.lit("00"), second))
        return F.to_utc_timestamp(text.try_cast("timestamp"), tz)

    return _matched(col(c), order, tail, fields, moment)


def ymd_hms(c, tz: str = "UTC") -> Column:
    return _parse_hms(c, "ymd", 3, tz)


def ymd_hm(c, tz: str = "UTC") -> Column:
    return _parse_hms(c, "ymd", 2, tz)


def ymd_h(c, tz: str = "UTC") -> Column:
    return _parse_hms(c, "ymd", 1, tz)


def mdy_hms(c, tz: str = "UTC") -> Column:
    return _parse_hms(c, "mdy", 3, tz)


def mdy_hm(c, tz: str = "UTC") -> Column:
    return _parse_hms(c, "mdy", 2, tz)


def dmy_hms(c, tz: str = "UTC") -> Column:
    return _parse_hms(c, "dmy", 3, tz)


def dmy_hm(c, tz: str = "UTC") -> Column:
    return _parse_hms(c, "dmy", 2, tz)


def _order_parser(order: str):
    order = order.replace("_", "").replace(" ", "").lower()
    date, clock = order[:3], order[3:]
    return (lambda c: _parse_hms(c, date, len(clock), "UTC")) if clock else (lambda c: _parse(c, date).cast("timestamp"))


def parse_date_time(c, orders: list[str]) -> Column:
    """First order that fits, e.g. ``["ymd", "mdy", "ymd HMS"]``."""
    return F.coalesce(*[_order_parser(o)(c) for o in orders])


def guess_formats(df: DataFrame, c: str, orders: list[str]) -> DataFrame:
    """How many values each order can parse, best first."""
    counts = df.agg(*[F.count(_order_parser(o)(c)).alias(o) for o in orders])
    return counts.unpivot([], orders, "order", "n").orderBy(F.desc("n"), "order")


_CODES = {"%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%e": "d", "%B": "MMMM", "%b": "MMM", "%H": "HH", "%I": "hh",
          "%M": "mm", "%S": "ss", "%p": "a", "%T": "HH:mm:ss", "%R": "HH:mm", "%F": "yyyy-MM-dd", "%D": "MM/dd/yy",
          "%j": "DDD", "%a": "EEE", "%A": "EEEE"}


def _quoted(parts: list[tuple[str, bool]]) -> str:
    """Join pattern parts; a run of literal letters goes into one pair of quotes."""
    out, run = "", ""
    for text, literal in [*parts, ("", False)]:
        if literal and text.isalpha():
            run += text
            continue
        out += f"'{run}'" if run else ""
        run = ""
        out += text
    return out


def spark_pattern(fmt: str) -> str:
    """A percent-code format as a Spark pattern."""
    parts, i = [], 0
    while i < len(fmt):
        if fmt[i:i + 2] in _CODES:
            parts.append((_CODES[fmt[i:i + 2]], False))
            i += 2
        else:
            parts.append((fmt[i], True))
            i += 1
    return _quoted(parts)


_ENGLISH = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]


def parse_datetime(c, fmt: str, locale: str = "en", tz: str = "UTC") -> Column:
    c = col(c)
    if locale != "en":
        for name, english in zip(MONTH_NAMES[locale], _ENGLISH):
            c = F.regexp_replace(c, rf"(?iu)\b{name}\b", english)
    return F.to_utc_timestamp(F.try_to_timestamp(c, F.lit(spark_pattern(fmt))), tz)


def parse_date(c, fmt: str = "%Y-%m-%d", locale: str = "en") -> Column:
    return parse_datetime(c, fmt, locale).cast("date")


def parse_hms(c) -> Column:
    """``H:M:S`` with optional AM or PM to a TIME value."""
    return to_time(hms_seconds(c))


def hms_seconds(c) -> Column:
    """Time of day text to seconds since midnight, NA when out of range."""
    c = col(c)
    rx = r"^\s*(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?\s*([AaPp][Mm])?\s*$"
    h, m = (F.regexp_extract(c, rx, i).try_cast("int") for i in (1, 2))
    s = F.coalesce(F.regexp_extract(c, rx, 3).try_cast("int"), F.lit(0))
    half = F.lower(F.regexp_extract(c, rx, 4))
    hour = F.when(half == "", h).when(h.between(1, 12), h % 12 + F.when(half == "pm", 12).otherwise(0))
    return F.when((hour < 24) & (m < 60) & (s < 60), hour * 3600 + m * 60 + s)


def to_time(seconds) -> Column:
    """Seconds since midnight as a TIME value."""
    s = col(seconds).cast("int")
    return F.make_time(F.floor(s / 3600).cast("int"), F.floor(s / 60).cast("int") % 60, (s % 60).cast("decimal(16,6)"))


def hms_text(seconds) -> Column:
    s = col(seconds).cast("int")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("int"), F.floor(s / 60).cast("int") % 60, s % 60)


def round_hms(seconds, step: int) -> Column:
    return (F.bround(col(seconds) / step) * step).cast("int")


def trunc_hms(seconds, step: int) -> Column:
    return (F.floor(col(seconds) / step) * step).cast("int")


def make_date(y, m, d) -> Column:
    """NA on an impossible date."""
    return F.format_string("%04d-%02d-%02d", col(y), col(m), col(d)).try_cast("date")


def make_datetime(y, m, d, h=None, mi=None, s=None, tz: str = "UTC") -> Column:
    z = lambda x: F.lit(0) if x is None else (col(x) if not isinstance(x, int) else F.lit(x))
    text = F.format_string("%04d-%02d-%02d %02d:%02d:%02d", col(y), col(m), col(d), z(h), z(mi), z(s))
    return F.to_utc_timestamp(text.try_cast("timestamp"), tz)


year, month, mday, hour, minute, second = F.year, F.month, F.dayofmonth, F.hour, F.minute, F.second
yday, isoweek = F.dayofyear, F.weekofyear


def date(c) -> Column:
    return F.to_date(col(c))


def wday(c, label: bool = False) -> Column:
    """Sunday is 1."""
    return F.dayname(col(c)) if label else F.dayofweek(col(c))


def month_label(c) -> Column:
    return F.monthname(col(c))


def week(c) -> Column:
    """Complete seven-day periods since January 1st, plus one."""
    return F.ceil(F.dayofyear(col(c)) / 7).cast("int")


def quarter(c, fiscal_start: int = 1, with_year: bool = False) -> Column:
    """Quarter of the year that starts in the given month; the fiscal year is named by its end."""
    moved = F.add_months(col(c), (13 - fiscal_start) % 12)
    return F.year(moved) + F.quarter(moved) / 10 if with_year else F.quarter(moved)


def semester(c) -> Column:
    return F.when(F.month(col(c)) <= 6, 1).otherwise(2)


def am(c) -> Column:
    return F.hour(col(c)) < 12


def pm(c) -> Column:
    return F.hour(col(c)) >= 12


def _offset(c: Column, tz: str) -> Column:
    return F.unix_timestamp(F.from_utc_timestamp(c, tz)) - F.unix_timestamp(c)


def dst(c, tz: str) -> Column:
    """The offset is above the smaller of the January and July offsets of that year."""
    c = col(c)
    jan, jul = (F.make_timestamp(F.year(c), F.lit(m), F.lit(1), F.lit(0), F.lit(0), F.lit(0)) for m in (1, 7))
    return _offset(c, tz) > F.least(_offset(jan, tz), _offset(jul, tz))


def leap_year(c, is_year: bool = False) -> Column:
    y = col(c) if is_year else F.year(col(c))
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def days_in_month(c) -> Column:
    return F.dayofmonth(F.last_day(col(c)))


def update_parts(c, **parts: int) -> Column:
    """Replace year, month, day, hour, minute or second."""
    c = col(c)
    get = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour, "minute": F.minute, "second": F.second}
    v = [F.lit(parts[k]) if k in parts else f(c) for k, f in get.items()]
    return F.format_string("%04d-%02d-%02d %02d:%02d:%02d", *v).try_cast("timestamp")


_FIXED = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


def floor_date(c, unit: str = "day", n: int = 1, week_start: int = 7) -> Column:
    """Start of the unit, or of n units; weeks start on Sunday unless week_start is 1 (Monday)."""
    c = col(c).cast("timestamp")
    if unit == "week":
        return F.date_trunc("week", c) if week_start == 1 else F.date_trunc("week", c + F.expr("INTERVAL 1 DAY")) - F.expr("INTERVAL 1 DAY")
    if n == 1:
        if unit == "halfyear":
            return floor_date(c, "month", 6)
        return F.date_trunc(unit, c)
    if unit in ("month", "quarter", "year"):
        size = n * {"month": 1, "quarter": 3, "year": 12}[unit]
        months = F.year(c) * 12 + F.month(c) - 1
        at = (F.floor(months / size) * size).cast("int")
        return F.make_timestamp(F.floor(at / 12).cast("int"), at % 12 + 1, F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    step = n * _FIXED[unit]
    # n units within the next larger one, counted from its start
    top = F.date_trunc({"second": "minute", "minute": "hour", "hour": "day", "day": "month"}[unit], c)
    inside = F.unix_timestamp(c) - F.unix_timestamp(top)
    return F.timestamp_seconds(F.unix_timestamp(top) + F.floor(inside / step) * step)


def _next_unit(start: Column, unit: str, n: int) -> Column:
    if unit in ("month", "quarter", "year", "halfyear"):
        months = n * {"month": 1, "quarter": 3, "year": 12, "halfyear": 6}[unit]
        return F.add_months(start, months).cast("timestamp")
    return F.timestamp_seconds(F.unix_timestamp(start) + n * {"week": 604_800, **_FIXED}[unit])


def ceiling_date(c, unit: str = "day", n: int = 1) -> Column:
    """Next boundary; a value on a boundary stays."""
    c = col(c).cast("timestamp")
    low = floor_date(c, unit, n)
    return F.when(low == c, c).otherwise(_next_unit(low, unit, n))


def round_date(c, unit: str = "day", n: int = 1) -> Column:
    """Nearer boundary, the later one in the middle."""
    c = col(c).cast("timestamp")
    low = floor_date(c, unit, n)
    high = _next_unit(low, unit, n)
    return F.when(F.unix_micros(c) - F.unix_micros(low) < F.unix_micros(high) - F.unix_micros(c), low).otherwise(high)


def rollback(c, to_first: bool = False) -> Column:
    """Last day of the previous month, or first day of this one."""
    c = col(c)
    return F.trunc(c, "month") if to_first else F.last_day(F.add_months(c, -1))


def add_months_clamped(c, n) -> Column:
    """Month addition that stops at the month end."""
    return F.add_months(col(c), n)


def add_period(c, years: int = 0, months: int = 0, weeks: int = 0, days: int = 0) -> Column:
    """Calendar addition to a date; NA where the day does not exist in the target month."""
    c = F.to_date(col(c))
    moved = F.add_months(c, years * 12 + months)
    moved = F.when(F.dayofmonth(moved) == F.dayofmonth(c), moved)
    return F.date_add(moved, weeks * 7 + days)


def add_duration(c, seconds=0, minutes=0, hours=0, days=0, weeks=0, years=0, year_days: float = 365) -> Column:
    """Exact seconds."""
    total = seconds + 60 * minutes + 3600 * hours + 86_400 * days + 604_800 * weeks + 86_400 * year_days * years
    return F.timestamp_micros(F.unix_micros(col(c).cast("timestamp")) + int(total * 1_000_000))


def interval(start, end) -> Column:
    return F.struct(col(start).alias("start"), col(end).alias("end"))


def int_overlaps(a: Column, b: Column) -> Column:
    """Share a moment; a common end point counts."""
    return (a["start"] <= b["end"]) & (b["start"] <= a["end"])


def within(c, iv: Column) -> Column:
    return (col(c) >= iv["start"]) & (col(c) <= iv["end"])


def int_within(a: Column, b: Column) -> Column:
    return (a["start"] >= b["start"]) & (a["end"] <= b["end"])


def int_shift(iv: Column, seconds: int) -> Column:
    return F.struct(add_duration(iv["start"], seconds).alias("start"), add_duration(iv["end"], seconds).alias("end"))


def int_flip(iv: Column) -> Column:
    return F.struct(iv["end"].alias("start"), iv["start"].alias("end"))


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}


def time_length(start, end, unit: str = "second") -> Column:
    """Length in a unit; months and years count anniversaries."""
    a, b = col(start).cast("timestamp"), col(end).cast("timestamp")
    if unit in ("month", "year"):
        return F.months_between(b, a, False) / (12 if unit == "year" else 1)
    return (F.unix_micros(b) - F.unix_micros(a)) / (1_000_000.0 * _UNIT_SECONDS[unit])


def int_length(iv: Column, unit: str = "second") -> Column:
    return time_length(iv["start"], iv["end"], unit)


def _months_clamped(iv: Column) -> Column:
    """Whole months between the ends."""
    return F.floor(F.months_between(iv["end"], iv["start"], False)).cast("int")


def int_div_months(iv: Column) -> Column:
    return _months_clamped(iv)


def int_mod_days(iv: Column) -> Column:
    """Days left after the whole months."""
    return F.datediff(iv["end"], F.add_months(iv["start"], _months_clamped(iv)))


def as_period_text(iv: Column) -> Column:
    m = _months_clamped(iv)
    return F.format_string("%dy %dm %dd", F.floor(m / 12).cast("int"), m % 12, int_mod_days(iv))


def period_to_seconds(years: int = 0, months: int = 0, days: int = 0, hours: int = 0, minutes: int = 0, seconds: int = 0) -> float:
    """Estimate with years of 365.25 days and months of a twelfth of that."""
    return 31_557_600 * years + 2_629_800 * months + 86_400 * days + 3600 * hours + 60 * minutes + seconds


def _year_start(y: Column) -> Column:
    return F.unix_timestamp(F.make_timestamp(y, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))


def decimal_date(c) -> Column:
    c = col(c).cast("timestamp")
    y = F.year(c)
    a, b = _year_start(y), _year_start(y + 1)
    return y + (F.unix_micros(c) / 1_000_000 - a) / (b - a)


def date_decimal(c) -> Column:
    c = col(c)
    y = F.floor(c).cast("int")
    a, b = _year_start(y), _year_start(y + 1)
    return F.timestamp_seconds(F.round(a + (c - y) * (b - a)).cast("bigint"))


def with_tz(c, tz: str) -> Column:
    """Clock of the same instant in another zone."""
    return F.from_utc_timestamp(col(c), tz)


def force_tz(c, tz: str) -> Column:
    """Instant at which the clock of another zone shows this time."""
    return F.to_utc_timestamp(col(c), tz)


def local_time(c, tz: str) -> Column:
    """Seconds since midnight on the clock of a zone."""
    t = with_tz(c, tz)
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def as_date(c) -> Column:
    """Days since 1970-01-01 to a date."""
    return F.date_add(F.lit("1970-01-01").cast("date"), col(c).cast("int"))


def as_datetime(c) -> Column:
    return F.timestamp_seconds(col(c))


# First days of the two spreadsheet calendars: fixed values.
_SERIAL_BASE = {"modern": "1899-12-30", "mac pre-2011": "1904-01-01"}


def excel_numeric_to_date(c, system: str = "modern", include_time: bool = False) -> Column:
    c = col(c)
    base = F.lit(_SERIAL_BASE[system]).cast("date")
    days = F.floor(c)
    if not include_time:
        return F.date_add(base, days.cast("int"))
    seconds = F.round((c - days) * 86_400).cast("bigint")
    return F.timestamp_seconds(F.unix_timestamp(F.date_add(base, days.cast("int")).cast("timestamp")) + seconds)


def today() -> Column:
    return F.current_date()


def now() -> Column:
    return F.current_timestamp()


def stamp(c, example: str) -> Column:
    """Format like an example, whose parts are found from left to right: ISO, month names, day first or month first."""
    import re
    shapes = [(r"\d{4}-\d{2}-\d{2}", "yyyy-MM-dd"), (r"\d{1,2}:\d{2}:\d{2}", "HH:mm:ss"), (r"\d{1,2}:\d{2}", "HH:mm"),
              (r"\b(?:" + "|".join(_ENGLISH) + r")\b", "MMMM"), (r"\b(?:" + "|".join(m[:3] for m in _ENGLISH) + r")\b", "MMM"),
              (r"\b\d{4}\b", "yyyy"), (r"\b\d{2}\b", "dd"), (r"\b\d\b", "d")]
    parts, i = [], 0
    while i < len(example):
        found = next(((m, p) for rx, p in shapes if (m := re.compile(rx).match(example, i))), None)
        parts.append((found[1], False) if found else (example[i], True))
        i = found[0].end() if found else i + 1
    return F.date_format(col(c), _quoted(parts))


# -------------------------------------------------------------- school year

def academic_year(c, start_month: int = 7, style: str = "first_year") -> Column:
    """First calendar year of the school year, or a label such as 1998-1999."""
    c = col(c)
    first = F.year(c) - F.when(F.month(c) < start_month, 1).otherwise(0)
    return first if style == "first_year" else F.concat_ws("-", first.cast("string"), (first + 1).cast("string"))


def term_id(y, base: int, factor: int) -> Column:
    """(year - base) * factor; both numbers belong to the student system in use."""
    return (col(y) - base) * factor


# Order of the test seasons in a school year: a choice of this library.
SEASON_ORDER = {"Fall": 1, "Winter": 2, "Spring": 3, "Summer": 4}


def season_fix(c) -> Column:
    """Clean season text: first known season name in it, capitalised."""
    found = F.regexp_extract(F.lower(col(c)), "(fall|autumn|winter|spring|summer)", 1)
    return F.when(found == "", None).when(found == "autumn", "Fall").otherwise(F.initcap(found))


def season_number(c) -> Column:
    c = col(c)
    out = F
    for name, i in SEASON_ORDER.items():
        out = out.when(c == name, i)
    return out.otherwise(None)
