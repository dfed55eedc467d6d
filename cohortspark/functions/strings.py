"""Text functions as expressions; pandas functions only for wrapping and Unicode forms."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.na import col


def str_length(c) -> Column:
    return F.char_length(col(c))


def _at(c: Column, i: int) -> Column:
    return F.lit(i) if i >= 0 else F.char_length(c) + i + 1


def str_sub(c, start: int = 1, end: int = -1) -> Column:
    """Substring by first and last position, negative from the right."""
    c = col(c)
    s = F.greatest(_at(c, start), F.lit(1))
    return F.substring(c, s, F.greatest(_at(c, end) - s + 1, F.lit(0)))


def str_sub_set(c, start: int, end: int, value: str) -> Column:
    """The text with the part from start to end replaced."""
    c = col(c)
    s = F.greatest(_at(c, start), F.lit(1))
    return F.concat(F.substring(c, F.lit(1), s - 1), F.lit(value),
                    F.substring(c, F.greatest(_at(c, end), s - 1) + 1, F.char_length(c)))


def str_c(*cols, sep: str = "") -> Column:
    """Concatenate; one NA makes the result NA."""
    parts = []
    for c in cols:
        parts += [F.lit(sep), col(c).cast("string")] if parts and sep else [col(c).cast("string")]
    return F.concat(*parts)


def collapse(arr, sep: str = ", ", last: str | None = None) -> Column:
    """Join an array, with another separator before the last item."""
    arr = col(arr)
    if last is None:
        return F.array_join(arr, sep)
    n = F.size(arr)
    return F.when(n < 2, F.array_join(arr, sep)).otherwise(
        F.concat(F.array_join(F.slice(arr, F.lit(1), F.greatest(n - 1, F.lit(0))), sep), F.lit(last), F.get(arr, n - 1)))


def str_dup(c, n) -> Column:
    return F.repeat(col(c), n if isinstance(n, int) else col(n))


def str_pad(c, width: int, side: str = "left", pad: str = " ") -> Column:
    c = col(c)
    n = F.char_length(c)
    full = F.greatest(n, F.lit(width))
    if side == "left":
        return F.lpad(c, full, pad)
    if side == "right":
        return F.rpad(c, full, pad)
    left = F.floor((full - n) / 2).cast("int")
    return F.rpad(F.lpad(c, n + left, pad), full, pad)


def str_trunc(c, width: int, side: str = "right", ellipsis: str = "...") -> Column:
    c = col(c)
    room, n = width - len(ellipsis), F.char_length(c)
    if room < 0:
        raise ValueError("width is shorter than the ellipsis")
    if side == "right":
        cut = F.concat(F.substring(c, 1, room), F.lit(ellipsis))
    elif side == "left":
        cut = F.concat(F.lit(ellipsis), F.substring(c, n - room + 1, F.lit(room)))
    else:
        a, b = -(-room // 2), room // 2
        cut = F.concat(F.substring(c, 1, a), F.lit(ellipsis), F.substring(c, n - b + 1, F.lit(b)))
    return F.when(n > width, cut).otherwise(c)


def str_trim(c, side: str = "both") -> Column:
    left, right = r"^\s+", r"\s+$"
    return F.regexp_replace(col(c), {"both": f"{left}|{right}", "left": left, "right": right}[side], "")


def str_squish(c) -> Column:
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


def str_wrap(c, width: int = 80, indent: int = 0, exdent: int = 0) -> Column:
    """Lines of at most ``width`` characters, filled word by word; longer words stand alone. White space between words is one blank."""
    words = F.filter(F.split(col(c), r"\s+"), lambda w: w != "")
    state = F.struct(F.array().cast("array<string>").alias("lines"), F.lit(None).cast("string").alias("line"))

    def add(s, w):
        fits = F.char_length(s["line"]) + 1 + F.char_length(w) <= width
        return F.when(s["line"].isNull(), F.struct(s["lines"].alias("lines"), F.concat(F.lit(" " * indent), w).alias("line"))).when(
            fits, F.struct(s["lines"].alias("lines"), F.concat_ws(" ", s["line"], w).alias("line"))).otherwise(
            F.struct(F.concat(s["lines"], F.array(s["line"])).alias("lines"), F.concat(F.lit(" " * exdent), w).alias("line")))

    return F.aggregate(words, state, add, lambda s: F.array_join(F.concat(s["lines"], F.array(F.coalesce(s["line"], F.lit("")))), "\n"))


def _turkic(locale: str) -> bool:
    return locale.split("_")[0].lower() in ("tr", "az")


def str_to_lower(c, locale: str = "en") -> Column:
    return F.lower(F.translate(col(c), "Iİ", "ıi")) if _turkic(locale) else F.lower(col(c))


def str_to_upper(c, locale: str = "en") -> Column:
    return F.upper(F.translate(col(c), "iı", "İI")) if _turkic(locale) else F.upper(col(c))


def str_to_title(c) -> Column:
    return F.initcap(col(c))


def str_to_sentence(c) -> Column:
    c = col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.char_length(c))))


# Pattern modes: regex, fixed (literal), coll (equal under a collation).

def _pattern(p: str, ignore_case: bool) -> str:
    return f"(?iu){p}" if ignore_case else p


def str_detect(c, pattern: str, mode: str = "regex", ignore_case: bool = False, locale: str = "UNICODE") -> Column:
    c = col(c)
    if mode == "fixed":
        return F.contains(F.lower(c), F.lit(pattern.lower())) if ignore_case else F.contains(c, F.lit(pattern))
    if mode == "coll":
        name = locale + ("_CI" if ignore_case else "")
        nfc = unicodedata.normalize("NFC", pattern)
        return F.contains(F.collate(normalize(c), name), F.collate(F.lit(nfc), name))
    return c.rlike(_pattern(pattern, ignore_case))


def str_subset(df: DataFrame, c: str, pattern: str, **mode) -> DataFrame:
    return df.where(str_detect(c, pattern, **mode))


def str_which(df: DataFrame, c: str, pattern: str, order: list[str], name: str = "position", **mode) -> DataFrame:
    from cohortspark.operators.ordered import row_number
    return row_number(df, name, order).where(str_detect(c, pattern, **mode)).select(name)


def str_count(c, pattern: str, mode: str = "regex", ignore_case: bool = False) -> Column:
    c = col(c)
    if mode == "fixed":
        pattern = re.escape(pattern)
    return F.regexp_count(c, F.lit(_pattern(pattern, ignore_case)))


def str_locate(c, pattern: str) -> Column:
    """Struct of first and last position of the first match, NA without one."""
    c = col(c)
    start, text = F.regexp_instr(c, F.lit(pattern)), F.regexp_substr(c, F.lit(pattern))
    return F.when(start > 0, F.struct(start.alias("start"), (start + F.char_length(text) - 1).alias("end")))


def str_locate_all(c, pattern: str) -> Column:
    """Array of the positions of all matches (of patterns that match no empty text).

    The gaps between matches and the matches themselves give the positions.
    """
    c = col(c)
    gaps = F.transform(F.split(c, pattern, -1), F.char_length)
    sizes = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), F.char_length)
    start0 = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc, pair):
        first = acc["at"] + pair["g"] + 1
        last = first + pair["s"] - 1
        return F.struct(last.alias("at"), F.array_append(acc["out"], F.struct(first.alias("start"), last.alias("end"))).alias("out"))

    pairs = F.zip_with(gaps, sizes, lambda g, s: F.struct(g.alias("g"), s.alias("s")))
    return F.reduce(F.filter(pairs, lambda p: p["s"].isNotNull()), start0, step, lambda a: a["out"])


def str_extract(c, pattern: str) -> Column:
    return F.regexp_substr(col(c), F.lit(pattern))


def str_extract_all(c, pattern: str) -> Column:
    return F.regexp_extract_all(col(c), F.lit(pattern), F.lit(0))


def str_match(c, pattern: str, groups: int) -> list[Column]:
    """Whole match and each group, NA without a match."""
    c = col(c)
    hit = c.rlike(pattern)
    return [F.when(hit, F.regexp_extract(c, pattern, i)) for i in range(groups + 1)]


def str_match_all(c, pattern: str, groups: int) -> Column:
    """Array of structs g0, g1, ... for all matches."""
    c = col(c)
    return F.arrays_zip(*[F.regexp_extract_all(c, F.lit(pattern), F.lit(i)).alias(f"g{i}") for i in range(groups + 1)])


def _replacement(text: str, shift: int = 0) -> str:
    """``\\1`` references to the ``$1`` form; other dollar signs are literal."""
    text = text.replace("$", r"\$")
    return re.sub(r"\\([0-9])", lambda m: f"${int(m.group(1)) + shift}", text)


def str_replace_all(c, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(col(c), pattern, _replacement(replacement))


def str_replace(c, pattern: str, replacement: str) -> Column:
    """First match only."""
    return F.regexp_replace(col(c), rf"(?s)\A(.*?)(?:{pattern})", "$1" + _replacement(replacement, 1))


def str_remove(c, pattern: str) -> Column:
    return str_replace(c, pattern, "")


def str_remove_all(c, pattern: str) -> Column:
    return str_replace_all(c, pattern, "")


def str_replace_na(c, replacement: str = "NA") -> Column:
    return F.coalesce(col(c), F.lit(replacement))


def str_split(c, pattern: str, n: int = -1) -> Column:
    """Array of pieces; an empty pattern gives the characters."""
    c = col(c)
    if pattern == "":
        return F.filter(F.split(c, "(?!^)", n), lambda x: x != "")
    return F.split(c, pattern, n)


def str_split_fixed(c, pattern: str, n: int) -> list[Column]:
    parts = str_split(c, pattern, n)
    return [F.coalesce(F.get(parts, F.lit(i)), F.lit("")) for i in range(n)]


def words_of(c) -> Column:
    """Words at word boundaries."""
    return F.regexp_extract_all(col(c), F.lit(r"[\p{L}\p{N}_']+"), F.lit(0))


def word(c, i: int, sep: str = " ") -> Column:
    """The i-th word, from the end for negative i; NA when there are fewer."""
    return F.try_element_at(F.split(col(c), re.escape(sep)), F.lit(i))


_SLOT = re.compile(r"\{([^{}:]+)(?::([^{}]*))?\}")


def glue(template: str) -> Column:
    """``{column}`` and ``{column:.2f}`` slots; the template is read while the plan is built."""
    parts, at = [], 0
    for m in _SLOT.finditer(template):
        if m.start() > at:
            parts.append(F.lit(template[at:m.start()]))
        c = F.expr(m.group(1))
        parts.append(F.format_string("%" + m.group(2), c) if m.group(2) else F.coalesce(c.cast("string"), F.lit("NA")))
        at = m.end()
    if at < len(template):
        parts.append(F.lit(template[at:]))
    return F.concat(*parts)


def str_conv(c, encoding: str) -> Column:
    return F.decode(col(c), encoding)


def valid_utf8(c) -> Column:
    return F.is_valid_utf8(col(c))


def make_valid(c) -> Column:
    return F.make_valid_utf8(col(c))


def normalize(c, form: str = "NFC") -> Column:
    @F.pandas_udf("string")
    def norm(s: pd.Series) -> pd.Series:
        return s.str.normalize(form)
    return norm(col(c))


def _latin_pairs() -> tuple[str, str]:
    """Latin letters with a mark and the plain letter they break down to."""
    src, dst = [], []
    for code in range(0xC0, 0x250):
        plain = unicodedata.normalize("NFKD", chr(code))[0]
        if plain.isascii() and plain != chr(code):
            src.append(chr(code))
            dst.append(plain)
    return "".join(src), "".join(dst)


# Letters with no break-down: fixed values.
_SPELLED = {"ß": "ss", "æ": "ae", "Æ": "AE", "ø": "o", "Ø": "O", "œ": "oe", "Œ": "OE", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "þ": "th", "Þ": "Th"}


def asciify(c) -> Column:
    """Letters without their accents."""
    out = F.translate(F.regexp_replace(col(c), r"\p{M}+", ""), *_latin_pairs())
    for a, b in _SPELLED.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def _parsed(c: Column, sep_in: str) -> Column:
    c = F.regexp_replace(c, r"([a-z0-9])([A-Z])", "$1 $2")
    c = F.regexp_replace(c, r"([A-Z]+)([A-Z][a-z])", "$1 $2")
    return F.filter(F.split(c, sep_in), lambda w: w != "")


def to_any_case(c, case: str = "snake", sep_in: str = "[^A-Za-z0-9]+", sep_out: str | None = None) -> Column:
    """snake, small_camel, big_camel, all_caps, parsed, mixed, title, sentence."""
    words = _parsed(col(c), sep_in)
    up = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.char_length(w))))
    keep = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.char_length(w)))
    j = lambda arr, d: F.array_join(arr, d if sep_out is None else sep_out)
    if case == "snake":
        return j(F.transform(words, F.lower), "_")
    if case == "all_caps":
        return j(F.transform(words, F.upper), "_")
    if case == "parsed":
        return j(words, "_")
    if case == "mixed":
        return j(F.transform(words, keep), "_")
    if case == "big_camel":
        return j(F.transform(words, up), "")
    if case == "small_camel":
        return j(F.transform(words, lambda w, i: F.when(i == 0, F.lower(w)).otherwise(up(w))), "")
    if case == "title":
        return j(F.transform(words, up), " ")
    if case == "sentence":
        return j(F.transform(words, lambda w, i: F.when(i == 0, up(w)).otherwise(F.lower(w))), " ")
    raise ValueError(case)


def to_ordinal(c, lang: str = "en") -> Column:
    """Number with its ordinal ending (masculine forms)."""
    c = col(c)
    tens, hundreds = F.pmod(c, F.lit(10)), F.pmod(c, F.lit(100))
    teen = hundreds.between(11, 13)
    if lang == "en":
        end = F.when(teen, "th").when(tens == 1, "st").when(tens == 2, "nd").when(tens == 3, "rd").otherwise("th")
    elif lang == "de":
        end = F.when(hundreds.between(1, 19), "te").otherwise("ste")
    elif lang == "fr":
        end = F.when(c == 1, "er").otherwise("e")
    elif lang == "es":
        end = F.when(tens.isin(1, 3), "er").when(tens == 2, "do").when(tens.isin(4, 5, 6), "to").when(
            tens.isin(7, 0), "mo").when(tens == 8, "vo").otherwise("no")
    elif lang == "sv":
        end = F.when(tens.isin(1, 2) & ~hundreds.isin(11, 12), ":a").otherwise(":e")
    else:
        raise ValueError(lang)
    return F.concat(c.cast("string"), end)


def fmt_comma(c, digits: int = 0) -> Column:
    return F.format_number(col(c), digits)


def fmt_dollar(c, digits: int = 2, prefix: str = "$") -> Column:
    c = col(c)
    return F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), F.lit(prefix), F.format_number(F.abs(c), digits))


def fmt_pct(c, digits: int = 1) -> Column:
    return F.concat(F.format_number(col(c) * 100, digits), F.lit("%"))


def fmt_scientific(c, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}e", col(c).cast("double"))


def fmt_pvalue(c, digits: int = 3) -> Column:
    low = 10.0 ** -digits
    return F.when(col(c) < low, F.lit(f"<{low:.{digits}f}")).when(col(c) > 1 - low, F.lit(f">{1 - low:.{digits}f}")).otherwise(
        F.format_string(f"%.{digits}f", col(c)))


def fmt_bytes(c, base: int = 1024) -> Column:
    c = col(c).cast("double")
    units = ["B", "kB", "MB", "GB", "TB", "PB", "EB"]
    out = F.format_string("%d B", F.bround(c).cast("bigint"))
    for i, u in enumerate(units[1:], 1):
        out = F.when(F.abs(c) >= float(base) ** i, F.format_string(f"%.1f {u}", c / float(base) ** i)).otherwise(out)
    return out


def pretty_ms(ms) -> Column:
    """Milliseconds as ``1d 2h 3m 4s``; below one second as ``5ms``."""
    ms = col(ms).cast("bigint")
    parts = []
    for unit, size, wrap in (("d", 86_400_000, None), ("h", 3_600_000, 24), ("m", 60_000, 60), ("s", 1000, 60)):
        n = F.floor(ms / size)
        n = n if wrap is None else F.pmod(n, F.lit(wrap))
        parts.append(F.when(n > 0, F.concat(n.cast("string"), F.lit(unit))))
    return F.when(ms < 1000, F.concat(ms.cast("string"), F.lit("ms"))).otherwise(F.concat_ws(" ", *parts))


def time_ago(c, now) -> Column:
    """Rounded distance to ``now`` in words."""
    s = F.unix_timestamp(col(now)) - F.unix_timestamp(col(c))
    minute, hour, day = 60, 3600, 86_400
    # Upper end in seconds, unit of the number if there is one, text.
    ladder = [(10, None, "moments ago"), (45, None, "less than a minute ago"), (90, None, "about a minute ago"), (45 * minute, minute, "minutes ago"),
              (90 * minute, None, "about an hour ago"), (24 * hour, hour, "hours ago"), (42 * hour, None, "a day ago"), (30 * day, day, "days ago"),
              (45 * day, None, "about a month ago"), (335 * day, 30 * day, "months ago"), (547.5 * day, None, "about a year ago")]
    out = F
    for top, unit, text in ladder:
        out = out.when(s < top, F.lit(text) if unit is None else F.concat(F.round(s / unit).cast("int").cast("string"), F.lit(" " + text)))
    return out.otherwise(F.concat(F.round(s / (365 * day)).cast("int").cast("string"), F.lit(" years ago")))


def abbrev(c) -> Column:
    """First letter of each word in capitals (a rule of this library)."""
    return F.array_join(F.transform(words_of(c), lambda w: F.upper(F.substring(w, 1, 1))), "")


def b64_encode(c) -> Column:
    return F.base64(F.encode(col(c), "UTF-8"))


def b64_decode(c) -> Column:
    return F.decode(F.unbase64(col(c)), "UTF-8")


def data_uri(c, mime: str = "text/plain") -> Column:
    return F.concat(F.lit(f"data:{mime};base64,"), b64_encode(c))


def url_encode(c) -> Column:
    return F.url_encode(col(c))


def url_decode(c) -> Column:
    return F.url_decode(col(c))


def hash_cols(df: DataFrame, cols: list[str], algo: str = "sha256", digits: int = 14, key: str | None = None) -> Column:
    """Hash of one or more columns; doubles go in with a fixed number of significant digits."""
    parts = []
    for c in cols:
        kind = df.schema[c].dataType.typeName()
        x = F.format_string(f"%.{digits - 1}e", F.col(c).cast("double")) if kind in ("double", "float") else F.col(c).cast("string")
        parts.append(F.coalesce(x, F.lit("NA")))
    text = F.encode(F.concat_ws("\x1f", *parts), "UTF-8")
    if key is not None:
        return hmac_sha256(text, key)
    return {"md5": F.md5, "sha1": F.sha1, "sha256": lambda x: F.sha2(x, 256), "sha512": lambda x: F.sha2(x, 512),
            "crc32": lambda x: F.hex(F.crc32(x))}[algo](text)


def hmac_sha256(data: Column, key: str) -> Column:
    """The keyed hash put together from two plain hashes; the padded keys are constants."""
    import hashlib
    k = key.encode()
    k = (hashlib.sha256(k).digest() if len(k) > 64 else k).ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in k), bytes(b ^ 0x5C for b in k)
    first = F.unhex(F.sha2(F.concat(F.lit(bytearray(inner)), data), 256))
    return F.sha2(F.concat(F.lit(bytearray(outer)), first), 256)


def aes_encrypt(c, key: str, mode: str = "CBC") -> Column:
    return F.base64(F.aes_encrypt(col(c), F.lit(key), F.lit(mode)))


def aes_decrypt(c, key: str, mode: str = "CBC") -> Column:
    return F.decode(F.aes_decrypt(F.unbase64(col(c)), F.lit(key), F.lit(mode)), "UTF-8")
