"""Queries: text functions over whole texts."""

from pyspark.sql import functions as F

from cohortspark.functions import strings as S
from cohortspark.plans.registry import query

IP = r"([0-9]{1,3})[.]([0-9]{1,3})[.]([0-9]{1,3})[.]([0-9]{1,3})"


@query("str_length_sub", """SELECT doc_id, length(text) AS n, substr(text, 3, 3) AS third, substr(text, 2, greatest(length(text) - 2, 0)) AS inner_text, right(text, 4) AS tail FROM documents""")
def str_length_sub(t):
    return t.documents.select("doc_id", S.str_length("text").cast("bigint").alias("n"), S.str_sub("text", 3, 5).alias("third"),
                              S.str_sub("text", 2, -2).alias("inner_text"), S.str_sub("text", -4, -1).alias("tail"))


@query("str_sub_assign", "SELECT p_partkey, substr(p_name, 1, 2) || 'XY' || substr(p_name, 4) AS name FROM part")
def str_sub_assign(t):
    return t.part.select("p_partkey", S.str_sub_set("p_name", 3, 3, "XY").alias("name"))


@query("str_concat_na", """SELECT l_orderkey, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag || '-' || l_linestatus END AS code FROM lineitem""")
def str_concat_na(t):
    flag = F.when(F.col("l_linenumber") != 3, F.col("l_returnflag"))
    return t.lineitem.select("l_orderkey", S.str_c(flag, "l_linestatus", sep="-").alias("code"))


@query("str_flatten_groups", """SELECT k, chunk, string_agg(s_name, ', ' ORDER BY s_suppkey) AS names FROM (SELECT s_nationkey::BIGINT AS k, s_suppkey, s_name, (ROW_NUMBER() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1) // 1000 + 1 AS chunk FROM supplier) GROUP BY 1, 2""")
def str_flatten_groups(t):
    from cohortspark.operators.reshape import flatten_text
    base = t.supplier.select(F.col("s_nationkey").cast("bigint").alias("k"), "s_suppkey", "s_name")
    return flatten_text(base, ["k"], "s_name", ", ", ["s_suppkey"], "names", rows_per_cell=1000)


@query("collapse_with_last", """SELECT p_partkey, array_to_string(string_split(p_name, ' ')[:-2], ', ') || CASE WHEN len(string_split(p_name, ' ')) > 1 THEN ' and ' ELSE '' END || string_split(p_name, ' ')[-1] AS names FROM part""")
def collapse_with_last(t):
    return t.part.select("p_partkey", S.collapse(F.split("p_name", " "), ", ", " and ").alias("names"))


@query("str_dup_pad_trunc", """SELECT p_partkey, repeat(p_brand, 2) AS twice, lpad(p_name, greatest(length(p_name), 20)::INT, ' ') AS left_pad, rpad(p_name, greatest(length(p_name), 20)::INT, '*') AS right_pad,
rpad(lpad(p_name, (length(p_name) + greatest(20 - length(p_name), 0) // 2)::INT, ' '), greatest(length(p_name), 20)::INT, ' ') AS both_pad,
CASE WHEN length(p_name) > 8 THEN substr(p_name, 1, 5) || '...' ELSE p_name END AS cut FROM part""")
def str_dup_pad_trunc(t):
    return t.part.select("p_partkey", S.str_dup("p_brand", 2).alias("twice"), S.str_pad("p_name", 20).alias("left_pad"), S.str_pad("p_name", 20, "right", "*").alias("right_pad"),
                         S.str_pad("p_name", 20, "both").alias("both_pad"), S.str_trunc("p_name", 8).alias("cut"))


@query("str_trunc_sides", """SELECT p_partkey, CASE WHEN length(p_name) > 8 THEN '...' || right(p_name, 5) ELSE p_name END AS l, CASE WHEN length(p_name) > 8 THEN substr(p_name, 1, 3) || '...' || right(p_name, 2) ELSE p_name END AS c FROM part""")
def str_trunc_sides(t):
    return t.part.select("p_partkey", S.str_trunc("p_name", 8, "left").alias("l"), S.str_trunc("p_name", 8, "center").alias("c"))


@query("str_trim_squish", r"""SELECT doc_id, md5(regexp_replace(text, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g')) AS trimmed, md5(trim(regexp_replace(text, '[ \t\n\r\f]+', ' ', 'g'))) AS squished FROM documents""")
def str_trim_squish(t):
    return t.documents.select("doc_id", F.md5(S.str_trim("text")).alias("trimmed"), F.md5(S.str_squish("text")).alias("squished"))


@query("str_wrap_texts")
def str_wrap_texts(t):
    return t.documents.select("doc_id", F.md5(S.str_wrap("text", 60)).alias("wrapped"))


@query("case_mapping", """SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS sentence,
array_to_string(list_transform(string_split(p_name, ' '), lambda w : upper(substr(w, 1, 1)) || substr(w, 2)), ' ') AS title FROM part""")
def case_mapping(t):
    return t.part.select("p_partkey", S.str_to_upper("p_name").alias("up"), S.str_to_lower("p_brand").alias("low"), S.str_to_sentence("p_name").alias("sentence"),
                         S.str_to_title("p_name").alias("title"))


@query("case_turkish", "SELECT p_partkey, upper(replace(p_name, 'i', 'İ')) AS up, lower(replace(p_type, 'I', 'ı')) AS low FROM part")
def case_turkish(t):
    return t.part.select("p_partkey", S.str_to_upper("p_name", "tr").alias("up"), S.str_to_lower("p_type", "tr").alias("low"))


@query("str_detect_count", f"""SELECT doc_id, regexp_matches(text, '{IP}') AS has_ip, len(regexp_extract_all(text, '{IP}')) AS n_ip, len(regexp_extract_all(text, 'the')) AS n_the FROM documents""")
def str_detect_count(t):
    return t.documents.select("doc_id", S.str_detect("text", IP).alias("has_ip"), S.str_count("text", IP).cast("bigint").alias("n_ip"),
                              S.str_count("text", "the", "fixed").cast("bigint").alias("n_the"))


@query("str_subset_which", """SELECT position FROM (SELECT p_name, ROW_NUMBER() OVER (ORDER BY p_partkey) AS position FROM part) WHERE p_name LIKE '%ring%'""")
def str_subset_which(t):
    return S.str_which(t.part, "p_name", "ring", ["p_partkey"])


@query("str_locate_first", f"""SELECT doc_id, instr(text, regexp_extract(text, '{IP}')) AS a, instr(text, regexp_extract(text, '{IP}')) + length(regexp_extract(text, '{IP}')) - 1 AS b
FROM documents WHERE regexp_matches(text, '{IP}')""")
def str_locate_first(t):
    at = t.documents.select("doc_id", S.str_locate("text", IP).alias("at")).where("at IS NOT NULL")
    return at.select("doc_id", F.col("at.start").cast("bigint").alias("a"), F.col("at.end").cast("bigint").alias("b"))


@query("str_locate_every", """SELECT p_partkey, array_to_string(list_filter(range(1, length(p_name) + 1), lambda i : substr(p_name, i, 1) = 'r'), ',') AS at FROM part""")
def str_locate_every(t):
    return t.part.select("p_partkey", F.array_join(F.transform(S.str_locate_all("p_name", "r"), lambda s: s["start"].cast("string")), ",").alias("at"))


@query("str_extract_match", f"""SELECT doc_id, CASE WHEN regexp_matches(text, '{IP}') THEN regexp_extract(text, '{IP}') END AS ip, CASE WHEN regexp_matches(text, '{IP}') THEN regexp_extract(text, '{IP}', 2) END AS second,
array_to_string(regexp_extract_all(text, '{IP}'), ' ') AS every, array_to_string(regexp_extract_all(text, '{IP}', 4), ' ') AS lasts FROM documents""")
def str_extract_match(t):
    m = S.str_match("text", IP, 4)
    return t.documents.select("doc_id", S.str_extract("text", IP).alias("ip"), m[2].alias("second"), F.array_join(S.str_extract_all("text", IP), " ").alias("every"),
                              F.array_join(F.transform(S.str_match_all("text", IP, 4), lambda s: s["g4"]), " ").alias("lasts"))


@query("str_replace_first_all", rf"""SELECT doc_id, md5(regexp_replace(text, '{IP}', '\1.x.x.\4')) AS once, md5(regexp_replace(text, '{IP}', '\1.x.x.\4', 'g')) AS every, md5(regexp_replace(text, '[0-9]+', '', 'g')) AS gone FROM documents""")
def str_replace_first_all(t):
    return t.documents.select("doc_id", F.md5(S.str_replace("text", IP, r"\1.x.x.\4")).alias("once"), F.md5(S.str_replace_all("text", IP, r"\1.x.x.\4")).alias("every"),
                              F.md5(S.str_remove_all("text", "[0-9]+")).alias("gone"))


@query("str_replace_missing", "SELECT l_orderkey, COALESCE(CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END, 'NA') AS flag FROM lineitem")
def str_replace_missing(t):
    return t.lineitem.select("l_orderkey", S.str_replace_na(F.when(F.col("l_linenumber") != 3, F.col("l_returnflag"))).alias("flag"))


@query("str_split_pieces", """SELECT p_partkey, len(string_split(p_name, ' ')) AS n, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, length(p_name) AS chars FROM part""")
def str_split_pieces(t):
    a, b = S.str_split_fixed("p_name", " ", 2)
    return t.part.select("p_partkey", F.size(S.str_split("p_name", " ")).cast("bigint").alias("n"), a.alias("a"), b.alias("b"), F.size(S.str_split("p_name", "")).cast("bigint").alias("chars"))


@query("word_at_boundaries", r"""SELECT doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}_'']+')) AS n FROM documents""")
def word_at_boundaries(t):
    return t.documents.select("doc_id", F.size(S.words_of("text")).cast("bigint").alias("n"))


@query("nth_word", """SELECT doc_id, split_part(text, ' ', 2) AS w FROM documents WHERE len(string_split(text, ' ')) >= 2""")
def nth_word(t):
    return t.documents.select("doc_id", S.word("text", 2).alias("w")).where("w IS NOT NULL")


@query("glue_template", """SELECT c_name || ' (' || c_mktsegment || ') owes ' || printf('%.2f', c_acctbal) AS line FROM customer""")
def glue_template(t):
    return t.customer.select(S.glue("{c_name} ({c_mktsegment}) owes {c_acctbal:.2f}").alias("line"))


@query("pattern_modes", """SELECT doc_id, contains(text, 'the') AS literal, contains(lower(text), 'the') AS any_case, regexp_matches(text, '(?i)\\bthe\\b') AS word FROM documents""".replace("\\\\", "\\"))
def pattern_modes(t):
    return t.documents.select("doc_id", S.str_detect("text", "the", "fixed").alias("literal"), S.str_detect("text", "the", "fixed", True).alias("any_case"),
                              S.str_detect("text", r"\bthe\b", ignore_case=True).alias("word"))


@query("pattern_collation")
def pattern_collation(t):
    return t.documents.select("doc_id", S.str_detect("text", "éa", "coll").alias("same"), S.str_detect("text", "ÉA", "coll", True, "fr").alias("any_case"))


@query("text_encoding", "SELECT doc_id, md5(text) AS h, TRUE AS ok FROM documents")
def text_encoding(t):
    raw = F.encode("text", "UTF-16")
    return t.documents.select("doc_id", F.md5(S.str_conv(raw, "UTF-16")).alias("h"), S.valid_utf8("text").alias("ok"))


@query("unicode_forms", "SELECT doc_id, md5(nfc_normalize(text)) AS nfc FROM documents")
def unicode_forms(t):
    return t.documents.select("doc_id", F.md5(S.normalize("text")).alias("nfc"))


@query("accents_off", "SELECT doc_id, md5(replace(strip_accents(text), 'ß', 'ss')) AS plain FROM documents")
def accents_off(t):
    return t.documents.select("doc_id", F.md5(S.asciify("text")).alias("plain"))


@query("any_case_values", """SELECT p_partkey, replace(p_name, ' ', '_') AS snake, upper(replace(p_name, ' ', '_')) AS caps, array_to_string(list_transform(string_split(p_name, ' '), lambda w : upper(substr(w, 1, 1)) || substr(w, 2)), '') AS camel FROM part""")
def any_case_values(t):
    return t.part.select("p_partkey", S.to_any_case("p_name").alias("snake"), S.to_any_case("p_name", "all_caps").alias("caps"), S.to_any_case("p_name", "big_camel").alias("camel"))


@query("ordinal_numbers", """SELECT l_partkey, l_partkey || CASE WHEN l_partkey % 100 IN (11, 12, 13) THEN 'th' WHEN l_partkey % 10 = 1 THEN 'st' WHEN l_partkey % 10 = 2 THEN 'nd' WHEN l_partkey % 10 = 3 THEN 'rd' ELSE 'th' END AS en,
l_partkey || CASE WHEN l_partkey % 10 IN (1, 2) AND l_partkey % 100 NOT IN (11, 12) THEN ':a' ELSE ':e' END AS sv FROM lineitem""")
def ordinal_numbers(t):
    return t.lineitem.select("l_partkey", S.to_ordinal("l_partkey").alias("en"), S.to_ordinal("l_partkey", "sv").alias("sv"))


@query("number_formats", """SELECT c_custkey, format('{:,}', CAST(ROUND(c_acctbal) AS BIGINT)) AS comma, CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END || '$' || format('{:,.2f}', ABS(c_acctbal)) AS dollar,
printf('%.5e', c_acctbal) AS sci, CASE WHEN ABS(c_acctbal) >= 1024 THEN printf('%.1f kB', c_acctbal / 1024) ELSE printf('%.0f B', c_acctbal) END AS bytes FROM customer""")
def number_formats(t):
    c = "c_acctbal"
    return t.customer.select("c_custkey", S.fmt_comma(F.round(c).cast("bigint")).alias("comma"), S.fmt_dollar(c).alias("dollar"), S.fmt_scientific(c, 5).alias("sci"), S.fmt_bytes(c).alias("bytes"))


@query("duration_text", """SELECT event_id, CASE WHEN ms < 1000 THEN ms || 'ms' ELSE concat_ws(' ', CASE WHEN ms // 86400000 > 0 THEN (ms // 86400000) || 'd' END, CASE WHEN ms // 3600000 % 24 > 0 THEN (ms // 3600000 % 24) || 'h' END,
CASE WHEN ms // 60000 % 60 > 0 THEN (ms // 60000 % 60) || 'm' END, CASE WHEN ms // 1000 % 60 > 0 THEN (ms // 1000 % 60) || 's' END) END AS d FROM (SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1000 AS ms FROM events)""")
def duration_text(t):
    ms = F.unix_millis(F.col("ts").cast("timestamp")) - F.unix_millis(F.lit("2024-01-01").cast("timestamp"))
    return t.events.select("event_id", S.pretty_ms(ms).alias("d"))


@query("time_ago_text", """SELECT event_id, CASE WHEN s < 10 THEN 'moments ago' WHEN s < 45 THEN 'less than a minute ago' WHEN s < 90 THEN 'about a minute ago'
WHEN s < 2700 THEN CAST(ROUND(s / 60.0) AS INT) || ' minutes ago' WHEN s < 5400 THEN 'about an hour ago' WHEN s < 86400 THEN CAST(ROUND(s / 3600.0) AS INT) || ' hours ago'
WHEN s < 151200 THEN 'a day ago' WHEN s < 2592000 THEN CAST(ROUND(s / 86400.0) AS INT) || ' days ago' ELSE 'about a month ago' END AS ago
FROM (SELECT event_id, CAST(epoch(TIMESTAMP '2024-01-31') AS BIGINT) - CAST(FLOOR(epoch(ts)) AS BIGINT) AS s FROM events)""")
def time_ago_text(t):
    return t.events.select("event_id", S.time_ago("ts", F.lit("2024-01-31").cast("timestamp")).alias("ago"))


@query("abbreviations", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w : upper(substr(w, 1, 1))), '') AS a FROM part")
def abbreviations(t):
    return t.part.select("p_partkey", S.abbrev("p_name").alias("a"))


@query("base64_and_url", "SELECT page_id, base64(encode(url)) AS b64, url AS back, url_encode(url) AS enc FROM pages")
def base64_and_url(t):
    enc = S.b64_encode("url")
    return t.pages.select("page_id", enc.alias("b64"), S.url_decode(S.url_encode(S.b64_decode(enc))).alias("back"), S.url_encode("url").alias("enc"))


@query("hashes", "SELECT c_custkey, md5(c_name) AS md5, sha1(c_name) AS sha1, sha256(c_name) AS sha256, sha256(c_mktsegment || chr(31) || c_name) AS two FROM customer")
def hashes(t):
    h = lambda cols, a: S.hash_cols(t.customer, cols, a).alias(a if len(cols) == 1 else "two")
    return t.customer.select("c_custkey", h(["c_name"], "md5"), h(["c_name"], "sha1"), h(["c_name"], "sha256"), h(["c_mktsegment", "c_name"], "sha256"))


@query("keyed_hashes")
def keyed_hashes(t):
    return t.customer.select("c_custkey", S.hash_cols(t.customer, ["c_name", "c_acctbal"], key="a key").alias("h"))


@query("encrypted_column", "SELECT c_custkey, c_name AS back, 16 * ((length(c_name) + 16) // 16) + 16 AS n_bytes FROM customer")
def encrypted_column(t):
    key = "0123456789abcdef"
    enc = S.aes_encrypt("c_name", key)
    return t.customer.select("c_custkey", S.aes_decrypt(enc, key).alias("back"), F.length(F.unbase64(enc)).cast("bigint").alias("n_bytes"))
