"""Queries of the text, language, date, amount, encoding and deduplication operators, with their SQL."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from staylens.functions import dates as D
from staylens.functions import language as L
from staylens.functions import lexicons
from staylens.functions import money as M
from staylens.functions import text as T
from staylens.functions.binding import let
from staylens.operators import profiles as P
from staylens.operators import quantiles as Q
from staylens.operators import reviews as R
from staylens.operators import segmentation as G
from staylens.plans.adapter import comments, comments_sql, on_reviews, reviews, table
from staylens.sources.spread import spread
from staylens.storage import written

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(words) -> str:
    return "[" + ", ".join(quoted(w) for w in words) + "]"


EMOJI = r"[!''-?D_\x{24C2}-\x{10FFFF}]+"
STRIPPED = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
NO_EMOJI = STRIPPED.format(f"regexp_replace(coalesce(text, ''), '{EMOJI}', '', 'g')")
#: Words of a text alone, one space between them.
WORDS = r"trim(regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}_]+', ' ', 'g'))"


def words_only(c):
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}_]+", " "))


def docs(spark, d, *more: str):
    return spread(table(spark, d, "documents").select("doc_id", "text", *more))


@query("score_filter_funnel", on_reviews("SELECT count(*) AS total, count(*) FILTER (score >= 5) AS kept, count(*) FILTER (score < 5) AS low, count(*) FILTER (score IS NULL) AS unscored FROM reviews"))
def score_filter_funnel(spark, d):
    return R.score_funnel(reviews(spark, d))


@query("emoji_strip", f"SELECT doc_id, md5({NO_EMOJI}) AS digest FROM documents")
def emoji_strip(spark, d):
    return docs(spark, d).select("doc_id", F.md5(T.remove_emoji(F.col("text"))).alias("digest"))


@query("emoji_count", f"SELECT lang, count(*) FILTER (regexp_matches(text, '{EMOJI}')) AS n FROM documents GROUP BY 1")
def emoji_count(spark, d):
    return docs(spark, d, "lang").groupBy("lang").agg(F.count_if(T.contains_emoji(F.col("text"))).alias("n"))


@query(
    "char_collapse",
    "SELECT doc_id, md5(array_to_string(list_filter(c, lambda x, i: i = 1 OR x <> c[i - 1] OR x = chr(10)), '')) AS digest FROM (SELECT doc_id, string_split(text, '') AS c FROM documents)",
)
def char_collapse(spark, d):
    return docs(spark, d).select("doc_id", F.md5(T.collapse_chars(F.col("text"))).alias("digest"))


COLLAPSED = "array_to_string(list_filter(w, lambda x, i: i = 1 OR lower(x) <> lower(w[i - 1])), ' ')"


@query("word_collapse", f"SELECT doc_id, md5({COLLAPSED}) AS digest FROM (SELECT doc_id, string_split({WORDS}, ' ') AS w FROM documents)")
def word_collapse(spark, d):
    return docs(spark, d).select("doc_id", F.md5(T.collapse_words(words_only(F.col("text")))).alias("digest"))


@query(
    "char_dominance",
    """WITH c AS (SELECT doc_id, x, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, '')) AS x FROM documents) WHERE x <> '' GROUP BY doc_id, x), m AS (SELECT doc_id, max(n) AS n FROM c GROUP BY doc_id)
SELECT doc_id, coalesce(length(text) >= 5 AND m.n > 0.7 * length(text), false) AS dominated FROM documents LEFT JOIN m USING (doc_id)""",
)
def char_dominance(spark, d):
    return docs(spark, d).select("doc_id", T.dominated_by_char(F.col("text")).alias("dominated"))


@query(
    "empty_filter",
    on_reviews("SELECT count(*) AS n FROM reviews WHERE NOT ((positive_comment IS NULL OR length(trim(positive_comment)) < 5) AND (negative_comment IS NULL OR length(trim(negative_comment)) < 5))"),
)
def empty_filter(spark, d):
    return R.drop_empty(reviews(spark, d), "positive_comment", "negative_comment").agg(F.count(F.lit(1)).alias("n"))


NORMAL = STRIPPED.format(
    rf"regexp_replace(lower(regexp_replace({STRIPPED.format(f'''regexp_replace(nfc_normalize(text), '{EMOJI}', '', 'g')''')}, '[^\p{{L}}\p{{N}}_\s.,;:?!]', ' ', 'g')), '\s+', ' ', 'g')"
)


@query("normalize_text", rf"SELECT doc_id, md5(regexp_replace({NORMAL}, '^\s*-\s*', '')) AS digest FROM documents")
def normalize_text(spark, d):
    return T.nfc(docs(spark, d).select("doc_id", "text"), "text").select("doc_id", F.md5(T.normalize(F.col("text"))).alias("digest"))


#: A mark on both sides of each run of word characters, twice, so that two keys that meet at a boundary find one each.
MARKED = r"regexp_replace({0}, '([\p{{L}}\p{{N}}_]+)', chr(1) || chr(1) || '\1' || chr(1) || chr(1), 'g')"


def marked(key: str) -> str:
    """A key as MARKED text has it, one mark at either end, as a pattern."""
    parts = re.findall(r"\w+|[^\w]+", key)
    inner = "".join(f"\x01\x01{p}\x01\x01" if re.match(r"\w", p) else re.sub(r"([^\w ])", r"\\\1", p) for p in parts)
    inner = inner.removeprefix("\x01") if re.match(r"\w", parts[0]) else "\x01" + inner
    return inner.removesuffix("\x01") if re.match(r"\w", parts[-1]) else inner + "\x01"


def found_keys(keys, text: str = "text") -> str:
    """SQL of (doc_id, gaps, hits): a text split at the keys, longest first, and the keys found."""
    pattern = quoted("(?i)(?:" + "|".join(marked(k) for k in sorted(keys, key=len, reverse=True)) + ")")
    return f"(SELECT doc_id, string_split_regex(x, {pattern}) AS gaps, regexp_extract_all(x, {pattern}) AS hits FROM (SELECT doc_id, {MARKED.format(text)} AS x FROM documents))"


WRITTEN_OUT = """CASE WHEN upper(h) = h AND lower(h) <> h THEN upper(v) WHEN upper(h[1]) = h[1] AND lower(h[1]) <> h[1] THEN upper(v[1]) || lower(v[2:]) ELSE v END"""


def mapped(mapping: dict[str, str], text: str = "text") -> str:
    """SQL of (doc_id, mapped, n) with the keys of a mapping written out, whatever their number of words."""
    entries = {k.lower(): v for k, v in mapping.items()}
    return f"""(WITH k AS (SELECT map_from_entries(list_zip({sql_list(entries)}, {sql_list(entries.values())})) AS m),
f AS (SELECT doc_id, gaps, list_transform(hits, lambda h: replace(h, chr(1), '')) AS hits FROM {found_keys(mapping, text)}),
v AS (SELECT doc_id, gaps, list_transform(hits, lambda h: struct_pack(h := h, v := coalesce(m[lower(h)], h))) AS hits FROM f, k)
SELECT doc_id, len(hits)::BIGINT AS n, replace(array_to_string(list_transform(list_zip(gaps, hits), lambda p: p[1] || CASE WHEN p[2] IS NULL THEN '' ELSE
  {WRITTEN_OUT.replace("h[1]", "p[2].h[1]").replace("(h)", "(p[2].h)").replace("= h ", "= p[2].h ").replace("<> h ", "<> p[2].h ").replace("(v", "(p[2].v").replace("ELSE v", "ELSE p[2].v")} END), ''), chr(1), '') AS mapped FROM v)"""


@query("text_mapping", f"SELECT doc_id, md5(mapped) AS digest, n FROM {mapped(lexicons.ABBREVIATIONS)}")
def text_mapping(spark, d):
    return docs(spark, d).select("doc_id", let(T.replaced(F.col("text")), lambda r: F.struct(F.md5(r["text"]).alias("digest"), r["n"].alias("n"))).alias("r")).select("doc_id", "r.digest", "r.n")


@query("mapping_count", f"SELECT doc_id, len(hits)::BIGINT AS n FROM {found_keys(lexicons.ABBREVIATIONS)}")
def mapping_count(spark, d):
    return docs(spark, d).select("doc_id", T.count_replacements(F.col("text")).alias("n"))


PHONE = "('0' || ['3','5','6','9'][(o_orderkey % 4 + 1)::INT] || lpad((o_orderkey * 7919 % 100000000)::VARCHAR, 8, '0'))"


def phone(key="o_orderkey"):
    k = F.col(key)
    return F.concat(F.lit("0"), F.element_at(F.array(*map(F.lit, "3569")), (k % 4 + 1).cast("int")), F.lpad((k * 7919 % 100000000).cast("string"), 8, "0"))


@query("phone_flag", f"SELECT o_orderkey, regexp_full_match({PHONE}, '0[35789][0-9]{{8}}') AS is_phone FROM orders")
def phone_flag(spark, d):
    return table(spark, d, "orders").select("o_orderkey", M.is_phone(phone()).alias("is_phone"))


@query("phone_remove", f"SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'call now' ELSE 'order ' || o_orderkey % 100 || ' now' END AS left_text FROM orders")
def phone_remove(spark, d):
    odd = F.col("o_orderkey") % 2
    text = F.when(odd == 0, F.concat(F.lit("call "), phone(), F.lit(" now"))).otherwise(F.concat(F.lit("order "), F.col("o_orderkey") % 100, F.lit("  now")))
    return table(spark, d, "orders").select("o_orderkey", M.remove_phones(text).alias("left_text"))


DIGITS = sql_list(M.DIGITS)


def _group_sql(n: str) -> str:
    one = f"({n} % 10)::INT"
    return (
        f"concat_ws(' ', CASE WHEN {n} >= 100 THEN d[({n} // 100 + 1)::INT] || ' trăm' END, CASE WHEN {n} // 10 % 10 >= 2 THEN d[({n} // 10 % 10 + 1)::INT] || ' mươi' WHEN {n} // 10 % 10 = 1 THEN 'mười' END, "
        f"CASE WHEN {one} = 0 THEN NULL WHEN {one} = 1 AND {n} // 10 % 10 >= 2 THEN 'mốt' WHEN {one} = 5 AND {n} // 10 % 10 >= 2 THEN 'lăm' ELSE d[{one} + 1] END)"
    )


def _number_sql(n: str) -> str:
    m, t, r = f"({n} // 1000000)", f"({n} // 1000 % 1000)", f"({n} % 1000)"
    return (
        f"CASE WHEN {n} = 0 THEN d[1] ELSE concat_ws(' ', CASE WHEN {m} > 0 THEN {_group_sql(m)} || ' triệu' END, CASE WHEN {t} > 0 THEN {_group_sql(t)} || ' nghìn' END, "
        f"CASE WHEN {r} = 0 THEN NULL WHEN {r} < 100 AND {n} >= 1000 THEN 'lẻ ' || {_group_sql(r)} ELSE {_group_sql(r)} END) END"
    )


@query("number_words", f"SELECT o_orderkey, {_number_sql('n')} AS words FROM (SELECT o_orderkey, (o_orderkey * 7919) % 1000000000 AS n, {DIGITS} AS d FROM orders)")
def number_words(spark, d):
    return table(spark, d, "orders").select("o_orderkey", M.number_words(F.col("o_orderkey") * 7919 % 1_000_000_000).alias("words"))


@query(
    "money_read",
    f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN '' ELSE {_number_sql('n')} || ' đồng' END AS words FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 1000) * 1000 ELSE (o_orderkey % 500) * 1000000 END AS n, {DIGITS} AS d FROM orders)",
)
def money_read(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, F.concat(k % 1000, F.lit(" k"))).when(k % 3 == 1, F.concat(k % 500, F.lit("M"))).otherwise(F.concat(F.lit("giá "), k))
    return table(spark, d, "orders").select("o_orderkey", M.money_words(text).alias("words"))


@query("stay_normalize", on_reviews("SELECT stay_duration AS stay, count(*) AS n FROM reviews GROUP BY 1"))
def stay_normalize(spark, d):
    noisy = reviews(spark, d).select(T.stay_duration(F.concat("stay_duration", F.lit(" · tháng 10 2023"))).alias("stay"))
    return noisy.groupBy("stay").agg(F.count(F.lit(1)).alias("n"))


@query("month_parse", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) * 4 AS n FROM orders WHERE year(o_orderdate) >= 2000 GROUP BY 1")
def month_parse(spark, d):
    shapes = F.array(*[F.date_format("o_orderdate", f) for f in ("dd/MM/yyyy", "MM/yyyy", "yyyy-MM", "d MMMM yyyy")])
    found = table(spark, d, "orders").select(F.explode(shapes).alias("x")).select(D.month_year(F.col("x")).alias("month"))
    return found.filter("month IS NOT NULL").groupBy("month").agg(F.count(F.lit(1)).alias("n"))


@query("date_vi", "SELECT strftime(o_orderdate, '%d/%m/%Y') AS day, count(*) AS n FROM orders GROUP BY 1")
def date_vi(spark, d):
    text = F.concat(F.lit("Đánh giá ngày "), F.dayofmonth("o_orderdate"), F.lit(" tháng "), F.month("o_orderdate"), F.lit(" "), F.year("o_orderdate"))
    return table(spark, d, "orders").select(D.vietnamese_date(text).alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


TOKENS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+')"


@query(
    "foreign_ratio",
    f"SELECT doc_id, h > 0 AND h > n * 0.2 AS foreign_text FROM (SELECT doc_id, len(t) AS n, len(list_filter(t, lambda w: list_contains({sql_list(dict.fromkeys(lexicons.FOREIGN_TOKENS))}, w))) AS h FROM (SELECT doc_id, {TOKENS} AS t FROM documents))",
)
def foreign_ratio(spark, d):
    return docs(spark, d).select("doc_id", L.mostly_foreign_tokens(F.col("text")).alias("foreign_text"))


def _hits(words) -> str:
    return f"len(list_filter({sql_list(words)}, lambda w: contains(l, w)))"


def _letters(letters: str) -> str:
    return f"length(regexp_replace(l, '[^{''.join(sorted(set(letters.lower())))}]', '', 'g'))"


@query("foreign_indicator", f"SELECT doc_id, {_hits(lexicons.FOREIGN_INDICATORS)} > 0 AS found FROM (SELECT doc_id, lower(text) AS l FROM documents)")
def foreign_indicator(spark, d):
    return docs(spark, d).select("doc_id", L.has_foreign_indicator(F.col("text")).alias("found"))


_FEW = "vi < 4 AND ex <= 2"
def cascade(source: str = "documents", local: str = "false") -> str:
    """SQL of (doc_id, rule) of a table (doc_id, text); local says of a row of c whether its guest is of the country."""
    return f"""WITH b AS (SELECT *, {STRIPPED.format("coalesce(text, 'None')")} AS s FROM {source}), l AS (SELECT *, lower(s) AS l FROM b),
c AS (SELECT *, length(s) AS chars, length({STRIPPED.format(rf"regexp_replace(regexp_replace(s, '{EMOJI}', '', 'g'), '[^\p{{L}}\p{{N}}_\s]', '', 'g')")}) AS core,
{_letters(lexicons.GERMAN_LETTERS)} AS ge, {_letters(lexicons.SLAVIC_LETTERS)} AS sl, {_letters(lexicons.ROMANIAN_LETTERS)} AS ro, {_hits(lexicons.FRENCH)} AS fr,
{", ".join(f"{_hits(words)} AS {name}" for name, words, _ in L.ENOUGH)},
{_hits(lexicons.VIETNAMESE)} AS vi, {_letters(lexicons.EXCLUSIVE_LETTERS)} AS ex, {_letters(lexicons.TONE_LETTERS)} AS tone, {_letters(lexicons.VIETNAMESE_LETTERS)} AS letters,
length(replace(replace(s, ' ', ''), '-', '')) AS dense, {_hits(lexicons.FOREIGN_INDICATORS)} > 0 AS ind FROM l)
SELECT doc_id, CASE WHEN chars < 15 THEN 1 WHEN core < 15 THEN 2 WHEN ge >= 2 AND {_FEW} THEN 3 WHEN sl >= 3 AND {_FEW} THEN 4 WHEN ro >= 2 AND {_FEW} THEN 5 WHEN fr >= 5 AND {_FEW} THEN 6
{" ".join(f"WHEN {name} >= {n} THEN {7 + i}" for i, (name, _, n) in enumerate(L.ENOUGH))}
WHEN ind AND ex <= 1 AND vi < 3 THEN 16 WHEN ex >= 2 THEN 17 WHEN ex >= 1 AND (vi >= 2 OR tone >= 1) THEN 18 WHEN tone >= 3 THEN 19 WHEN vi >= 15 THEN 20
WHEN letters >= 12 OR (dense > 0 AND letters > dense * 0.35) THEN 21 WHEN ({local}) AND (ex >= 1 OR letters >= 8 OR vi >= 3) THEN 22 ELSE 24 END AS rule FROM c"""


CASCADE = cascade()


@query("vietnamese_rule", CASCADE)
def vietnamese_rule(spark, d):
    return docs(spark, d).select("doc_id", L.language_rule(F.col("text")).alias("rule"))


@query("vietnamese_flag", f"SELECT doc_id, rule BETWEEN 17 AND 22 AS is_vietnamese FROM ({CASCADE})")
def vietnamese_flag(spark, d):
    return docs(spark, d).select("doc_id", L.is_vietnamese(F.col("text")).alias("is_vietnamese"))


@query("comment_language_rule", cascade(f"({comments_sql()})", "contains(lower(country), 'vietnam')"))
def comment_language_rule(spark, d):
    return comments(spark, d).select("doc_id", L.language_rule(F.col("text"), F.col("country")).alias("rule"))


@query(
    "combined_text",
    on_reviews("SELECT review_id, concat_ws(' ', nullif(trim(room_type), ''), nullif(trim(positive_comment), ''), nullif(trim(negative_comment), '')) AS combined, len(string_split(concat_ws(' ', nullif(trim(room_type), ''), nullif(trim(positive_comment), ''), nullif(trim(negative_comment), '')), ' '))::BIGINT AS words FROM reviews WHERE coalesce(room_type, positive_comment, negative_comment) IS NOT NULL"),
)
def combined_text(spark, d):
    joined = T.combine(F.col("room_type"), F.col("positive_comment"), F.col("negative_comment"))
    found = reviews(spark, d).select("review_id", joined.alias("combined")).filter("combined IS NOT NULL")
    return found.withColumn("words", T.word_count(F.col("combined")))


@query("row_number_stt", on_reviews("SELECT review_id, row_number() OVER (ORDER BY review_name, month_year, review_id) AS stt FROM reviews"))
def row_number_stt(spark, d):
    df = reviews(spark, d).select("review_id", "review_name", "month_year")
    return R.number_rows(df, "review_name", "month_year", "review_id").select("review_id", F.col("stt").cast("long").alias("stt"))


NEAR = """, o AS (SELECT *, strptime(month_year || '-01', '%Y-%m-%d')::DATE AS m, lower(trim(positive_comment)) AS t FROM reviews),
p AS (SELECT *, {0}(t) OVER w AS bt, {0}(m) OVER w AS bm FROM o WINDOW w AS (PARTITION BY review_name ORDER BY m, review_id, positive_comment NULLS FIRST))
SELECT review_id FROM p WHERE NOT coalesce(t = bt AND abs(m - bm) <= 30, false)"""


@query("near_dup_lag", on_reviews(NEAR.format("lag")))
def near_dup_lag(spark, d):
    df = reviews(spark, d).select("review_id", "review_name", "positive_comment", "month_year")
    return R.near_duplicates(df, "review_name", "positive_comment", "month_year", ("review_id", "positive_comment")).select("review_id")


@query("near_dup_keep_last", on_reviews(NEAR.format("lead")))
def near_dup_keep_last(spark, d):
    df = reviews(spark, d).select("review_id", "review_name", "positive_comment", "month_year")
    return R.near_duplicates(df, "review_name", "positive_comment", "month_year", ("review_id", "positive_comment"), keep="last").select("review_id")


@query("label_encode", on_reviews("SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS id, n FROM (SELECT coalesce(room_type, 'Unknown') AS label, count(*) AS n FROM reviews GROUP BY 1)"))
def label_encode(spark, d):
    df = reviews(spark, d)
    coded = R.encode(df, "room_type", R.label_codes(df, "room_type"), "id")
    return coded.groupBy(F.coalesce("room_type", F.lit("Unknown")).alias("label"), "id").agg(F.count(F.lit(1)).alias("n"))


STAY = "CASE WHEN review_id % 11 = 0 THEN 'x' || room_type ELSE stay_duration END"


@query(
    "stay_encode",
    on_reviews(
        f""", s AS (SELECT DISTINCT coalesce({STAY}, 'Unknown') AS label FROM reviews), n AS (SELECT label, TRY_CAST(regexp_extract(label, '(\\d+) đêm', 1) AS INT) AS n FROM s)
SELECT label, n::BIGINT AS id FROM n WHERE n IS NOT NULL UNION ALL
SELECT label, ((SELECT max(n) FROM n) + row_number() OVER (ORDER BY label))::BIGINT AS id FROM n WHERE n IS NULL"""
    ),
)
def stay_encode(spark, d):
    df = reviews(spark, d).withColumn("stay", F.when(F.col("review_id") % 11 == 0, F.concat(F.lit("x"), "room_type")).otherwise(F.col("stay_duration")))
    return R.stay_codes(df, "stay")


#: Terms of several words: those that abbreviations are written out as, and some that the tables' languages have.
TERMS = tuple(dict.fromkeys([v for v in lexicons.ABBREVIATIONS.values() if " " in v] + ["of the", "in the", "khách sạn", "de la", "in der", "für die"]))


@query("segment_words", f"SELECT doc_id, md5(mapped) AS digest, n FROM {mapped({t: t.replace(' ', '_') for t in TERMS})}")
def segment_words(spark, d):
    joined = T.segmented(F.col("text"), TERMS)
    return docs(spark, d).select("doc_id", let(joined, lambda r: F.struct(F.md5(r["text"]).alias("digest"), r["n"].alias("n"))).alias("r")).select("doc_id", "r.digest", "r.n")


@query(
    "vietnamese_simple",
    rf"""WITH b AS (SELECT doc_id, {STRIPPED.format("coalesce(text, '')")} AS s FROM documents), l AS (SELECT doc_id, s, lower(s) AS l FROM b),
c AS (SELECT doc_id, length(s) AS chars, length({STRIPPED.format(rf"regexp_replace(regexp_replace(s, '{EMOJI}', '', 'g'), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')")}) AS core, {_hits(lexicons.VIETNAMESE)} AS vi,
{_letters(lexicons.VIETNAMESE_LETTERS)} AS letters, length(replace(s, ' ', '')) AS dense, regexp_extract_all(l, '[\p{{L}}\p{{N}}_]+') AS t FROM l),
f AS (SELECT *, len(list_filter(t, lambda w: list_contains({sql_list(dict.fromkeys(lexicons.FOREIGN_TOKENS))}, w))) AS h FROM c)
SELECT doc_id, chars >= 15 AND NOT (h > 0 AND h > len(t) * 0.2) AND core >= 15 AND (vi >= 2 OR letters >= 6 OR (dense > 0 AND letters > dense * 0.15)) AS is_vietnamese FROM f""",
)
def vietnamese_simple(spark, d):
    return docs(spark, d).select("doc_id", L.is_vietnamese_simple(F.col("text")).alias("is_vietnamese"))


@query("repeat_changes", f"SELECT count(*) FILTER ({COLLAPSED} <> x) AS changed, count(*) AS total FROM (SELECT {WORDS} AS x, string_split({WORDS}, ' ') AS w FROM documents)")
def repeat_changes(spark, d):
    found = R.changed_rows(docs(spark, d).select(words_only(F.col("text")).alias("text")), "text", T.collapse_words)
    return found.agg(F.count_if("changed").alias("changed"), F.count(F.lit(1)).alias("total"))


def all_texts(spark, d):
    """(doc_id, text) of documents and of comments."""
    return docs(spark, d).unionByName(spread(comments(spark, d).select("doc_id", "text")))


ALL_TEXTS = f"all_texts AS (SELECT doc_id, text FROM documents UNION ALL SELECT doc_id, text FROM ({comments_sql()}))"
#: The lattice's paths as states of the last three places of every run of words: cost, text and joined pieces up to each.
LATTICE = f"""WITH RECURSIVE {ALL_TEXTS},
tok AS (SELECT doc_id, unnest(t) AS tok, generate_subscripts(t, 1) AS i FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{G.TOKEN}') AS t FROM all_texts)),
kinds AS (SELECT *, regexp_matches(tok, '^[\\p{{L}}\\p{{N}}_]') AS is_word FROM tok),
runs AS (SELECT *, sum((NOT is_word)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM kinds),
placed AS (SELECT doc_id, run, i, tok, lower(tok) AS w, row_number() OVER r AS j, lag(tok) OVER r AS tok2, lag(tok, 2) OVER r AS tok3 FROM runs WHERE is_word WINDOW r AS (PARTITION BY doc_id, run ORDER BY i)),
grams AS (SELECT *, lower(tok2) || ' ' || w AS w2, lower(tok3) || ' ' || lower(tok2) || ' ' || w AS w3 FROM placed),
counted AS (SELECT term, words, count(*) AS n FROM (SELECT w AS term, 1 AS words FROM grams UNION ALL SELECT w2, 2 FROM grams WHERE w2 IS NOT NULL UNION ALL SELECT w3, 3 FROM grams WHERE w3 IS NOT NULL) GROUP BY ALL),
terms AS (SELECT term, round((ln((SELECT sum(n) FROM counted WHERE words = 1)) - ln(n)) * 1000000)::BIGINT + {G.PENALTY} * (words - 1) AS cost FROM counted WHERE words = 1 OR n >= {G.LEAST}
  QUALIFY row_number() OVER (PARTITION BY words ORDER BY n DESC, term) <= CASE WHEN words = 1 THEN {G.MAX_WORDS} ELSE {G.MAX_TERMS} END),
edges AS (SELECT g.doc_id, run, j, i, tok, tok2 || '_' || tok AS t2, tok3 || '_' || tok2 || '_' || tok AS t3, coalesce(a.cost, (SELECT max(cost) FROM terms WHERE NOT contains(term, ' '))) AS k1, b.cost AS k2, c.cost AS k3
  FROM grams g LEFT JOIN terms a ON a.term = w LEFT JOIN terms b ON b.term = w2 LEFT JOIN terms c ON c.term = w3),
path AS (SELECT DISTINCT doc_id, run, 0 AS j, 0::BIGINT AS c0, NULL::BIGINT AS c1, NULL::BIGINT AS c2, '' AS s0, '' AS s1, '' AS s2 FROM edges
  UNION ALL SELECT doc_id, run, j, least(x1, x2, x3), c0, c1, CASE WHEN x1 <= least(x2, x3) THEN s0 || ' ' || tok WHEN x2 <= x3 THEN s1 || ' ' || t2 ELSE s2 || ' ' || t3 END, s0, s1
  FROM (SELECT p.*, e.j AS nj, tok, t2, t3, c0 + k1 AS x1, coalesce(c1 + k2, 1e18::BIGINT) AS x2, coalesce(c2 + k3, 1e18::BIGINT) AS x3 FROM path p JOIN edges e ON e.doc_id = p.doc_id AND e.run = p.run AND e.j = p.j + 1) AS n(doc_id, run, oj, c0, c1, c2, s0, s1, s2, j, tok, t2, t3, x1, x2, x3)),
whole AS (SELECT doc_id, run, arg_max(s0, j)[2:] AS s FROM path GROUP BY doc_id, run),
pieces AS (SELECT doc_id, run, 1 AS place, s FROM whole UNION ALL SELECT doc_id, run, 0, tok FROM runs WHERE NOT is_word)
SELECT doc_id, md5(coalesce(string_agg(s, ' ' ORDER BY run, place), '')) AS digest, coalesce(sum(len(string_split(s, ' '))), 0)::BIGINT AS pieces FROM all_texts LEFT JOIN pieces USING (doc_id) GROUP BY doc_id"""


@query("segment_lattice", LATTICE)
def segment_lattice(spark, d):
    texts = all_texts(spark, d)
    found = G.segment_lattice(texts, "text", G.learn_terms(texts, "text"))
    pieces = F.when(F.col("word_segmented") == "", 0).otherwise(F.size(F.split("word_segmented", " ")))
    return found.select("doc_id", F.md5("word_segmented").alias("digest"), pieces.cast("long").alias("pieces"))


#: Documents that a profile is fitted on; the others are held out.
FITTED = "doc_id % 5 <> 0"
_GRAMS = "list_transform(range(1, len(x) - 1), lambda i: x[i] || x[i + 1] || x[i + 2])"
_LETTERS = r"""string_split(' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}]+', ' ', 'g')) || ' ', '')"""
DETECTED = rf"""WITH {ALL_TEXTS}, rules AS ({cascade(f"({comments_sql()})", "contains(lower(country), 'vietnam')")}),
labelled AS (SELECT text, lang FROM documents WHERE {FITTED} AND lang IS NOT NULL UNION ALL
  SELECT text, 'vi' FROM ({comments_sql()}) JOIN rules USING (doc_id) WHERE {FITTED} AND rule BETWEEN 17 AND 22),
g AS (SELECT lang, unnest({_GRAMS}) AS gram FROM (SELECT lang, {_LETTERS} AS x FROM labelled)), c AS (SELECT lang, gram, count(*) AS n FROM g GROUP BY ALL),
t AS (SELECT lang, sum(n) AS total, round((ln(0.5) - ln(sum(n))) * 1000000)::BIGINT AS base FROM c GROUP BY lang),
p AS (SELECT lang, gram, round((ln(n + 0.5) - ln(0.5)) * 1000000)::BIGINT AS weight FROM c QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) <= {P.GRAMS}),
e AS (SELECT doc_id, {_GRAMS} AS gs FROM (SELECT doc_id, {_LETTERS} AS x FROM all_texts)), u AS (SELECT doc_id, gram, count(*) AS n FROM (SELECT doc_id, unnest(gs) AS gram FROM e) GROUP BY ALL),
w AS (SELECT doc_id, lang, sum(u.n * weight) AS w FROM u JOIN p USING (gram) GROUP BY ALL),
s AS (SELECT doc_id, lang, coalesce(w, 0) + len(gs) * base AS score FROM e CROSS JOIN t LEFT JOIN w USING (doc_id, lang) WHERE len(gs) > 0),
detected AS (SELECT doc_id, lang AS detected FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) = 1)"""


def detected_languages(spark, d):
    """(doc_id, detected) of all texts by profiles of documents and of comments that the rules take as Vietnamese."""
    said = written(spread(comments(spark, d).filter(FITTED).select("text", "country")), "said")  # else the rules run before the rows are dealt
    own = said.filter(L.is_vietnamese(F.col("text"), F.col("country"))).select("text", F.lit("vi").alias("lang"))
    profile = P.fit(docs(spark, d, "lang").filter(FITTED).select("text", "lang").unionByName(own), "text", "lang")
    return P.detect(all_texts(spark, d), "doc_id", "text", profile)


@query("detected_language", f"{DETECTED} SELECT doc_id, detected FROM detected")
def detected_language(spark, d):
    return detected_languages(spark, d)


@query(
    "vietnamese_outside",
    rf"""{DETECTED}, b AS (SELECT doc_id, {STRIPPED.format("coalesce(text, '')")} AS s FROM all_texts), l AS (SELECT doc_id, s, lower(s) AS l FROM b),
k AS (SELECT doc_id, length(s) AS chars, length({STRIPPED.format(rf"regexp_replace(regexp_replace(s, '{EMOJI}', '', 'g'), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')")}) AS core, {_hits(lexicons.VIETNAMESE)} AS vi,
{_letters(lexicons.VIETNAMESE_LETTERS)} AS letters, length(replace(s, ' ', '')) AS dense, regexp_extract_all(l, '[\p{{L}}\p{{N}}_]+') AS t FROM l),
f AS (SELECT *, len(list_filter(t, lambda w: list_contains({sql_list(dict.fromkeys(lexicons.FOREIGN_TOKENS))}, w))) AS h FROM k LEFT JOIN detected USING (doc_id))
SELECT doc_id, chars >= 15 AND NOT (h > 0 AND h > len(t) * 0.2) AND core >= 15 AND (vi >= 2 OR letters >= 6 OR (dense > 0 AND letters > dense * 0.15)
  OR (coalesce(detected = 'vi', false) AND letters > 0)) AS is_vietnamese FROM f""",
)
def vietnamese_outside(spark, d):
    found = all_texts(spark, d).join(detected_languages(spark, d), "doc_id", "left")
    return found.select("doc_id", L.is_vietnamese_simple(F.col("text"), None, F.col("detected")).alias("is_vietnamese"))


@query("rating_boxes", on_reviews("SELECT province, count(score) AS n, min(score) AS low, quantile_cont(score, 0.25) AS q1, median(score) AS median, quantile_cont(score, 0.75) AS q3, max(score) AS high FROM reviews WHERE score IS NOT NULL AND province IS NOT NULL GROUP BY 1"))
def rating_boxes(spark, d):
    return Q.boxes(written(reviews(spark, d).select("province", "score"), "scores"), "province", "score")


@query("price_quantiles", "SELECT l_returnflag, count(*) AS n, min(l_extendedprice) AS low, max(l_extendedprice) AS high, quantile_cont(l_extendedprice, 0.01) AS p1, quantile_cont(l_extendedprice, 0.5) AS p50, quantile_cont(l_extendedprice, 0.999) AS p999 FROM lineitem GROUP BY 1")
def price_quantiles(spark, d):
    found = Q.quantiles(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice", (0.01, 0.5, 0.999))
    return found.select("l_returnflag", "n", "low", "high", *[F.col("q")[i].alias(p) for i, p in enumerate(("p1", "p50", "p999"))])
