"""Queries of links, comparisons, reconciliation, pages, audit and the whole pipeline, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions import urls as U
from staylens.operators import audit as A
from staylens.operators import links as K
from staylens.plans import cleaning
from staylens.plans import text_queries as TQ
from staylens.plans.adapter import comments_sql, on_reviews, reviews, table
from staylens.sources import html as H
from staylens.storage import new_path
from staylens.streaming import reconciliation as SR
from staylens.streaming import windows as SW

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def links(spark, d):
    """(page_id, province, url) of the pages, a few shouted."""
    p = table(spark, d, "pages")
    url = F.when(F.col("page_id") % 10 == 0, F.concat(F.lit(" "), F.upper("url"))).otherwise(F.col("url"))
    return p.select("page_id", F.concat(F.lit("p"), F.col("page_id") % 7).alias("province"), url.alias("url"))


LINKS = "links AS (SELECT page_id, 'p' || page_id % 7 AS province, CASE WHEN page_id % 10 = 0 THEN ' ' || upper(url) ELSE url END AS url FROM pages)"


def _part(df, condition):
    return df.filter(condition).select("province", "url")


@query("links_union_distinct", f"WITH {LINKS} SELECT DISTINCT province, lower(trim(url)) AS url FROM links WHERE page_id % 3 = 0 OR page_id % 2 = 0")
def links_union_distinct(spark, d):
    all_links = links(spark, d)
    return K.union_distinct(_part(all_links, "page_id % 3 = 0"), _part(all_links, "page_id % 2 = 0"))


@query(
    "links_incremental",
    f"WITH {LINKS} SELECT DISTINCT province, url, NOT EXISTS (SELECT 1 FROM links o WHERE o.page_id % 3 = 0 AND o.province = l.province AND o.url = l.url) AS is_new FROM links l WHERE page_id % 3 = 0 OR page_id % 2 = 0",
)
def links_incremental(spark, d):
    all_links = links(spark, d)
    return K.incremental_union(_part(all_links, "page_id % 3 = 0"), _part(all_links, "page_id % 2 = 0"))


PARTS = {"links": "page_id % 5 <> 0", "success": "page_id % 3 = 0", "errors": "page_id % 4 = 1", "timeouts": "page_id % 7 = 2"}
STATE = f"""WITH {LINKS}, s AS (SELECT province, url, bool_or(page_id % 5 <> 0) AS listed, bool_or(page_id % 3 = 0) AS ok, bool_or(page_id % 4 = 1) AS error, bool_or(page_id % 7 = 2) AS late FROM links GROUP BY 1, 2)
SELECT province, url, type, list_position({{0}}, type) - 1 AS rank FROM (SELECT province, url, {{1}} AS type FROM s) WHERE type IS NOT NULL"""
CURRENT = "CASE WHEN error THEN 'Error' WHEN listed AND NOT ok AND NOT late THEN 'Missing' END"
SQL_NO_ORDER = "['Error']"
EARLIER = "CASE WHEN late AND (error OR (listed AND NOT ok)) THEN 'Timeout' WHEN error THEN 'Error' WHEN listed AND NOT ok THEN 'Missing' END"


def _reconcile(name: str, variant: str, order: str, case: str) -> None:
    def run(spark, d):
        all_links = links(spark, d)
        return K.reconcile(*[_part(all_links, c) for c in PARTS.values()], variant=variant)

    query(name, STATE.format(order, case))(run)


_reconcile("reconcile_current", "current", "['Error', 'Missing', 'Timeout']", CURRENT)
_reconcile("reconcile_older", "older", "['Timeout', 'Error', 'Missing']", EARLIER)
_reconcile("reconcile_middle", "middle", "['Error', 'Missing', 'Timeout']", EARLIER)


KINDS = dict(zip(PARTS, SR.KINDS, strict=True))


@query("reconcile_stream", f"SELECT province, url, type FROM ({STATE.format(SQL_NO_ORDER, CURRENT)})")
def reconcile_stream(spark, d):
    """What happened to the urls as a stream of files, two a batch; the changes that it emits lead to the state of all events."""
    path, out, store = new_path(spark, "events"), new_path(spark, "changes"), SR.STATE_STORE
    all_links = links(spark, d)
    seen = [all_links.filter(condition).select("province", "url", F.lit(KINDS[part]).alias("kind")) for part, condition in PARTS.items()]
    reduce(DataFrame.unionByName, seen).repartition(6).write.parquet(path)
    before = spark.conf.get(store[0], None)
    spark.conf.set(*store)
    try:
        events = spark.readStream.schema("province string, url string, kind string").option("maxFilesPerTrigger", 2).parquet(path)
        changes = SR.changes(events).writeStream.option("checkpointLocation", f"{out}-state").trigger(availableNow=True).format("parquet").start(out)
        changes.awaitTermination()
    finally:
        spark.conf.set(store[0], before) if before else spark.conf.unset(store[0])
    return SR.standing(spark.read.schema(SR.CHANGES).parquet(out))


def _names(spark, d):
    c = table(spark, d, "customer")
    name = F.when(F.col("c_custkey") % 9 == 0, F.upper("c_name")).otherwise(F.col("c_name"))
    left = c.filter("c_custkey % 3 <> 0").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("v"))
    right = c.filter("c_custkey % 2 = 0 OR c_custkey % 9 = 0").select(name.alias("name"), F.col("c_nationkey").alias("v"))
    return left, right


NAMES = """l AS (SELECT c_name AS name, lower(trim(c_name)) AS key, c_nationkey AS v FROM customer WHERE c_custkey % 3 <> 0),
r AS (SELECT name, lower(trim(name)) AS key, v FROM (SELECT CASE WHEN c_custkey % 9 = 0 THEN upper(c_name) ELSE c_name END AS name, c_nationkey AS v FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 9 = 0))"""


@query(
    "full_outer_compare",
    f"""WITH {NAMES}, a AS (SELECT * FROM l WHERE key IN (SELECT key FROM r)), b AS (SELECT * FROM r WHERE key IN (SELECT key FROM l))
SELECT coalesce(a.key, b.key) AS key, coalesce(a.name, b.name) AS name, a.v AS v_1, b.v AS v_2 FROM a FULL JOIN b ON a.key = b.key AND a.name = b.name""",
)
def full_outer_compare(spark, d):
    left, right = _names(spark, d)
    return K.compare_full(left, right, K.name_key(F.col("name")), "v")


@query("anti_both_ways", f"WITH {NAMES} SELECT DISTINCT name, 1 AS source FROM l WHERE name NOT IN (SELECT name FROM r) UNION ALL SELECT DISTINCT name, 2 FROM r WHERE name NOT IN (SELECT name FROM l)")
def anti_both_ways(spark, d):
    return K.only_in_one(*_names(spark, d), "name")


@query("semi_common", f"WITH {NAMES} SELECT name, v FROM l WHERE name IN (SELECT name FROM r)")
def semi_common(spark, d):
    return K.in_both(*_names(spark, d), "name")


@query("url_slug", "SELECT page_id, replace(split_part(regexp_extract(regexp_replace(url, '[?#].*$', ''), '[^/]*$'), '.', 1), '-', '_') || '.json' AS key FROM pages")
def url_slug(spark, d):
    return table(spark, d, "pages").select("page_id", U.page_key(F.col("url")).alias("key"))


@query("url_clean", "SELECT page_id, split_part(split_part(url, '?', 1), '#', 1) AS url FROM pages")
def url_clean(spark, d):
    return table(spark, d, "pages").select("page_id", U.clean(F.col("url"), "https://example.com").alias("url"))


@query("url_query_rewrite", "SELECT page_id, regexp_extract(url, '^[^?#]*') || '?ss=' || page_id || '&order=newest' AS url FROM pages")
def url_query_rewrite(spark, d):
    base = F.concat(F.regexp_extract("url", "^[^?#]*", 0), F.lit("?label=x&ss="), F.col("page_id"), F.lit("&order=old&checkin=1#top"))
    return table(spark, d, "pages").select("page_id", U.rewrite_query(base, "newest").alias("url"))


@query(
    "range_bucket",
    on_reviews(
        "SELECT hotel_name, n, CASE WHEN n <= 50 THEN '0-50' WHEN n <= 100 THEN '51-100' ELSE ((n - 1) // 100 * 100 + 1) || '-' || ((n - 1) // 100 * 100 + 100) END AS bucket FROM (SELECT hotel_name, count(*) AS n FROM reviews GROUP BY 1)"
    ),
)
def range_bucket(spark, d):
    found = reviews(spark, d).groupBy("hotel_name").agg(F.count(F.lit(1)).alias("n"))
    return found.withColumn("bucket", U.range_bucket(F.col("n")))


@query("collect_urls", f"WITH {LINKS} SELECT province, string_agg(url, chr(10) ORDER BY url) AS urls, count(*) AS n FROM links GROUP BY 1")
def collect_urls(spark, d):
    return K.urls_by_folder(links(spark, d), "province", "url")


@query("html_title", r"SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title FROM pages")
def html_title(spark, d):
    return table(spark, d, "pages").select("page_id", H.page_title(F.col("html")).alias("title"))


@query("property_count", "SELECT o_orderkey, o_orderkey % 5000 AS n FROM orders")
def property_count(spark, d):
    text = F.concat(F.lit("Hotels: "), F.format_number(F.col("o_orderkey") % 5000, 0), F.lit(" properties found"))
    return table(spark, d, "orders").select("o_orderkey", U.property_count(text).cast("long").alias("n"))


@query("json_props", "SELECT event_id, json_extract_string(props, '$.k') AS k, len(json_keys(props)) AS n FROM events")
def json_props(spark, d):
    doc = F.try_parse_json("props")
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.size(F.json_object_keys("props")).cast("long").alias("n"))


def hotel_documents(spark, d):
    """A hotel document (JSON) for each supplier, of which each breaks another rule or none."""
    k = F.col("s_suppkey")
    required = ", ".join(f'"{c}": 8.5' for c in A.REQUIRED_CATEGORIES)
    one = '{"reviewer": {"country": "Việt Nam"}, "review": {"comment_positive": "tốt"}}'
    name = F.when(k % 10 == 1, F.lit("null")).otherwise(F.concat(F.lit('"'), F.col("s_name"), F.lit('"')))
    categories = F.when(k % 10 == 2, "[]").when(k % 10 == 3, '{"comfort": null}').when(k % 10 == 4, F.concat(F.lit("{"), F.lit(required.replace('"comfort": 8.5', '"comfort": null')), F.lit("}"))).otherwise(F.concat(F.lit("{"), F.lit(required), F.lit("}")))
    found = F.when(k % 10 == 5, "[]").when(k % 2 == 0, F.lit(f"[{one}, {one}]")).otherwise(F.lit(f'{{"a": {one}, "b": {one}}}'))
    total = F.when(k % 10 == 6, "2").when(k % 10 == 7, '"many"').when(k % 10 == 8, '"-1"').when(k % 10 == 9, F.when(k % 20 == 9, '"23"').otherwise('"22"')).otherwise('"2"')
    text = F.concat(F.lit('{"name": '), name, F.lit(', "evaluation_categories": '), categories, F.lit(', "reviews": '), found, F.lit(', "total_rating": '), total, F.lit("}"))
    return table(spark, d, "supplier").select("s_suppkey", (k % 3).alias("unit"), F.when(k % 25 == 0, F.lit("{bad")).otherwise(text).alias("content"))


AUDIT = """SELECT s_suppkey, s_suppkey % 3 AS unit, CASE WHEN s_suppkey % 25 = 0 OR s_suppkey % 10 = 5 THEN 0 ELSE 2 END AS review_count, CASE WHEN s_suppkey % 25 = 0 OR s_suppkey % 10 = 5 THEN 0 ELSE 2 END AS vn_positive,
CASE WHEN s_suppkey % 25 = 0 THEN 'unreadable' ELSE CASE s_suppkey % 10 WHEN 1 THEN 'name' WHEN 2 THEN 'categories' WHEN 3 THEN 'all categories null' WHEN 4 THEN 'category null' WHEN 5 THEN 'reviews'
WHEN 6 THEN 'total not text' WHEN 7 THEN 'total not a number' WHEN 8 THEN 'total negative' WHEN 9 THEN CASE WHEN s_suppkey % 20 = 9 THEN 'total differs' END END END AS error FROM supplier"""


@query("audit_reason", AUDIT)
def audit_reason(spark, d):
    return A.audited(A.parsed(hotel_documents(spark, d))).select("s_suppkey", "unit", "review_count", "vn_positive", "error")


@query("audit_totals", f"SELECT unit, count(*) AS documents, count(error) AS errors, sum(review_count)::BIGINT AS reviews, sum(vn_positive)::BIGINT AS vn_positive FROM ({AUDIT}) GROUP BY 1")
def audit_totals(spark, d):
    return A.unit_totals(A.audited(A.parsed(hotel_documents(spark, d))), "unit")


@query(
    "folder_compare",
    "SELECT 'f' || s_suppkey AS name, CASE WHEN s_suppkey % 5 = 0 THEN 'only_left' WHEN s_suppkey % 7 = 0 THEN 'only_right' WHEN s_suppkey % 3 = 0 THEN 'different' ELSE 'same' END AS status FROM supplier WHERE NOT (s_suppkey % 5 = 0 AND s_suppkey % 7 = 0)",
)
def folder_compare(spark, d):
    k, name = F.col("s_suppkey"), F.concat(F.lit("f"), F.col("s_suppkey")).alias("name")
    s = table(spark, d, "supplier")
    left = s.filter(k % 7 != 0).select(name, F.concat(F.lit('{"a": 1, "b": '), k, F.lit("}")).alias("content"))
    right = s.filter(k % 5 != 0).select(name, F.concat(F.lit('{"b":'), k + (k % 3 == 0).cast("int"), F.lit(', "a":1}')).alias("content"))
    return K.compare_folders(left, right)


def _collapsed(source: str) -> str:
    """SQL of (doc_id, t) of a table's texts with words that are said again written once; only blanks may stand between them."""
    return f"""(SELECT doc_id, array_to_string(list_transform(list_filter(list_zip(g, w, range(1, len(g) + 1)), lambda p: p[3] = 1 OR p[2] IS NULL
  OR NOT (regexp_full_match(p[1], '\\s+') AND lower(p[2]) = lower(w[p[3] - 1]))), lambda p: p[1] || coalesce(p[2], '')), '') AS t
FROM (SELECT doc_id, string_split_regex(t, '[\\p{{L}}\\p{{N}}_]+') AS g, regexp_extract_all(t, '[\\p{{L}}\\p{{N}}_]+') AS w FROM {source}))"""


def _on(source: str, query: str) -> str:
    """SQL of a query of documents over the texts of another table."""
    return f"(WITH documents AS (SELECT doc_id, t AS text FROM {source}) SELECT * FROM {query})"


LEXICON = {w: w.replace(" ", "_") for w in cleaning.LEXICON}
_GAP = "abs(strptime(month || '-01', '%Y-%m-%d')::DATE - strptime(m || '-01', '%Y-%m-%d')::DATE) <= 30"
STEPS_SQL = rf"""WITH said AS (SELECT *, CASE WHEN starts_with(guest, 'guest') THEN 10 ELSE doc_id % 29 / 2.0 + 3 END AS score FROM (
  SELECT doc_id, text, 'guest ' || doc_id % 1000 AS guest, '2024-01' AS month, NULL::VARCHAR AS country FROM documents UNION ALL ({comments_sql()}))),
scored AS (SELECT * FROM said WHERE score >= 5), one AS (SELECT doc_id, {TQ.NO_EMOJI} AS t FROM scored), two AS (SELECT * FROM {_collapsed("one")}),
three AS (SELECT doc_id, {TQ.STRIPPED.format("array_to_string(list_filter(c, lambda x, i: i = 1 OR x <> c[i - 1] OR x = chr(10)), '')")} AS t FROM (SELECT doc_id, string_split(t, '') AS c FROM two)),
four AS (SELECT doc_id, t FROM three WHERE length(t) >= 5 AND regexp_matches(t, '[\p{{L}}\p{{N}}]')),
five AS (SELECT doc_id, regexp_replace({TQ.NORMAL}, '^\s*-\s*', '') AS t FROM (SELECT doc_id, t AS text FROM four)),
placed AS (SELECT doc_id, t AS text, country FROM five JOIN (SELECT doc_id, country FROM said) USING (doc_id)),
flags AS (SELECT doc_id, rule BETWEEN 17 AND 22 AS is_vietnamese FROM ({TQ.cascade("placed", "contains(lower(country), 'vietnam')")})),
six AS (SELECT doc_id, mapped AS t FROM {_on("five", TQ.mapped(TQ.lexicons.ABBREVIATIONS))}), seven AS (SELECT * FROM {_collapsed("six")}),
eight AS (SELECT doc_id, trim(regexp_replace(t, '\s+', ' ', 'g')) AS t FROM seven), nine AS (SELECT doc_id, t FROM eight WHERE t <> ''),
ten AS (SELECT doc_id, t, guest, month FROM (SELECT doc_id, t, guest, month, lag(t) OVER w AS before, lag(month) OVER w AS m FROM nine JOIN (SELECT doc_id, guest, month FROM said) USING (doc_id)
  WINDOW w AS (PARTITION BY guest ORDER BY month, doc_id)) WHERE NOT coalesce(t = before AND {_GAP}, false)),
kept AS (SELECT doc_id, t, guest, month FROM ten JOIN flags USING (doc_id) WHERE is_vietnamese)"""
WHOLE = f"""{STEPS_SQL}
SELECT doc_id AS review_id, md5(t) AS digest, md5(mapped) AS segmented, row_number() OVER (ORDER BY guest, month, doc_id) AS stt
FROM kept JOIN (SELECT doc_id, mapped FROM {_on("kept", TQ.mapped(LEXICON))}) USING (doc_id)"""


@query("full_pipeline", WHOLE)
def full_pipeline(spark, d):
    return cleaning.whole(spark, d)


_COUNTED = zip(cleaning.STEPS, ("said", "scored", "four", "nine", "ten", "kept"), strict=True)


@query("cleaning_funnel", STEPS_SQL + " UNION ALL ".join(f" SELECT {i} AS place, '{step}' AS step, count(*) AS n FROM {source}" for i, (step, source) in enumerate(_COUNTED)))
def cleaning_funnel(spark, d):
    return cleaning.funnel(spark, d)


@query(
    "stream_windows",
    "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
)
def stream_windows(spark, d):
    return SW.hourly_batch(table(spark, d, "events"))


@query(
    "review_summary",
    """WITH c AS (SELECT conv_id, list(replace(text, chr(10), ' ') ORDER BY turn) AS t FROM conversations GROUP BY 1)
SELECT conv_id, array_to_string(list_transform(t[:5], lambda x, i: '[' || i || '] ' || substr(trim(x), 1, 100) || CASE WHEN length(trim(x)) > 100 THEN '...' ELSE '' END || ' (' || i || '/5)'), chr(10))
  || CASE WHEN len(t) > 5 THEN chr(10) || '... (+' || len(t) - 5 || ' more)' ELSE '' END AS summary FROM c""",
)
def review_summary(spark, d):
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.replace("text", F.lit("\n"), F.lit(" ")).alias("text")))).alias("t"))
    rated = F.transform("t", lambda x, i: F.struct(x["text"].alias("content"), (i + 1).cast("string").alias("rating")))
    parsed = turns.select("conv_id", F.try_variant_get(F.parse_json(F.to_json(rated)), "$", "array<variant>").alias("r"))
    return parsed.select("conv_id", A.review_summary(F.col("r")).alias("summary"))


ORDER_DOCUMENT = """json_object('key', o_orderkey, 'priority', {0}, 'lines', {1}, 'note', json_object('status', o_orderstatus, 'a b', {2}))"""
LINES_SQL = "SELECT l_orderkey, list(json_object('n', l_linenumber, 'part', l_partkey{0}) ORDER BY l_linenumber, l_partkey{0}) AS lines FROM lineitem{1} GROUP BY 1"


def _order_documents_sql(part: str, where: str, priority: str, note: str) -> str:
    document = ORDER_DOCUMENT.format(priority, "coalesce(lines, [])", note)
    return f"SELECT o_orderkey AS name, {document} AS doc FROM orders LEFT JOIN ({LINES_SQL.format(part, where)}) ON l_orderkey = o_orderkey"


def order_documents(spark, d, part, where: str, priority, note):
    """An order as JSON: its lines, and a note."""
    lines = table(spark, d, "lineitem").filter(where).select("l_orderkey", F.struct(F.col("l_linenumber").alias("n"), part.alias("part")).alias("line"))
    listed = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    note = F.struct(F.col("o_orderstatus").alias("status"), note.alias("a b"))
    document = F.struct(F.col("o_orderkey").alias("key"), priority.alias("priority"), F.coalesce("lines", F.expr("array()")).alias("lines"), note.alias("note"))
    joined = table(spark, d, "orders").join(listed, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select(F.col("o_orderkey").cast("string").alias("name"), F.to_json(document, {"ignoreNullFields": "false"}).alias("content"))


_LEAVES = "SELECT name, fullkey AS path, atom, type, value FROM {0}, json_tree({0}.doc) WHERE type NOT IN ('OBJECT', 'ARRAY') OR value IN ('[]', '{{}}')"


@query(
    "json_changes",
    f"""WITH a AS ({_order_documents_sql("", "", "o_orderpriority", "o_custkey")}),
b AS ({_order_documents_sql(" + CASE WHEN l_partkey % 31 = 0 THEN 1 ELSE 0 END", " WHERE l_orderkey % 7 <> 0 OR l_linenumber < 3", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END", "CASE WHEN o_orderkey % 11 = 0 THEN o_custkey + 1 ELSE o_custkey END")}),
x AS ({_LEAVES.format("a")}), y AS ({_LEAVES.format("b")})
SELECT name::VARCHAR AS name, path, CASE WHEN x.type IS NULL THEN 'added' WHEN y.type IS NULL THEN 'removed' ELSE 'changed' END AS change, x.value::VARCHAR AS before, y.value::VARCHAR AS after
FROM x FULL JOIN y USING (name, path) WHERE x.value::VARCHAR IS DISTINCT FROM y.value::VARCHAR""",
)
def json_changes(spark, d):
    key, part = F.col("o_orderkey"), F.col("l_partkey")
    left = order_documents(spark, d, part, "true", F.col("o_orderpriority"), F.col("o_custkey"))
    note = F.col("o_custkey") + (key % 11 == 0).cast("int")
    right = order_documents(spark, d, part + (part % 31 == 0).cast("int"), "l_orderkey % 7 <> 0 OR l_linenumber < 3", F.when(key % 5 != 0, F.col("o_orderpriority")), note)
    return K.json_changes(left, right)


@query(
    "json_diff",
    """SELECT 'f' || s_suppkey AS name, '--- ' || chr(10) || '+++ ' || chr(10) || '@@ -1,4 +1,4 @@' || chr(10) || ' {' || chr(10) || '   "a": 1,' || chr(10)
  || '-  "b": ' || s_suppkey || chr(10) || '+  "b": ' || s_suppkey + 1 || chr(10) || ' }' AS diff FROM supplier WHERE s_suppkey % 3 = 0""",
)
def json_diff(spark, d):
    k, name = F.col("s_suppkey"), F.concat(F.lit("f"), F.col("s_suppkey")).alias("name")
    s = table(spark, d, "supplier")
    left = s.select(name, F.concat(F.lit('{"a": 1, "b": '), k, F.lit("}")).alias("content"))
    right = s.select(name, F.concat(F.lit('{"b":'), k + (k % 3 == 0).cast("int"), F.lit(', "a":1}')).alias("content"))
    return K.json_diff(left, right)
