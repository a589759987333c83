"""Queries that write files with the sinks and read them back with the sources, and of landed HTML, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens import sinks
from staylens.functions import text as T
from staylens.functions import urls as U
from staylens.operators import audit as A
from staylens.operators import reviews as R
from staylens.plans.adapter import on_reviews, reviews, table
from staylens.plans.link_queries import LINKS, hotel_documents, links
from staylens.plans.link_queries import ORACLES as ORACLES_OF_LINKS
from staylens.sources import files, run_log, workbooks
from staylens.sources import html as H
from staylens.sources.spread import spread
from staylens.storage import new_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return add


FOLDERS = ("da_lat", "ha-long", "unknown_place")


@query(
    "hotel_files",
    """WITH s AS (SELECT s_suppkey AS k, s_name, s_nationkey FROM supplier WHERE s_suppkey % 11 <> 0),
r AS (SELECT k, s_name, s_nationkey, unnest([1, 2]) AS i FROM s)
SELECT CASE WHEN k % 7 = 0 THEN 'Không tên' ELSE s_name END AS hotel_name, CASE k % 3 WHEN 0 THEN 'Đà Lạt' WHEN 1 THEN 'Hạ Long' ELSE 'Unknown Place' END AS province,
  CASE WHEN i = 1 THEN 'Việt Nam' ELSE 'Không rõ' END AS country, CASE WHEN i = 1 THEN 'guest ' || k ELSE 'Không rõ' END AS review_name, (k % 10 + i)::DOUBLE AS score,
  CASE WHEN k % 5 = 0 THEN 0 ELSE k % 10 + 0.5 END::DOUBLE AS hotel_avg_score, (k % 10 + i - CASE WHEN k % 5 = 0 THEN 0 ELSE k % 10 + 0.5 END)::DOUBLE AS deviation,
  CASE WHEN i = 1 THEN '2023-10' END AS month_year, CASE WHEN i = 1 THEN 'Phòng đôi' ELSE 'Không rõ' END AS room_type,
  CASE WHEN i = 1 THEN 'sạch' ELSE '' END AS positive_comment, CASE WHEN i = 1 THEN 'Tốt sạch' ELSE 'xa' END AS combined_text, CASE WHEN i = 1 THEN 2 ELSE 1 END::BIGINT AS text_length
FROM r""",
)
def hotel_files(spark, d):
    """A JSON file for each supplier in a folder of its province, some unreadable, read and flattened to reviews."""
    k = F.col("s_suppkey")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    first = F.concat(
        F.lit('{"reviewer":{"name":"guest '), k, F.lit('","country":"Việt Nam"},"review":{"date":"15/10/2023","rating":"Tốt","score":'), k % 10 + 1,
        F.lit(',"room_type":"Phòng đôi","comment_positive":" sạch "}}'),
    )
    second = F.concat(F.lit('{"reviewer":{},"review":{"score":'), k % 10 + 2, F.lit(',"room_type":"","comment_negative":"xa"}}'))
    rating = F.when(k % 5 == 0, quoted(F.lit("Not found"))).otherwise(quoted(F.concat(k % 10, F.lit(",5"))))
    name = F.when(k % 7 == 0, F.lit("null")).otherwise(quoted(F.col("s_name")))
    text = F.concat(F.lit('{"name":'), name, F.lit(',"rating":'), rating, F.lit(',"reviews":['), first, F.lit(","), second, F.lit("]}"))
    rows = spread(table(spark, d, "supplier")).select(k, F.when(k % 11 == 0, F.lit("{oops")).otherwise(text).alias("value"))
    base = new_path(spark, "hotels")
    for i, folder in enumerate(FOLDERS):
        rows.filter(k % 3 == i).select("value").write.option("maxRecordsPerFile", 1).text(f"{base}/{folder}")
    good, _ = files.read_hotels(spark, base, "*.txt")
    columns = "hotel_name province country review_name score hotel_avg_score deviation month_year room_type positive_comment combined_text text_length"
    return files.flatten(good, base).select(*columns.split())


@query("unreadable_files", "SELECT '{bad' AS content, count(*) AS n FROM supplier WHERE s_suppkey % 25 = 0 HAVING count(*) > 0")
def unreadable_files(spark, d):
    """Unreadable documents, kept by the sink for them."""
    base, kept = new_path(spark, "documents"), new_path(spark, "bad")
    spread(hotel_documents(spark, d).select("content")).write.option("maxRecordsPerFile", 1).text(base)
    _, bad = files.read_hotels(spark, base, "*.txt")
    sinks.write_bad_files(bad, kept)
    return spark.read.parquet(kept).select(F.trim("content").alias("content")).groupBy("content").agg(F.count(F.lit(1)).alias("n"))


CSV_COLUMNS = "hotel_name country review_name province score month_year stay_duration room_type group_type positive_comment negative_comment text_length is_vietnamese"


@query("reviews_csv", on_reviews(f"SELECT {CSV_COLUMNS.replace(' ', ', ')} FROM reviews"))
def reviews_csv(spark, d):
    path = new_path(spark, "csv")
    sinks.write_csv(reviews(spark, d).select(*CSV_COLUMNS.split()), path)
    return files.read_reviews_csv(spark, path).select(*CSV_COLUMNS.split())


@query("link_files", f"WITH {LINKS} SELECT 'province=' || province AS province, trim(url) AS url FROM links WHERE starts_with(trim(url), 'http')")
def link_files(spark, d):
    path = new_path(spark, "links")
    sinks.write_links(links(spark, d).select("province", "url"), path)
    return files.read_links(spark, path)


@query("request_lines", "SELECT 'http://x.org/' || n_nationkey AS url, n_name AS name, 'f-' || n_regionkey AS folder FROM nation WHERE n_nationkey % 5 < 3")
def request_lines(spark, d):
    k, path = F.col("n_nationkey") % 5, new_path(spark, "requests")
    line = F.concat(F.lit("http://x.org/"), "n_nationkey", F.lit(" | "), "n_name", F.lit("|f-"), "n_regionkey")
    odd = F.when(k == 3, F.concat(F.lit("  # "), line)).when(k == 4, F.concat_ws("|", "n_name", F.lit("two parts"))).otherwise(line)
    table(spark, d, "nation").select(odd.alias("value")).write.text(path)
    return files.read_requests(spark, path)


@query("learning_text", on_reviews("SELECT score::BIGINT::VARCHAR AS label, positive_comment AS text, count(*) AS n FROM reviews WHERE positive_comment IS NOT NULL AND score IS NOT NULL GROUP BY 1, 2"))
def learning_text(spark, d):
    path, part = new_path(spark, "learning"), F.split("value", "\t")
    sinks.write_learning_text(reviews(spark, d).filter("score IS NOT NULL"), "positive_comment", "score", path)
    return spark.read.text(path).groupBy(part[0].alias("label"), part[1].alias("text")).agg(F.count(F.lit(1)).alias("n"))


@query("province_sheets", on_reviews("SELECT province, count(*)::VARCHAR AS n FROM reviews GROUP BY 1"))
def province_sheets(spark, d):
    path = new_path(spark, "report")
    sinks.write_sheets({k: v for k, v in sinks.province_report(reviews(spark, d)).items() if k != "Data"}, path)
    return spark.read.option("header", True).csv(f"{path}/All_Provinces").select("province", "n")


@query("encoding_files", on_reviews("SELECT label, (dense_rank() OVER (ORDER BY label) - 1)::VARCHAR AS id FROM (SELECT DISTINCT coalesce(room_type, 'Unknown') AS label FROM reviews)"))
def encoding_files(spark, d):
    path = new_path(spark, "encodings")
    sinks.write_sheets(sinks.encodings(reviews(spark, d)), path)
    return spark.read.option("header", True).csv(f"{path}/room_type").select("label", "id")


@query("dataset_description", on_reviews("SELECT group_type, count(*)::VARCHAR AS n FROM reviews GROUP BY 1"))
def dataset_description(spark, d):
    path = new_path(spark, "description")
    sinks.write_sheets(sinks.dataset_description(reviews(spark, d), ("score",), ("score",), ("group_type",)), path)
    return spark.read.option("header", True).csv(f"{path}/by_group_type").select("group_type", "n")


@query("processing_report", on_reviews("SELECT count(*) AS total, count(*) FILTER (score >= 5) AS kept, count(*) FILTER (score < 5) AS low, count(*) FILTER (score IS NULL) AS unscored, count(*) FILTER (score >= 5) * 100 / count(*) AS kept_percent FROM reviews"))
def processing_report(spark, d):
    path = new_path(spark, "processing")
    sinks.write_json(sinks.processing_report(reviews(spark, d)), path)
    return spark.read.schema("total long, kept long, low long, unscored long, kept_percent double").json(path)


@query("unit_logs", "SELECT s_suppkey % 3 AS unit, count(*) AS documents FROM supplier GROUP BY 1")
def unit_logs(spark, d):
    path = new_path(spark, "logs")
    sinks.write_json(A.unit_totals(A.audited(A.parsed(hotel_documents(spark, d))), "unit"), path)
    return spark.read.schema("unit long, documents long").json(path)


@query("hotel_export", "SELECT 'p' || page_id % 7 AS province, replace(split_part(split_part(regexp_replace(url, '[?#].*$', ''), '/', -1), '.', 1), '-', '_') || '.json' AS key FROM pages")
def hotel_export(spark, d):
    path = new_path(spark, "export")
    sinks.write_hotels(table(spark, d, "pages").select("url", F.concat(F.lit("p"), F.col("page_id") % 7).alias("province")), path)
    return spark.read.schema("key string, province string").json(path).select("province", "key")


@query("failed_log", "SELECT url, 2::BIGINT AS n FROM pages WHERE page_id % 9 = 0 GROUP BY url")
def failed_log(spark, d):
    """Urls that failed are appended run after run."""
    path = new_path(spark, "failed")
    urls = table(spark, d, "pages").filter("page_id % 9 = 0").select("url").distinct()
    for _ in range(2):
        sinks.append_failed(urls, path)
    return spark.read.text(path).groupBy(F.col("value").alias("url")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "failed_log_runs",
    "SELECT run, url FROM (SELECT DISTINCT url, unnest(['first', 'second']) AS run, page_id FROM pages WHERE page_id % 9 = 0) WHERE run = 'first' OR page_id % 2 = 0 GROUP BY ALL",
)
def failed_log_runs(spark, d):
    """Urls that failed in two runs, of which the second one is done again after it has written other urls."""
    path = new_path(spark, "failed-runs")
    urls = table(spark, d, "pages").filter("page_id % 9 = 0").select("page_id", "url")
    run_log.append_run(urls.select("url").distinct(), path, "first")
    run_log.append_run(urls.filter("page_id % 2 = 1").select("url").distinct(), path, "second")
    run_log.append_run(urls.filter("page_id % 2 = 0").select("url").distinct(), path, "second")
    return run_log.read_log(spark, path)


_CELLS = {
    "Data": ("score, room_type, review_id", "review_id, score NULLS FIRST, room_type NULLS FIRST", ""),
    "Rooms": ("room_type, n", "n DESC, room_type", "(SELECT province, room_type, count(*) AS n FROM reviews WHERE room_type IS NOT NULL GROUP BY ALL)"),
    "Summary": ("reviews, vietnamese", "reviews", "(SELECT province, count(*) AS reviews, count(*) FILTER (is_vietnamese) AS vietnamese FROM reviews GROUP BY ALL)"),
}


def _sheet_sql(sheet: str, columns: str, order: str, source: str) -> str:
    cells = lambda of: "array_to_string([" + ", ".join(of(c.strip()) for c in columns.split(",")) + "], '|')"
    source = source or "reviews"
    return f"""SELECT province AS file, '{sheet}' AS sheet, 0 AS row, {cells(lambda c: f"'{c}'")} AS cells FROM (SELECT DISTINCT province FROM {source})
UNION ALL SELECT province, '{sheet}', row_number() OVER (PARTITION BY province ORDER BY {order}), {cells(lambda c: f"coalesce({c}::VARCHAR, '-')")} FROM {source}"""


@query("province_workbooks", on_reviews(" UNION ALL ".join(f"({_sheet_sql(k, *v)})" for k, v in _CELLS.items())))
def province_workbooks(spark, d):
    """A workbook for each province, all its sheets written and read back."""
    df, path = reviews(spark, d), new_path(spark, "workbooks")
    rooms = df.filter("room_type IS NOT NULL").groupBy("province", "room_type").agg(F.count(F.lit(1)).alias("n"))
    summary = df.groupBy("province").agg(F.count(F.lit(1)).alias("reviews"), F.count_if("is_vietnamese").alias("vietnamese"))
    sheets = {"Data": df.select("province", "score", "room_type", "review_id"), "Rooms": rooms.withColumn("least", -F.col("n")), "Summary": summary}
    workbooks.write_workbooks(sheets, path, {"Data": ("review_id", "score", "room_type"), "Rooms": ("least", "room_type"), "Summary": ("reviews",)}, by="province")
    cells = F.when((F.col("sheet") == "Rooms"), F.slice("cells", 1, 2)).otherwise(F.col("cells"))
    return workbooks.read_workbooks(spark, path, joined=True).select("file", "sheet", "row", F.array_join(cells, "|", "-").alias("cells"))


def _sheets(spark, path, *names: str):
    """(sheet, place, cell) of all cells of the sheets of a report, read back as text; cells in the order of their columns."""
    parts = []
    for name in names:
        df = spark.read.option("header", True).csv(f"{path}/{name}")
        parts.append(df.select(F.lit(name).alias("sheet"), F.array_join(F.array(*[F.col(c) for c in df.columns]), "|", "-").alias("cells"), F.lit("|".join(df.columns)).alias("head")))
    return reduce(DataFrame.unionByName, parts)


def _cells_sql(sheet: str, columns: dict[str, str], source: str) -> str:
    """SQL of the rows that _sheets() gives of a sheet."""
    cells = ", ".join(f"coalesce(({c})::VARCHAR, '-')" for c in columns.values())
    return f"SELECT '{sheet}' AS sheet, array_to_string([{cells}], '|') AS cells, '{'|'.join(columns)}' AS head FROM {source}"


def _sheets_sql(*sheets: str, extra: str = "") -> str:
    return on_reviews(extra + " UNION ALL ".join(f"({s})" for s in sheets))


_SHARES = "(SELECT {0}, n, n * 100 / (SELECT count(*) FROM reviews) AS percent FROM (SELECT {0}, count(*) AS n FROM reviews WHERE {0} IS NOT NULL GROUP BY 1))"
_LABELS = "(SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS id FROM (SELECT DISTINCT coalesce({0}, 'Unknown') AS label FROM reviews))"


@query(
    "report_sheets",
    _sheets_sql(
        _cells_sql("Data", {"review_id": "review_id", "province": "province", "is_vietnamese": "is_vietnamese"}, "reviews"),
        _cells_sql("Top_Provinces", {"province": "province", "n": "n"}, "(SELECT province, count(*) AS n FROM reviews GROUP BY 1 ORDER BY n DESC, province LIMIT 5)"),
        _cells_sql("All_Provinces", {"province": "province", "n": "n"}, "(SELECT province, count(*) AS n FROM reviews GROUP BY 1)"),
        _cells_sql("Summary", {"reviews": "count(*)", "provinces": "count(DISTINCT province)", "vietnamese_share": "round(avg(is_vietnamese::INT), 6)"}, "reviews"),
    ),
)
def report_sheets(spark, d):
    """All sheets of the province report."""
    path = new_path(spark, "report")
    report = sinks.province_report(reviews(spark, d).select("review_id", "province", "is_vietnamese"), 5)
    report["Summary"] = report["Summary"].withColumn("vietnamese_share", F.round("vietnamese_share", 6))
    sinks.write_sheets(report, path)
    return _sheets(spark, path, *report)


@query(
    "encoding_sheets",
    _sheets_sql(
        _cells_sql("room_type", {"label": "label", "id": "id"}, _LABELS.format("room_type")),
        _cells_sql("group_type", {"label": "label", "id": "id"}, _LABELS.format("group_type")),
        _cells_sql("stay_duration", {"label": "label", "id": "regexp_extract(label, '(\\d+)', 1)"}, "(SELECT DISTINCT stay_duration AS label FROM reviews)"),
    ),
)
def encoding_sheets(spark, d):
    """All maps of labels to numbers."""
    path, maps = new_path(spark, "encodings"), sinks.encodings(reviews(spark, d))
    sinks.write_sheets(maps, path)
    return _sheets(spark, path, *maps)


@query(
    "description_sheets",
    _sheets_sql(
        _cells_sql("nulls", {"score": "count(*) FILTER (score IS NULL)", "room_type": "count(*) FILTER (room_type IS NULL)"}, "reviews"),
        _cells_sql(
            "numbers",
            {"column": "'score'", "n": "count(score)", "mean": "round(avg(score), 6)", "std": "round(stddev_samp(score), 6)", "low": "min(score)", "q1": "quantile_cont(score, 0.25)", "q2": "median(score)", "q3": "quantile_cont(score, 0.75)", "high": "max(score)"},
            "reviews",
        ),
        *[_cells_sql(f"by_{k}", {k: k, "n": "n", "percent": "round(percent, 6)"}, _SHARES.format(k)) for k in ("group_type", "room_type", "stay_duration")],
    ),
)
def description_sheets(spark, d):
    """All sheets that describe the dataset."""
    path = new_path(spark, "description")
    sheets = sinks.dataset_description(reviews(spark, d), ("score", "room_type"), ("score",), ("group_type", "room_type", "stay_duration"))
    rounded = {k: df.withColumns({c: F.round(c, 6) for c in ("mean", "std", "percent") if c in df.columns}) for k, df in sheets.items()}
    sinks.write_sheets(rounded, path)
    return _sheets(spark, path, *rounded)


@query("hotel_export_json", "SELECT 'p' || page_id % 7 AS province, json_object('url', url, 'key', replace(split_part(split_part(regexp_replace(url, '[?#].*$', ''), '/', -1), '.', 1), '-', '_') || '.json')::VARCHAR AS body FROM pages")
def hotel_export_json(spark, d):
    """The exported documents themselves."""
    path = new_path(spark, "export")
    sinks.write_hotels(table(spark, d, "pages").select("url", F.concat(F.lit("p"), F.col("page_id") % 7).alias("province")), path)
    return spark.read.schema("value string, province string").text(path).select("province", F.col("value").alias("body"))


@query("unit_logs_whole", ORACLES_OF_LINKS["audit_totals"])
def unit_logs_whole(spark, d):
    """Every figure of the units' logs."""
    path = new_path(spark, "logs")
    sinks.write_json(A.unit_totals(A.audited(A.parsed(hotel_documents(spark, d))), "unit"), path)
    return spark.read.schema("unit long, documents long, errors long, reviews long, vn_positive long").json(path)


def hotel_pages(spark, d):
    """A landed hotel page for each supplier, with sub-scores and two review cards, of which some lack their stay."""
    k = F.col("s_suppkey")
    mark = lambda name, inside, tag="div": F.concat(F.lit(f'<{tag} data-testid="{name}">'), inside, F.lit(f"</{tag}>"))
    score = lambda label, n: mark("review-subscore", F.concat(F.lit(f"<span>{label}</span> <b>"), n, F.lit("</b>")))

    def card(i):
        stay = mark("review-stay-info", F.concat(F.lit("<li>Phòng "), k % 4, F.lit(f"</li><li>{i} đêm</li><li>Cặp đôi</li>")), "ul")
        parts = [
            mark("review-avatar", F.concat(F.lit('<img src="a.png"><div>Guest '), k, F.lit(f"-{i}</div><div>Việt Nam</div>"))),
            F.when((k + i) % 6 == 0, F.lit("")).otherwise(stay),
            mark("review-title", F.concat(F.lit("Tốt &amp; đẹp "), k)),
            mark("review-score", F.concat(F.lit('<div aria-hidden="true">'), k % 10, F.lit(f",{i}</div>"))),
            mark("review-positive-text", F.lit(" sạch<br>  sẽ ")),
        ]
        return mark("review-card", F.concat(*parts))

    body = F.concat(
        mark("property-name", "s_name", "h2"), mark("address", F.concat(F.lit("Phố  "), k)), score("Sạch sẽ", F.concat(k % 10, F.lit(",5"))), score("Wifi miễn phí", F.lit("8.0")),
        score("Sạch sẽ", F.lit("1,0")), mark("review-score-value", F.concat(k % 10, F.lit(",7"))), card(1), card(2),
    )
    return spread(table(spark, d, "supplier").select("s_suppkey", "s_name")).select(k, F.concat(F.lit("<html><body>"), body, F.lit("<script>var x = '<p>';</script></body>")).alias("html"))


@query(
    "html_hotel",
    """SELECT s_suppkey, s_name AS name, 'Phố ' || s_suppkey AS address, s_suppkey % 10 || ',7' AS rating, s_suppkey % 10 + 0.5::DOUBLE AS cleanliness, 8.0::DOUBLE AS free_wifi, NULL::DOUBLE AS comfort,
  (2 - ((s_suppkey + 1) % 6 = 0)::INT - ((s_suppkey + 2) % 6 = 0)::INT)::BIGINT AS n_reviews FROM supplier""",
)
def html_hotel(spark, d):
    h = H.extract_hotels(hotel_pages(spark, d))
    scores = [F.col(f"hotel.evaluation_categories.{c}").alias(c) for c in ("cleanliness", "free_wifi", "comfort")]
    return h.select("s_suppkey", "hotel.name", "hotel.address", "hotel.rating", *scores, F.size("hotel.reviews").cast("long").alias("n_reviews"))


@query(
    "html_review_cards",
    """SELECT s_suppkey, 'Guest ' || s_suppkey || '-' || i AS name, 'Việt Nam' AS country, 'a.png' AS avatar, 'Tốt & đẹp ' || s_suppkey AS rating, (s_suppkey % 10 + i / 10)::DOUBLE AS score,
  'Phòng ' || s_suppkey % 4 AS room_type, i || ' đêm' AS stay_duration, 'Cặp đôi' AS group_type, 'sạch sẽ' AS comment_positive, NULL::VARCHAR AS comment_negative
FROM supplier, (SELECT unnest([1, 2]) AS i) WHERE (s_suppkey + i) % 6 <> 0""",
)
def html_review_cards(spark, d):
    rows = H.extract_hotels(hotel_pages(spark, d)).select("s_suppkey", F.explode("hotel.reviews").alias("r"))
    names = "rating score room_type stay_duration group_type comment_positive comment_negative"
    return rows.select("s_suppkey", "r.reviewer.name", "r.reviewer.country", "r.reviewer.avatar", *[f"r.review.{n}" for n in names.split()])


@query("rounded_deviation", on_reviews("SELECT review_id, round_even(score - (review_id % 100) / 10, 1) AS deviation FROM reviews WHERE score IS NOT NULL"))
def rounded_deviation(spark, d):
    df = reviews(spark, d).filter("score IS NOT NULL")
    return df.select("review_id", R.deviation(F.col("score"), F.col("review_id") % 100 / 10).alias("deviation"))


@query("range_folders", "SELECT name, regexp_matches(name, '^[0-9-]+$') AND regexp_matches(name, '[0-9]') AS is_range FROM (SELECT s_suppkey || CASE s_suppkey % 3 WHEN 0 THEN '-' || s_suppkey + 50 WHEN 1 THEN 'a-1' ELSE '-' END AS name FROM supplier)")
def range_folders(spark, d):
    k = F.col("s_suppkey")
    name = F.concat(k, F.when(k % 3 == 0, F.concat(F.lit("-"), k + 50)).when(k % 3 == 1, "a-1").otherwise("-"))
    return table(spark, d, "supplier").select(name.alias("name")).withColumn("is_range", U.is_range_folder(F.col("name")))


@query(
    "path_names",
    """SELECT page_id, split_part(url, '/', -2) AS folder, list_aggregate(list_transform(string_split(replace(split_part(url, '/', 3), '-', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS title FROM pages WHERE url IS NOT NULL""",
)
def path_names(spark, d):
    p = table(spark, d, "pages").filter("url IS NOT NULL")
    return p.select("page_id", U.folder_of(F.col("url")).alias("folder"), U.slug_title(F.element_at(F.split("url", "/"), 3)).alias("title"))


@query(
    "blank_helpers",
    r"""SELECT doc_id, md5(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS stripped, md5(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')) AS collapsed FROM documents""",
)
def blank_helpers(spark, d):
    x = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.md5(T.safe_strip(x)).alias("stripped"), F.md5(T.collapse_blanks(x)).alias("collapsed"))
