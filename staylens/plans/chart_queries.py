"""Queries of the 33 chart data sets and of the tabular aggregates, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens.functions import text as T
from staylens.operators import reviews as R
from staylens.operators import stats as S
from staylens.plans.adapter import OTHER, on_average, on_reviews, reviews, table, with_average
from staylens.sources.spread import spread

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _q(key: str, value: str, source: str, where: str = "true") -> str:
    return (
        f"SELECT {key}, count(*) AS n, min({value}) AS low, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median, "
        f"quantile_cont({value}, 0.75) AS q3, max({value}) AS high FROM {source} WHERE {key} IS NOT NULL AND {value} IS NOT NULL AND {where} GROUP BY {key}"
    )


def _top(key: str, k: int, where: str = "true") -> str:
    return f"SELECT {key} FROM reviews WHERE {key} IS NOT NULL AND {where} GROUP BY {key} ORDER BY count(*) DESC, {key} LIMIT {k}"


NOT_OTHER = f"province <> '{OTHER}'"
TOKENS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]{2,}')"


@query("score_histogram", on_reviews("SELECT floor(score + 0.5)::BIGINT AS bin, count(*) AS n FROM reviews WHERE score IS NOT NULL GROUP BY 1"))
def score_histogram(spark, d):
    return S.histogram(reviews(spark, d), "score")


NULLABLE = ("score", "room_type", "positive_comment", "negative_comment", "country")


@query("null_counts", on_reviews("SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in NULLABLE) + " FROM reviews"))
def null_counts(spark, d):
    return S.null_counts(reviews(spark, d), NULLABLE)


@query("province_quartiles", on_reviews(_q("province", "score", "reviews", NOT_OTHER)))
def province_quartiles(spark, d):
    return S.quartiles(reviews(spark, d).filter(F.col("province") != OTHER), "province", "score")


@query(
    "province_score_facet",
    on_reviews(f"SELECT province, floor(score + 0.5)::BIGINT AS bin, count(*) AS n FROM reviews WHERE score IS NOT NULL AND province IN ({_top('province', 15)}) GROUP BY 1, 2"),
)
def province_score_facet(spark, d):
    return S.histogram(S.within_top(reviews(spark, d), "province", 15), "score", "province")


@query(
    "province_month_series",
    on_reviews(
        f""", t15 AS ({_top('province', 15)}), t8 AS ({_top('province', 8)}),
r AS (SELECT province, month_year FROM reviews WHERE province IN (SELECT province FROM t15)),
m AS (SELECT unnest(generate_series(min(strptime(month_year || '-01', '%Y-%m-%d')), max(strptime(month_year || '-01', '%Y-%m-%d')), INTERVAL 1 MONTH)) AS month FROM r),
c AS (SELECT province, month_year, count(*) AS n FROM r GROUP BY 1, 2)
SELECT strftime(m.month, '%Y-%m') AS month, t8.province, coalesce(c.n, 0) AS n FROM m, t8 LEFT JOIN c ON c.province = t8.province AND c.month_year = strftime(m.month, '%Y-%m')"""
    ),
)
def province_month_series(spark, d):
    return S.month_series(reviews(spark, d), "province", 8, 15).withColumn("month", F.date_format("month", "yyyy-MM"))


@query(
    "deviation_histogram",
    on_reviews(
        """, dv AS (SELECT score - 5 AS x FROM reviews WHERE score IS NOT NULL), e AS (SELECT min(x) AS a, max(x) AS b FROM dv)
SELECT least(floor((x - a) / (b - a) * 80), 79)::BIGINT AS bin, count(*) AS n FROM dv, e GROUP BY 1"""
    ),
)
def deviation_histogram(spark, d):
    return S.equal_bins(reviews(spark, d).withColumn("x", F.col("score") - 5), "x", 80)


@query("reviewer_deviation", on_average("SELECT hotel_name, count(*) AS n, round(avg(deviation * deviation), 6) AS spread FROM averaged WHERE deviation IS NOT NULL GROUP BY 1"))
def reviewer_deviation(spark, d):
    df = with_average(reviews(spark, d)).filter("deviation IS NOT NULL")
    return df.groupBy("hotel_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("deviation") * F.col("deviation")), 6).alias("spread"))


@query("text_length_p97", on_reviews("SELECT count(*) AS n, quantile_cont(text_length, 0.97) AS p97 FROM reviews WHERE score IS NOT NULL"))
def text_length_p97(spark, d):
    return S.one_row(reviews(spark, d).filter("score IS NOT NULL"), n=F.count(F.lit(1)), p97=F.percentile("text_length", F.lit(0.97)))


@query("fixed_sample_10000", on_reviews("SELECT review_id, text_length, score FROM reviews ORDER BY md5(review_id || '-42'), review_id LIMIT 10000"))
def fixed_sample_10000(spark, d):
    return S.fixed_sample(reviews(spark, d).select("review_id", "text_length", "score"), "review_id", 10_000)


def _top_query(name: str, key: str, k: int) -> None:
    sql = on_reviews(f"SELECT {key}, count(*) AS n FROM reviews WHERE {key} IS NOT NULL GROUP BY {key} ORDER BY n DESC, {key} LIMIT {k}")
    query(name, sql)(lambda spark, d: S.top_frequency(reviews(spark, d), key, k))


_top_query("top_room_types_all", "room_type", 15)
_top_query("top_countries", "country", 12)


@query("top_room_types", on_reviews("SELECT room_type, count(*) AS n FROM reviews WHERE score >= 5 AND room_type IS NOT NULL GROUP BY 1 ORDER BY n DESC, room_type LIMIT 15"))
def top_room_types(spark, d):
    return S.top_frequency(R.score_filter(reviews(spark, d)), "room_type", 15)


@query("group_type_counts", on_reviews("SELECT group_type, count(*) AS n FROM reviews WHERE group_type IS NOT NULL GROUP BY 1"))
def group_type_counts(spark, d):
    return S.frequency(reviews(spark, d), "group_type")


@query(
    "funnel_shares",
    on_reviews(
        """SELECT count(*) AS total, count(*) FILTER (score < 5) AS low, count(*) FILTER (score >= 5 AND positive_comment IS NULL) AS empty,
count(*) FILTER (score >= 5 AND positive_comment IS NOT NULL AND NOT is_vietnamese) AS foreign_text,
count(*) FILTER (score >= 5 AND positive_comment IS NOT NULL AND is_vietnamese) AS kept FROM reviews"""
    ),
)
def funnel_shares(spark, d):
    good, said = F.col("score") >= 5, F.col("positive_comment").isNotNull()
    return S.one_row(
        reviews(spark, d),
        total=F.count(F.lit(1)),
        low=F.count_if(F.col("score") < 5),
        empty=F.count_if(good & ~said),
        foreign_text=F.count_if(good & said & ~F.col("is_vietnamese")),
        kept=F.count_if(good & said & F.col("is_vietnamese")),
    )


@query("word_freq_top300", f"SELECT term, count(*) AS n FROM (SELECT unnest({TOKENS}) AS term FROM documents) GROUP BY 1 ORDER BY n DESC, term LIMIT 300")
def word_freq_top300(spark, d):
    return S.word_frequency(spread(table(spark, d, "documents").select("text")), "text", 300)


@query("frequent_words", f"SELECT term, count(*) AS n FROM (SELECT unnest({TOKENS}) AS term FROM documents) GROUP BY 1 ORDER BY n DESC, term LIMIT 300")
def frequent_words(spark, d):
    """word_freq_top300 by a sketch of candidates and their exact counts."""
    return S.frequent_terms(spread(table(spark, d, "documents").select("text")), T.word_tokens(F.col("text")), 300)


@query("frequent_bigrams", f"SELECT term, count(*) AS n FROM (SELECT t[i] || ' ' || t[i + 1] AS term FROM (SELECT t, unnest(range(1, len(t))) AS i FROM (SELECT {TOKENS} AS t FROM documents))) GROUP BY 1 ORDER BY n DESC, term LIMIT 20")
def frequent_bigrams(spark, d):
    return S.frequent_terms(spread(table(spark, d, "documents").select("text")), S.bigrams(F.col("text")), 20)


SCORED = "CASE WHEN n_chars % 10 + 1 >= 9 THEN 'high' WHEN n_chars % 10 + 1 <= 7 THEN 'low' END"


def _labelled(spark, d, high: int, low: int):
    score = F.col("n_chars") % 10 + 1
    docs = spread(table(spark, d, "documents").select("n_chars", "text")).withColumn("label", F.when(score >= high, "high").when(score <= low, "low"))
    return docs.filter("label IS NOT NULL")


@query(
    "words_high_low",
    f"""WITH w AS (SELECT label, unnest({TOKENS}) AS term FROM (SELECT {SCORED} AS label, text FROM documents) WHERE label IS NOT NULL),
c AS (SELECT label, term, count(*) AS n FROM w GROUP BY 1, 2)
SELECT label, term, n FROM c QUALIFY row_number() OVER (PARTITION BY label ORDER BY n DESC, term) <= 150""",
)
def words_high_low(spark, d):
    return S.word_frequency(_labelled(spark, d, 9, 7), "text", 150, "label")


@query(
    "bigrams_high_low",
    f"""WITH w AS (SELECT label, {TOKENS} AS t FROM (SELECT CASE WHEN n_chars % 10 + 1 >= 8 THEN 'high' WHEN n_chars % 10 + 1 <= 7 THEN 'low' END AS label, text FROM documents) WHERE label IS NOT NULL),
p AS (SELECT label, t[i] || ' ' || t[i + 1] AS term FROM (SELECT label, t, unnest(range(1, len(t))) AS i FROM w)),
c AS (SELECT label, term, count(*) AS n FROM p GROUP BY 1, 2)
SELECT label, term, n FROM c QUALIFY row_number() OVER (PARTITION BY label ORDER BY n DESC, term) <= 20""",
)
def bigrams_high_low(spark, d):
    return S.bigram_frequency(_labelled(spark, d, 8, 7), "text", 20, "label")


NUMERIC = ["score", "text_length", "review_id"]


@query(
    "score_corr_matrix",
    on_reviews(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM reviews" for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1 :])),
)
def score_corr_matrix(spark, d):
    return S.correlations(reviews(spark, d), NUMERIC).withColumn("r", F.round("r", 6))


SPINE = """, m AS (SELECT strftime(unnest(generate_series(min(strptime(month_year || '-01', '%Y-%m-%d')), max(strptime(month_year || '-01', '%Y-%m-%d')), INTERVAL 1 MONTH)), '%Y-%m') AS month FROM reviews)"""


def _month_text(df):
    return df.withColumn("month", F.date_format("month", "yyyy-MM"))


@query("monthly_trend_gapfill", on_reviews(f"{SPINE} SELECT month, count(month_year) AS n FROM m LEFT JOIN reviews ON month_year = month GROUP BY 1"))
def monthly_trend_gapfill(spark, d):
    return _month_text(S.monthly(reviews(spark, d), n=F.count(F.lit(1))).fillna(0, ["n"]))


@query("monthly_peak", on_reviews("SELECT month_year AS month, count(*) AS n FROM reviews GROUP BY 1 ORDER BY n DESC, month LIMIT 1"))
def monthly_peak(spark, d):
    return _month_text(S.monthly(reviews(spark, d), n=F.count(F.lit(1)))).orderBy(F.desc("n"), "month").limit(1)


@query(
    "rolling3_avg_score",
    on_reviews(
        f"""{SPINE}, a AS (SELECT month, sum(score) AS total, count(score) AS n FROM m LEFT JOIN reviews ON month_year = month GROUP BY 1),
b AS (SELECT month, CASE WHEN n > 0 THEN total / n END AS mean FROM a)
SELECT month, round(mean, 6) AS mean, CASE WHEN count(mean) OVER w = 3 THEN round(avg(mean) OVER w, 6) END AS rolling FROM b WINDOW w AS (ORDER BY month ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"""
    ),
)
def rolling3_avg_score(spark, d):
    series = S.rolling_mean(S.monthly(reviews(spark, d), mean=F.avg("score")), "mean")
    return _month_text(series.select("month", F.round("mean", 6).alias("mean"), F.round("rolling", 6).alias("rolling")))


@query("group_quartiles", on_reviews(_q("group_type", "score", "reviews")))
def group_quartiles(spark, d):
    return S.quartiles(reviews(spark, d), "group_type", "score")


@query("top10_province_quartiles", on_reviews(_q("province", "score", "reviews", f"province IN ({_top('province', 10, NOT_OTHER)})")))
def top10_province_quartiles(spark, d):
    return S.quartiles(S.within_top(reviews(spark, d).filter(F.col("province") != OTHER), "province", 10), "province", "score")


@query(
    "vn_ratio_by_province",
    on_reviews("SELECT province, count(*) AS n, count(*) FILTER (is_vietnamese) AS local FROM reviews GROUP BY 1 ORDER BY count(*) FILTER (is_vietnamese) / count(*) DESC, province LIMIT 15"),
)
def vn_ratio_by_province(spark, d):
    found = reviews(spark, d).groupBy("province").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_vietnamese").alias("local"))
    return found.orderBy(F.desc(F.col("local") / F.col("n")), "province").limit(15)


@query(
    "stay_bins",
    on_reviews(
        """SELECT CASE WHEN n <= 1 THEN 1 WHEN n <= 3 THEN 2 WHEN n <= 7 THEN 3 ELSE 4 END AS bin, count(*) AS n, sum(score) AS total
FROM (SELECT regexp_extract(stay_duration, '(\\d+)', 1)::INT AS n, score FROM reviews WHERE score IS NOT NULL) GROUP BY 1"""
    ),
)
def stay_bins(spark, d):
    stayed = F.regexp_extract("stay_duration", r"(\d+)", 1).try_cast("int")
    bins = F.when(stayed <= 1, 1).when(stayed <= 3, 2).when(stayed <= 7, 3).otherwise(4)
    df = reviews(spark, d).filter(F.col("score").isNotNull() & stayed.isNotNull())
    return df.groupBy(bins.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total"))


@query(
    "month_heatmap_pivot",
    on_reviews("SELECT province, " + ", ".join(f"count(score) FILTER (substr(month_year, 6)::INT = {m}) AS m{m}" for m in range(1, 13)) + " FROM reviews GROUP BY 1"),
)
def month_heatmap_pivot(spark, d):
    dated = S.with_month(reviews(spark, d)).withColumn("m", F.concat(F.lit("m"), F.month("month")))
    return dated.groupBy("province").pivot("m", [f"m{m}" for m in range(1, 13)]).agg(F.count("score")).fillna(0)


@query("hotel_popularity", on_reviews("SELECT hotel_name, count(*) AS n, sum(score) AS total FROM reviews WHERE score IS NOT NULL GROUP BY 1 HAVING count(*) >= 5"))
def hotel_popularity(spark, d):
    found = reviews(spark, d).filter("score IS NOT NULL").groupBy("hotel_name").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total"))
    return found.filter("n >= 5")


@query(
    "vn_vs_intl_pivot",
    on_reviews(f"SELECT province, round(avg(score) FILTER (NOT is_vietnamese), 6) AS abroad, round(avg(score) FILTER (is_vietnamese), 6) AS local FROM reviews WHERE province IN ({_top('province', 10)}) GROUP BY 1"),
)
def vn_vs_intl_pivot(spark, d):
    top = S.within_top(reviews(spark, d), "province", 10)
    wide = top.groupBy("province").pivot("is_vietnamese", [False, True]).agg(F.round(F.avg("score"), 6))
    return wide.withColumnsRenamed({"false": "abroad", "true": "local"})


@query("room_mean_score", on_reviews(f"SELECT room_type, count(score) AS n, sum(score) AS total FROM reviews WHERE room_type IN ({_top('room_type', 15)}) GROUP BY 1"))
def room_mean_score(spark, d):
    return S.within_top(reviews(spark, d), "room_type", 15).groupBy("room_type").agg(F.count("score").alias("n"), F.sum("score").alias("total"))


@query(
    "deviation_by_group",
    on_average(
        "SELECT group_type, count(*) AS n, round(quantile_cont(deviation, 0.25), 6) AS q1, round(quantile_cont(deviation, 0.5), 6) AS median, round(quantile_cont(deviation, 0.75), 6) AS q3 FROM averaged WHERE deviation IS NOT NULL GROUP BY 1"
    ),
)
def deviation_by_group(spark, d):
    found = S.quartiles(with_average(reviews(spark, d)), "group_type", "deviation")
    return found.select("group_type", "n", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")])


@query("top_hotels_quartiles", on_reviews(_q("hotel_name", "score", "reviews", f"hotel_name IN ({_top('hotel_name', 20)})")))
def top_hotels_quartiles(spark, d):
    return S.quartiles(S.within_top(reviews(spark, d), "hotel_name", 20), "hotel_name", "score")


@query("pair_complete_rows", on_reviews("SELECT count(*) AS n, sum(score) AS score, sum(text_length)::BIGINT AS text_length FROM reviews WHERE score IS NOT NULL AND text_length IS NOT NULL HAVING count(*) >= 100"))
def pair_complete_rows(spark, d):
    complete = reviews(spark, d).dropna(subset=["score", "text_length"])
    return S.one_row(complete, n=F.count(F.lit(1)), score=F.sum("score"), text_length=F.sum("text_length")).filter("n >= 100")


@query(
    "length_score_bins",
    on_reviews(
        """, h AS (SELECT group_type, score / 10 * 60 AS u, text_length / 50 * (60 / 1.7320508075688772) AS v FROM reviews WHERE score IS NOT NULL),
k AS (SELECT group_type, u, v, round(u) AS a1, round(v) AS b1, floor(u) AS a2, floor(v) AS b2 FROM h),
d AS (SELECT group_type, CASE WHEN (u-a1)*(u-a1) + 3*(v-b1)*(v-b1) < (u-a2-0.5)*(u-a2-0.5) + 3*(v-b2-0.5)*(v-b2-0.5) THEN a1 ELSE a2 + 0.5 END AS hx,
CASE WHEN (u-a1)*(u-a1) + 3*(v-b1)*(v-b1) < (u-a2-0.5)*(u-a2-0.5) + 3*(v-b2-0.5)*(v-b2-0.5) THEN b1 ELSE b2 + 0.5 END AS hy FROM k)
SELECT hx, hy, count(*) AS n FROM d GROUP BY 1, 2"""
    ),
)
def length_score_bins(spark, d):
    return S.hex_bins(reviews(spark, d).filter("score IS NOT NULL"), "score", "text_length", 10, 50, 60)


@query(
    "length_decile_crosstab",
    on_reviews(
        """, e AS (SELECT list_distinct(quantile_cont(text_length, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])) AS edges FROM reviews),
b AS (SELECT group_type, len(list_filter(list_sort(edges)[2:], lambda x: x < text_length)) AS bin FROM reviews, e),
c AS (SELECT bin, group_type, count(*) AS n FROM b GROUP BY 1, 2)
SELECT bin, group_type, n, n * 100 / sum(n) OVER (PARTITION BY bin) AS percent FROM c"""
    ),
)
def length_decile_crosstab(spark, d):
    return S.crosstab(S.quantile_bins(reviews(spark, d), "text_length", 10), "bin", "group_type")


@query(
    "sentiment_by_group",
    on_reviews(
        """, s AS (SELECT group_type, CASE WHEN trim(coalesce(negative_comment, '')) <> '' THEN 'Negative' ELSE 'Positive' END AS sentiment FROM reviews),
c AS (SELECT group_type, sentiment, count(*) AS n FROM s GROUP BY 1, 2) SELECT group_type, sentiment, n, n * 100 / sum(n) OVER (PARTITION BY group_type) AS percent FROM c"""
    ),
)
def sentiment_by_group(spark, d):
    said = F.trim(F.coalesce("negative_comment", F.lit(""))) != ""
    return S.crosstab(reviews(spark, d).withColumn("sentiment", F.when(said, "Negative").otherwise("Positive")), "group_type", "sentiment")


@query(
    "sentiment_counts",
    on_reviews("SELECT count(*) AS total, count(*) FILTER (positive_comment <> '') AS positive, count(*) FILTER (negative_comment <> '') AS negative, count(*) FILTER (coalesce(positive_comment, '') = '' AND coalesce(negative_comment, '') = '') AS neither FROM reviews"),
)
def sentiment_counts(spark, d):
    has = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    p, n = has("positive_comment"), has("negative_comment")
    return S.one_row(reviews(spark, d), total=F.count(F.lit(1)), positive=F.count_if(p), negative=F.count_if(n), neither=F.count_if(~p & ~n))


@query(
    "detail_rate_by_score",
    on_reviews(
        """, c AS (SELECT score::INT AS s, count(*) AS n, count(*) FILTER (positive_comment IS NOT NULL OR negative_comment IS NOT NULL) AS detailed FROM reviews WHERE score IS NOT NULL GROUP BY 1)
SELECT g.s::BIGINT AS score, coalesce(n, 0) AS n, coalesce(detailed, 0) AS detailed FROM (SELECT unnest(generate_series(1, 10)) AS s) g LEFT JOIN c ON c.s = g.s"""
    ),
)
def detail_rate_by_score(spark, d):
    said = F.col("positive_comment").isNotNull() | F.col("negative_comment").isNotNull()
    found = reviews(spark, d).filter("score IS NOT NULL").groupBy(F.col("score").cast("long").alias("score")).agg(F.count(F.lit(1)).alias("n"), F.count_if(said).alias("detailed"))
    spine = spark.range(1, 11).withColumnRenamed("id", "score")
    return spine.join(found, "score", "left").fillna(0)


DESCRIBED = ("score", "text_length")


@query(
    "describe_numeric",
    on_reviews(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS low, quantile_cont({c}, 0.25)::DOUBLE AS q1, quantile_cont({c}, 0.5)::DOUBLE AS q2, quantile_cont({c}, 0.75)::DOUBLE AS q3, max({c})::DOUBLE AS high FROM reviews"
            for c in DESCRIBED
        )
    ),
)
def describe_numeric(spark, d):
    return S.describe(reviews(spark, d), DESCRIBED).withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("value_share", on_reviews("SELECT room_type, count(*) AS n, count(*) * 100 / (SELECT count(*) FROM reviews) AS percent FROM reviews WHERE room_type IS NOT NULL GROUP BY 1"))
def value_share(spark, d):
    return S.share_of_all(reviews(spark, d), "room_type")


@query("mean_text_len", "SELECT lang, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY 1")
def mean_text_len(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query("score_summary", on_reviews("SELECT round(avg(score), 6) AS mean, min(score) AS low, max(score) AS high, count(DISTINCT hotel_name) AS hotels, round(avg(is_vietnamese::INT), 6) AS local FROM reviews"))
def score_summary(spark, d):
    df = reviews(spark, d)
    return S.one_row(df, mean=F.round(F.avg("score"), 6), low=F.min("score"), high=F.max("score"), hotels=F.count_distinct("hotel_name"), local=F.round(F.avg(F.col("is_vietnamese").cast("int")), 6))


@query("province_rollup_total", on_reviews("SELECT coalesce(province, 'TOTAL') AS province, count(*) AS n, count(*) FILTER (is_vietnamese) AS local, count(DISTINCT hotel_name) AS hotels FROM reviews GROUP BY ROLLUP (province)"))
def province_rollup_total(spark, d):
    return S.with_total(reviews(spark, d), "province", "TOTAL", n=F.count(F.lit(1)), local=F.count_if("is_vietnamese"), hotels=F.count_distinct("hotel_name"))


@query("topn_collapse", on_reviews(f"SELECT CASE WHEN province IN ({_top('province', 5)}) THEN province ELSE '{OTHER}' END AS province, count(*) AS n FROM reviews GROUP BY 1"))
def topn_collapse(spark, d):
    return S.collapse_tail(reviews(spark, d), "province", 5, OTHER).groupBy("province").agg(F.count(F.lit(1)).alias("n"))


@query("number_label", "SELECT o_orderkey, CASE WHEN n >= 1e6 THEN regexp_replace(format('{:.2f}', n / 1e6), '\\.?0+$', '') || 'M' WHEN n >= 1e3 THEN regexp_replace(format('{:.2f}', n / 1e3), '\\.?0+$', '') || 'K' ELSE n::BIGINT::VARCHAR END AS label FROM (SELECT o_orderkey, (o_orderkey * 10000)::DOUBLE AS n FROM orders)")
def number_label(spark, d):
    return table(spark, d, "orders").select("o_orderkey", T.label_count(F.col("o_orderkey") * 10000).alias("label"))
