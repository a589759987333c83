"""The review table over the driver's order tables, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions.lexicons import VIETNAMESE

OTHER = "OTHER"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per line item. Joins go by key; nation is of fixed size, other sides Spark broadcasts by their size."""
    t = lambda name: table(spark, sf_dir, name)
    nation = t("nation")
    guest = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"), (F.col("n_nationkey") % 4 == 0).alias("is_vietnamese"))
    place = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("province"))
    orders = (
        t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        .join(t("customer").select("c_custkey", "c_name", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(guest, "c_nationkey")
    )
    score = ((F.col("l_quantity").cast("int") - 1) % 10 + 1).cast("double")
    return (
        t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("part").select("p_partkey", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier").select("s_suppkey", "s_name", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(place, "s_nationkey")
        .select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("review_id"),
            F.col("s_name").alias("hotel_name"),
            "country",
            F.col("c_name").alias("review_name"),
            "province",
            F.when(F.col("l_orderkey") % 97 != 0, score).alias("score"),
            F.date_format("o_orderdate", "yyyy-MM").alias("month_year"),
            F.concat(F.col("p_size").cast("string"), F.lit(" đêm")).alias("stay_duration"),
            F.when(F.col("l_partkey") % 50 != 0, F.col("p_type")).alias("room_type"),
            F.col("o_orderpriority").alias("group_type"),
            F.col("p_size").cast("long").alias("text_length"),
            F.when(F.col("l_linenumber") % 3 != 0, F.concat_ws(" ", "p_type", "o_orderpriority")).alias("positive_comment"),
            F.when(F.col("l_linenumber") % 2 == 0, F.col("o_orderpriority")).alias("negative_comment"),
            "is_vietnamese",
        )
    )


def with_average(df: DataFrame) -> DataFrame:
    """hotel_avg_score and deviation, by a pre-aggregated average of each hotel."""
    average = df.groupBy("hotel_name").agg(F.avg("score").alias("hotel_avg_score"))
    return df.join(average, "hotel_name").withColumn("deviation", F.col("score") - F.col("hotel_avg_score"))


REVIEWS_SQL = """
SELECT l_orderkey * 8 + l_linenumber AS review_id, s_name AS hotel_name, cn.n_name AS country, c_name AS review_name, sn.n_name AS province,
  CASE WHEN l_orderkey % 97 <> 0 THEN ((CAST(l_quantity AS INT) - 1) % 10 + 1)::DOUBLE END AS score,
  strftime(o_orderdate, '%Y-%m') AS month_year, p_size || ' đêm' AS stay_duration,
  CASE WHEN l_partkey % 50 <> 0 THEN p_type END AS room_type, o_orderpriority AS group_type, p_size::BIGINT AS text_length,
  CASE WHEN l_linenumber % 3 <> 0 THEN p_type || ' ' || o_orderpriority END AS positive_comment,
  CASE WHEN l_linenumber % 2 = 0 THEN o_orderpriority END AS negative_comment, cn.n_nationkey % 4 = 0 AS is_vietnamese
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
"""
AVERAGE_SQL = """
SELECT reviews.*, hotel_avg_score, score - hotel_avg_score AS deviation
FROM reviews JOIN (SELECT hotel_name, avg(score) AS hotel_avg_score FROM reviews GROUP BY hotel_name) USING (hotel_name)
"""


def on_reviews(sql: str) -> str:
    """SQL whose FROM can name reviews."""
    return f"WITH RECURSIVE reviews AS ({REVIEWS_SQL}) {sql}" if not sql.lstrip().startswith(",") else f"WITH RECURSIVE reviews AS ({REVIEWS_SQL}){sql.lstrip()}"


def on_average(sql: str) -> str:
    return on_reviews(f", averaged AS ({AVERAGE_SQL}) {sql}")


#: Texts of guests in many languages, one for each way in which the language rules decide, and Vietnamese ones with amounts, phones,
#: emoji, repeats and abbreviations. Words in braces are replaced by words of the row.
SAID = (
    "Tốt {0}",
    "!!!!! ... !!!!! ... !!!!! ok",
    "schöne Zimmer, großes Haus und ruhige Straße {0}",
    "příjemný hostitel, čisté a útulné místo u řeky {0}",
    "și gazde în oraș, îngrijit și liniștit, țin minte {0}",
    "très propre, chambre calme, accueil et personnel parfait",
    "ottima posizione, bella struttura, camera e colazione",
    "quarto limpo, cama boa, vista da cidade, muito bom",
    "فندق جميل و نظيف في مدينة رائع",
    "gan bien rong rinh lam, 酒店很好，房间干净，早餐不错，服务好，位置方便，推荐给大家，下次再来",
    "gan bien rong rinh lam, 호텔 위치가 좋은 편이고 직원 분들이 친절 하고 객실 깨끗 조식 추천 방",
    "gan bien rong rinh lam, ホテル の 部屋 は 清潔 で スタッフ も 親切 朝食 と 場所 が 良い",
    "โรงแรม ห้อง สะอาด พนักงาน อาหารเช้า ดี บริการ แนะนำ",
    "hotel bagus, kamar bersih, staf ramah, lokasi nyaman",
    "everything was wonderful, friendly owners, great breakfast and a lovely garden {0}",
    "the room had a nice view of it {0}",
    "{0} được, {1} ở đường lớn, {2} tuyệt vời, {3} ổn",
    "chủ nhà thân thiện, cho mượn xe đạp, gần chợ",
    "cả nhà nghỉ tại chỗ cũng ổn, phải trả phí bữa, giá rẻ",
    "và hoặc vì thì mà là có không rất tốt sạch sẽ tiện nghi phòng xa hợp lý tuyệt vời kém tệ ngon",
    "bạn bè ngồi học bài cạnh tòa nhà một lần rồi về quê ngoại chụp hình",
    "bạn bè ngồi học bài cạnh tòa nhà trong khu resort kia xong xuôi",
    "xin chao cac ban minh o day hai dem roi ve nha",
    "nv rất rất nhiệt tình 😀😀, ks sạch sẽ, {0} và {1} ở gần trung tâm!!!",
    "giá 500k một đêm",
    "0912345678",
    "đặt qua số 0987 654 321 được giảm giá, {0} và {1} rất tốt, ăn sáng ngon",
    "{0} {0} và {1} đẹp, được ở lại lần nữa, cx ko xa trung tâm, dc {2}",
    "",
)


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comment of every order (doc_id, text, guest, month, country): a text of SAID with Vietnamese words, all chosen by keys."""
    k = F.col("o_orderkey")
    word = lambda i: F.element_at(F.array(*map(F.lit, VIETNAMESE)), (F.pmod(k * (3 + 2 * i) + i, F.lit(len(VIETNAMESE))) + 1).cast("int"))
    text = F.element_at(F.array(*map(F.lit, SAID)), (F.pmod(k * 7 + F.floor(k / 32), F.lit(len(SAID))) + 1).cast("int"))
    for i in range(4):
        text = F.replace(text, F.lit(f"{{{i}}}"), word(i))
    return table(spark, sf_dir, "orders").select(
        (k + 1_000_000_000).alias("doc_id"),
        text.alias("text"),
        F.concat(F.lit("reader "), F.col("o_custkey") % 500).alias("guest"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.when(k % 3 == 0, "Vietnam").when(k % 3 == 1, "Germany").alias("country"),
    )


def comments_sql() -> str:
    """SQL of comments()."""
    listed = lambda words: "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"
    text = f"{listed(SAID)}[((o_orderkey * 7 + o_orderkey // 32) % {len(SAID)} + 1)::INT]"
    for i in range(4):
        text = f"replace({text}, '{{{i}}}', {listed(VIETNAMESE)}[((o_orderkey * {3 + 2 * i} + {i}) % {len(VIETNAMESE)} + 1)::INT])"
    return f"""SELECT o_orderkey + 1000000000 AS doc_id, {text} AS text, 'reader ' || o_custkey % 500 AS guest, strftime(o_orderdate, '%Y-%m') AS month,
CASE o_orderkey % 3 WHEN 0 THEN 'Vietnam' WHEN 1 THEN 'Germany' END AS country FROM orders"""
