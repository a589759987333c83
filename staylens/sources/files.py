"""Hotel documents, review tables, links and province requests from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions.dates import month_year
from staylens.functions.language import is_vietnamese
from staylens.functions.lexicons import PROVINCES
from staylens.functions.text import combine, safe_strip, word_count
from staylens.operators.reviews import deviation
from staylens.schema import HOTEL, canonical

UNKNOWN, NAMELESS, OTHER = "Không rõ", "Không tên", "Khác"


def read_hotels(spark: SparkSession, base: str, names: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """(documents of the named files under base with their ``path``, unreadable files: path and content)."""
    raw = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", names)
        .option("wholetext", True)
        .text(base)
        .select("value", F.col("_metadata.file_path").alias("path"))
    )
    sound = F.try_parse_json("value").isNotNull()
    good = raw.filter(sound).select(F.from_json("value", HOTEL).alias("h"), "path").select("h.*", "path")
    return good, raw.filter(~sound).select("path", F.col("value").alias("content"))


def province_of(path: Column, base: str) -> Column:
    """First folder below base by its display name; files that lie in base itself are of another province."""
    below = F.substring_index(path, f"{base.rstrip('/').rpartition('/')[2]}/", -1)
    folder = F.translate(F.lower(F.substring_index(below, "/", 1)), "_", "-")
    names = F.create_map(*[F.lit(x) for pair in PROVINCES.items() for x in pair])
    known = F.coalesce(F.try_element_at(names, folder), F.initcap(F.translate(folder, "-", " ")))
    return F.when(F.contains(below, F.lit("/")), known).otherwise(OTHER)


def rating_number(x: Column) -> Column:
    """8,7 and 8.7 as a number, anything else 0."""
    return F.coalesce(F.replace(x, F.lit(","), F.lit(".")).try_cast("double"), F.lit(0.0))


def flatten(hotels: DataFrame, base: str, compat: bool = False) -> DataFrame:
    """The canonical review table of hotel documents, one row per review."""
    average = rating_number(F.col("rating"))
    rows = hotels.select(
        F.coalesce("name", F.lit(NAMELESS)).alias("hotel_name"),
        province_of(F.col("path"), base).alias("province"),
        average.alias("hotel_avg_score"),
        F.explode("reviews").alias("r"),
    )
    review = lambda name: F.col(f"r.review.{name}")
    filled = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit(UNKNOWN))
    text = combine(review("rating"), review("comment_positive"), review("comment_negative"))
    country = F.coalesce("r.reviewer.country", F.lit(UNKNOWN))
    return canonical(
        rows.select(
            "hotel_name",
            country.alias("country"),
            F.coalesce("r.reviewer.name", F.lit(UNKNOWN)).alias("review_name"),
            "province",
            review("score").alias("score"),
            "hotel_avg_score",
            deviation(review("score"), F.col("hotel_avg_score")).alias("deviation"),
            review("date").alias("date_str"),
            month_year(review("date"), compat).alias("month_year"),
            review("stay_duration").alias("stay_duration"),
            filled(review("room_type")).alias("room_type"),
            filled(review("group_type")).alias("group_type"),
            safe_strip(review("rating")).alias("rating"),
            safe_strip(review("comment_positive")).alias("positive_comment"),
            safe_strip(review("comment_negative")).alias("negative_comment"),
            F.coalesce(text, F.lit("")).alias("combined_text"),
            F.coalesce(word_count(text), F.lit(0)).alias("text_length"),
            is_vietnamese(text, country).alias("is_vietnamese"),
        )
    )


def read_reviews_csv(spark: SparkSession, path: str) -> DataFrame:
    """A review table from CSV with a header, with or without a byte order mark."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return canonical(raw.toDF(*[c.lstrip("﻿") for c in raw.columns]))


def read_links(spark: SparkSession, base: str) -> DataFrame:
    """(province, url): lines that start with http of the text files in province folders below base."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(base)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return lines.select(folder.alias("province"), F.trim("value").alias("url")).filter(F.startswith("url", F.lit("http")))


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """(url, name, folder) of ``url|name|folder`` lines; comments and lines of other than three parts are left out."""
    parts = F.split("value", r"\|")
    lines = spark.read.text(path).filter(~F.startswith(F.ltrim("value"), F.lit("#")) & (F.size(parts) == 3))
    return lines.select(*[F.trim(parts[i]).alias(n) for i, n in enumerate(("url", "name", "folder"))])
