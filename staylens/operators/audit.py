"""Audit of hotel documents read with loose types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.schema import REQUIRED_CATEGORIES

TOLERANCE = 20


def parsed(raw: DataFrame, column: str = "content") -> DataFrame:
    """Documents (JSON text) as a variant ``doc`` beside the other columns; malformed text gives a null."""
    return raw.withColumn("doc", F.try_parse_json(column))


def _field(path: str, kind: str) -> Column:
    return F.try_variant_get("doc", path, kind)


def reviews_of(doc: Column) -> Column:
    """The reviews as an array, whether the document has an array or an object of them; null if neither."""
    as_list = F.try_variant_get(doc, "$.reviews", "array<variant>")
    as_map = F.map_values(F.try_variant_get(doc, "$.reviews", "map<string,variant>"))
    return F.coalesce(as_list, as_map)


def audited(documents: DataFrame) -> DataFrame:
    """documents (see parsed) with review_count, vn_positive and error: the first rule that fails, null if sound."""
    name = _field("$.name", "string")
    kind = lambda path: F.schema_of_variant(F.try_variant_get("doc", path, "variant"))
    category = [_field(f"$.evaluation_categories.{c}", "string") for c in REQUIRED_CATEGORIES]
    nulls = sum((c.isNull().cast("int") for c in category), F.lit(0))
    total, reviews = _field("$.total_rating", "string"), reviews_of(F.col("doc"))
    count = F.coalesce(F.size(reviews), F.lit(0))
    number = total.try_cast("double")
    error = (
        F.when(F.col("doc").isNull(), "unreadable")
        .when(name.isNull() | (F.trim(name) == "") | (name == "Unknown"), "name")
        .when(~F.coalesce(kind("$.evaluation_categories").startswith("OBJECT"), F.lit(False)), "categories")
        .when(nulls == len(category), "all categories null")
        .when(nulls > 0, "category null")
        .when(reviews.isNull() | (count == 0), "reviews")
        .when(total.isNotNull() & (kind("$.total_rating") != "STRING"), "total not text")
        .when(total.isNotNull() & number.isNull(), "total not a number")
        .when(number < 0, "total negative")
        .when(F.abs(number - count) > TOLERANCE, "total differs")
    )
    text = lambda r, path: F.try_variant_get(r, path, "string")
    local = F.filter(
        reviews,
        lambda r: (text(r, "$.reviewer.country") == "Việt Nam") & (F.trim(F.coalesce(text(r, "$.review.comment_positive"), F.lit(""))) != ""),
    )
    return documents.withColumns({"review_count": count, "vn_positive": F.coalesce(F.size(local), F.lit(0)), "error": error})


def unit_totals(audit: DataFrame, unit: str) -> DataFrame:
    """Documents, errors, reviews and Vietnamese positive reviews of each unit."""
    return audit.groupBy(unit).agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
        F.sum("review_count").alias("reviews"),
        F.sum("vn_positive").alias("vn_positive"),
    )


def review_summary(reviews: Column, most: int = 5, chars: int = 100) -> Column:
    """The first reviews of an array of variants, one numbered line each, and how many more there are."""
    text = lambda r: F.trim(
        F.coalesce(F.try_variant_get(r, "$.content", "string"), F.try_variant_get(r, "$.text", "string"), F.try_variant_get(r, "$", "string"), F.lit(""))
    )
    rating = lambda r: F.coalesce(F.concat(F.lit(" ("), F.try_variant_get(r, "$.rating", "string"), F.lit("/5)")), F.lit(""))
    line = lambda r, i: F.concat(
        F.lit("["), i + 1, F.lit("] "), F.substring(text(r), 1, chars), F.when(F.length(text(r)) > chars, "...").otherwise(""), rating(r)
    )
    more = F.when(F.size(reviews) > most, F.concat(F.lit("\n... (+"), F.size(reviews) - most, F.lit(" more)"))).otherwise("")
    return F.concat(F.array_join(F.transform(F.slice(reviews, 1, most), line), "\n"), more)
