"""Filters, near-duplicate removal, encodings and numbering of the review table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from staylens.functions.dates import first_of_month
from staylens.functions.text import is_empty, nights, strip
from staylens.storage import written


def score_filter(df: DataFrame, least: float = 5, column: str = "score") -> DataFrame:
    """Rows with at least the score; what is no number goes."""
    return df.filter(F.col(column).try_cast("double") >= least)


def score_funnel(df: DataFrame, least: float = 5, column: str = "score") -> DataFrame:
    """total, kept, low and unscored rows; they add up."""
    value = F.col(column).try_cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(value >= least).alias("kept"),
        F.count_if(value < least).alias("low"),
        F.count_if(value.isNull()).alias("unscored"),
    )


def drop_empty(df: DataFrame, *columns: str, least: int = 5) -> DataFrame:
    """Rows with something in at least one of the columns."""
    return df.filter(~reduce(lambda a, b: a & b, [is_empty(F.col(c), least) for c in columns]))


def near_duplicates(
    df: DataFrame, user: str, text: str, month: str, order: tuple[str, ...], days: int = 30, keep: str = "first"
) -> DataFrame:
    """df without rows that repeat the text of the same user's neighbouring row within the days.

    Rows of a user are ordered by month and ``order`` (columns that make the order total); each is compared with the row
    before it (after it, if keep is "last"), whether that row stays or not. Rows without a month go, null users never match.

    One user may have any share of the rows: tasks get ranges of (user, month, order), not users, and the last row of a range
    (the first, if keep is "last") is carried over to the next one, a row for each range.
    """
    part, first = "range_of_rows", keep == "first"
    keys = [F.col(user).alias("user"), F.col("__month").alias("month"), *[F.col(c).alias(f"order_{i}") for i, c in enumerate(order)]]
    said = F.lower(strip(F.col(text))).alias("said")
    dated = df.withColumn("__month", first_of_month(F.col(month))).filter("__month IS NOT NULL")
    ranged = written(dated.repartitionByRange(user, "__month", *order).withColumn(part, F.spark_partition_id()), "ranged")
    row = F.struct(*keys, said)
    edges = ranged.groupBy(part).agg((F.max if first else F.min)(row).alias("edge"))  # one row for each range that has rows
    near, by_part = F.lag if first else F.lead, Win.orderBy(part)
    carried = edges.select(part, near("edge").over(by_part).alias("carried"))
    within = Win.partitionBy(part).orderBy(user, "__month", *order)
    beside = ranged.withColumn("beside", near(F.struct(F.col(user).alias("user"), F.col("__month").alias("month"), said)).over(within))
    beside = beside.join(F.broadcast(carried), part).withColumn(
        "beside", F.coalesce("beside", F.struct(F.col("carried.user"), F.col("carried.month"), F.col("carried.said")))
    )
    gap = F.abs(F.datediff("__month", F.col("beside.month")))
    same = (F.col(user) == F.col("beside.user")) & (F.lower(strip(F.col(text))) == F.col("beside.said")) & (gap <= days)
    return beside.withColumn("__same", F.coalesce(same, F.lit(False))).filter(~F.col("__same")).drop("__month", "__same", part, "beside", "carried")


def number_rows(df: DataFrame, *order: str, name: str = "stt") -> DataFrame:
    """1..n in the order of columns that make it total, without one task for all rows: rows are ranged, counted by
    range, and numbered within it from where the ranges before end. The rows are written before they are ranged, as Spark
    samples what it ranges, and then with the number of their range, so counts and numbers agree however tasks are repeated."""
    part, at, before = "range_of_rows", "place_in_range", "rows_before"
    ranged = written(written(df, "rows").repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranged")
    within = ranged.withColumn(at, F.row_number().over(Win.partitionBy(part).orderBy(*order)))
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("n"))  # one row for each range
    ends = sizes.select(part, F.coalesce(F.sum("n").over(Win.orderBy(part).rowsBetween(Win.unboundedPreceding, -1)), F.lit(0)).alias(before))
    return within.join(F.broadcast(ends), part).withColumn(name, F.col(at) + F.col(before)).drop(part, at, before)


def label_codes(df: DataFrame, column: str, unknown: str = "Unknown") -> DataFrame:
    """(label, id): labels in order from 0; null is a label of its own name. The window holds distinct labels only."""
    labels = df.select(F.coalesce(F.col(column), F.lit(unknown)).alias("label")).distinct()
    return labels.withColumn("id", (F.dense_rank().over(Win.orderBy("label")) - 1).cast("long"))


def stay_codes(df: DataFrame, column: str, compat: bool = False, unknown: str = "Unknown") -> DataFrame:
    """(label, id): ids of stays are their nights. Others follow behind the longest stay in order of their text; compat
    gives them 0, 2, 4, ..., which meet real nights."""
    labels = df.select(F.coalesce(F.col(column), F.lit(unknown)).alias("label")).distinct().withColumn("n", nights(F.col("label")))
    w = Win.orderBy("label")
    other = labels.filter("n < 0").withColumn("at", F.row_number().over(w) - 1)
    longest = labels.agg(F.coalesce(F.max("n"), F.lit(-1)).alias("most"))
    ident = F.col("at") * 2 if compat else F.greatest(F.col("most"), F.lit(-1)) + 1 + F.col("at")
    others = other.join(F.broadcast(longest)).select("label", ident.cast("long").alias("id"))  # longest: one row
    return labels.filter("n >= 0").select("label", F.col("n").cast("long").alias("id")).unionByName(others)


def encode(df: DataFrame, column: str, codes: DataFrame, name: str, unknown: str = "Unknown") -> DataFrame:
    """df with the id of each row's label; Spark picks the join by the codes' size."""
    own = codes.select(F.col("label").alias("__label"), F.col("id").alias(name))
    return df.join(own, F.coalesce(F.col(column), F.lit(unknown)) == F.col("__label"), "left").drop("__label")


def deviation(score: Column, average: Column, digits: int = 1) -> Column:
    return F.bround(score - average, digits)


def changed_rows(df: DataFrame, column: str, f) -> DataFrame:
    """df with f applied to the column, beside ``changed``: whether that made a difference."""
    return df.withColumn("__new", f(F.col(column))).withColumn("changed", ~F.col("__new").eqNullSafe(F.col(column))).withColumn(column, F.col("__new")).drop("__new")
