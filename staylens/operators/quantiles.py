"""Exact quantiles of groups of any size, by rounds of refined histograms.

A quantile of n rows lies between two order statistics. Each is searched as a range of values that starts with the whole group: a
round counts the range's rows in equal bins, keeps the bin that holds the wanted rank, and narrows the range to the least and the
greatest value in it, until these are equal. A round's state is ``bins`` counters a group and rank, whatever the number of distinct
values (a percentile aggregate keeps every one of them in a buffer), and rows are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from staylens.storage import written


def quantiles(df: DataFrame, key: str, value: str, shares: tuple[float, ...], bins: int = 512) -> DataFrame:
    """(key, n, low, high, q): rows, ends and quantiles of the values of each key, linear between order statistics.

    Null and NaN values are left out, and keys without others; a null key is a key of its own. Each round reads df again,
    which should thus be a table. Rounds end once all ranks are found; a range shrinks by the factor ``bins`` a round at least.
    """
    held = df.select(F.struct(key).alias("key"), F.col(value).cast("double").alias("value")).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    ends = written(held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")), "ends")
    at = lambda share: F.lit(share) * (F.col("n") - 1)
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(at(s)), F.ceil(at(s))) for s in shares])))
    open_ranks = ends.select("key", F.explode(ranks).alias("rank"), "low", "high", F.lit(0).cast("long").alias("before"))
    found, todo = [], written(open_ranks, "ranks")
    while True:
        found.append(todo.filter("low = high").select("key", "rank", F.col("low").alias("value")))
        todo = todo.filter("low < high")
        if todo.isEmpty():
            break
        # One row a key: the join keeps the rows' number, and a row goes into the bins of the ranges that hold its value.
        ranges = todo.groupBy("key", "low", "high", "before").agg(F.collect_list("rank").alias("ranks")).groupBy("key").agg(F.collect_list(F.struct("low", "high", "before", "ranks")).alias("ranges"))
        inside = F.explode(F.filter("ranges", lambda r: (F.col("value") >= r["low"]) & (F.col("value") <= r["high"])))
        rows = held.join(ranges, held["key"].eqNullSafe(ranges["key"])).select(held["key"], "value", inside.alias("r"))
        width = F.col("r.high") / bins - F.col("r.low") / bins
        bin_ = F.least(F.floor(F.coalesce(F.try_divide(F.col("value") - F.col("r.low"), width), F.lit(0.0))), F.lit(bins - 1))
        # The ends have bins of their own: a range shrinks even where doubles tell no bins apart, or where an end is infinite.
        bin_ = F.when(F.col("value") == F.col("r.low"), -1).when(F.col("value") == F.col("r.high"), bins).otherwise(bin_)
        counted = rows.groupBy("key", "r", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        up_to = F.sum("n").over(Win.partitionBy("key", "r").orderBy("bin")) + F.col("r.before")
        placed = counted.withColumn("after", up_to).withColumn("before", F.col("after") - F.col("n")).withColumn("rank", F.explode("r.ranks"))
        todo = written(placed.filter("rank >= before AND rank < after").select("key", "rank", "low", "high", "before"), "ranks")
    values = found[0]
    for more in found[1:]:
        values = values.unionByName(more)
    by_rank = values.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("values"))
    lower = lambda s: F.element_at("values", F.floor(at(s)))
    upper = lambda s: F.element_at("values", F.ceil(at(s)))
    between = [F.when(F.floor(at(s)) == F.ceil(at(s)), lower(s)).otherwise((F.ceil(at(s)) - at(s)) * lower(s) + (at(s) - F.floor(at(s))) * upper(s)) for s in shares]
    joined = ends.join(by_rank.withColumnRenamed("key", "own"), F.col("key").eqNullSafe(F.col("own")))
    return joined.select(F.col("key")[key].alias(key), "n", "low", "high", F.array(*between).alias("q"))


def boxes(df: DataFrame, key: str, value: str) -> DataFrame:
    """Five numbers of the box of each key, and its rows; null keys are left out."""
    found = quantiles(df.filter(F.col(key).isNotNull()), key, value, (0.25, 0.5, 0.75))
    return found.select(key, "n", "low", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "high")
