"""Frequencies, distributions, series and cross tables. Every top-k breaks ties by key; percentiles are exact."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from staylens.functions.binding import let
from staylens.functions.dates import first_of_month
from staylens.functions.text import word_tokens
from staylens.storage import written


def one_row(df: DataFrame, **aggregates: Column) -> DataFrame:
    return df.agg(*[c.alias(name) for name, c in aggregates.items()])


def frequency(df: DataFrame, key: str) -> DataFrame:
    """Rows of each value; nulls are not counted."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def top_frequency(df: DataFrame, key: str, k: int) -> DataFrame:
    return frequency(df, key).orderBy(F.desc("n"), key).limit(k)


def share_of_all(df: DataFrame, key: str) -> DataFrame:
    """Frequency and its share of all rows, nulls included below the line."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return frequency(df, key).join(F.broadcast(total)).select(key, "n", (F.col("n") * 100 / F.col("total")).alias("percent"))  # total: one row


def describe(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of each column, a row each, from one pass."""
    columns = list(columns)
    figures = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("low"),
            F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
            F.max(c).cast("double").alias("high"),
        ).alias(c)
        for c in columns
    ]
    rows = df.agg(*figures).select(F.explode(F.array(*columns)).alias("r"))
    return rows.select(
        "r.column", "r.n", "r.mean", "r.std", "r.low", F.col("r.q")[0].alias("q1"), F.col("r.q")[1].alias("q2"), F.col("r.q")[2].alias("q3"), "r.high"
    )


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def quartiles(df: DataFrame, key: str, value: str) -> DataFrame:
    """Five numbers of the box of each group, and its rows."""
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), q.alias("q"), F.max(value).alias("high"))
        .select(key, "n", "low", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "high")
    )


def within_top(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows of the k most frequent values; at most k keys are broadcast."""
    return df.join(F.broadcast(top_frequency(df, key, k).select(key)), key, "left_semi")


def collapse_tail(df: DataFrame, key: str, k: int, other: str) -> DataFrame:
    """Values beyond the k most frequent become ``other``."""
    top = F.broadcast(top_frequency(df, key, k).select(F.col(key).alias("__top")))
    return df.join(top, F.col(key) == F.col("__top"), "left").withColumn(key, F.coalesce("__top", F.lit(other))).drop("__top")


def histogram(df: DataFrame, value: str, by: str | None = None) -> DataFrame:
    """Rows by unit bins around whole numbers."""
    keys = ([by] if by else []) + ["bin"]
    return df.filter(F.col(value).isNotNull()).withColumn("bin", F.floor(F.col(value) + 0.5)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def equal_bins(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Rows by equal widths from the least to the greatest value, which falls into the last bin."""
    ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    at = F.floor((F.col(value) - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0)) * bins)
    return (
        df.filter(F.col(value).isNotNull()).join(F.broadcast(ends))  # ends: one row
        .groupBy(F.coalesce(F.least(at, F.lit(bins - 1)), F.lit(0)).cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def month_spine(df: DataFrame, month: str) -> DataFrame:
    """All months from the first to the last, one row each."""
    ends = df.agg(F.min(month).alias("a"), F.max(month).alias("b")).filter("a IS NOT NULL")
    return ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))


def with_month(df: DataFrame, column: str = "month_year") -> DataFrame:
    return df.withColumn("month", first_of_month(F.col(column))).filter("month IS NOT NULL")


def monthly(df: DataFrame, **aggregates: Column) -> DataFrame:
    """Aggregates by month over a spine without gaps; months without rows hold nulls."""
    dated = with_month(df)
    found = dated.groupBy("month").agg(*[c.alias(n) for n, c in aggregates.items()])
    return month_spine(found, "month").join(found, "month", "left")


def month_series(df: DataFrame, key: str, k: int, among: int) -> DataFrame:
    """(month, key, n) with zeros, of the first k of the ``among`` most frequent keys, over the months of all of those."""
    dated = with_month(within_top(df, key, among))
    top = top_frequency(df, key, k).select(key)
    grid = month_spine(dated, "month").join(F.broadcast(top))  # months x k keys
    found = dated.groupBy("month", key).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(found, ["month", key], "left").fillna(0, ["n"])


def rolling_mean(series: DataFrame, value: str, around: int = 1) -> DataFrame:
    """Centred mean over 2 around + 1 months, null unless all of them have a value. One row per month: a small window."""
    w = Win.orderBy("month").rowsBetween(-around, around)
    full = F.count(value).over(w) == 2 * around + 1
    return series.withColumn("rolling", F.when(full, F.avg(value).over(w)))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r) of each pair, over the rows where both are there, in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}~{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}~{b}`").alias("r")) for a, b in pairs])
    return wide.select(F.explode(rows).alias("x")).select("x.*")


def word_frequency(df: DataFrame, text: str, k: int, by: str | None = None, stop: tuple[str, ...] = ()) -> DataFrame:
    """The k most frequent words, of each label if ``by`` is given."""
    return _top_terms(df, F.explode(F.filter(word_tokens(F.col(text)), lambda t: ~t.isin(*stop) if stop else F.lit(True))), k, by)


def bigrams(text: Column) -> Column:
    """Pairs of neighbouring words, the words bound once."""

    def pairs(tokens: Column) -> Column:
        return F.transform(F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))), lambda t, i: F.concat_ws(" ", t, F.get(tokens, i + 1)))

    return let(word_tokens(text), pairs)


def bigram_frequency(df: DataFrame, text: str, k: int, by: str | None = None) -> DataFrame:
    return _top_terms(df, F.explode(bigrams(F.col(text))), k, by)


def _top_terms(df: DataFrame, exploded: Column, k: int, by: str | None) -> DataFrame:
    keys = [by] if by else []
    counted = df.select(*keys, exploded.alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n"))
    if not by:
        return counted.orderBy(F.desc("n"), "term").limit(k)
    w = Win.partitionBy(by).orderBy(F.desc("n"), "term")
    return counted.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).drop("rank")


def frequent_terms(df: DataFrame, terms: Column, k: int, tracked: int = 65_536, sketches: int = 64) -> DataFrame:
    """(term, n): the k most frequent values of an array column, ties by term, as _top_terms() gives them for terms of any number.

    A sketch of ``tracked`` counters a task tells candidates, a bounded number, which alone are counted in a second pass and shuffled.
    The sketch underestimates by at most 3.5 / tracked of all occurrences and lists what is surely above that, so a term that it
    does not list occurs in less than 7 / tracked of them. If the k-th candidate occurs more often the result is proven; else all
    terms are counted. Sketches are merged in ``sketches`` tasks before the last one.
    """
    each = df.select(F.explode(terms).alias("term"))
    part = F.pmod(F.spark_partition_id(), F.lit(sketches)).alias("part")
    parts = each.groupBy(part).agg(F.expr(f"approx_top_k_accumulate(term, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("n"))
    merged = parts.groupBy(F.lit("all").alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n"))
    listed = written(merged.filter("n > 0").select("n", F.expr(f"approx_top_k_estimate(sketch, {tracked})").alias("found")), "candidates")
    total = (listed.select("n").first() or [0])[0]
    likely = listed.select(F.explode("found.item").alias("term"))  # at most tracked rows
    top = each.join(F.broadcast(likely), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "term").limit(k)
    top = written(top, "top-terms")
    size, least = top.agg(F.count(F.lit(1)), F.min("n")).first()
    if total and (size < k or least * tracked <= 7 * total):
        return _top_terms(df, F.explode(terms), k, None)
    return top


def quantile_bins(df: DataFrame, value: str, bins: int) -> DataFrame:
    """df with ``bin``: right-closed quantile bins from 0; equal edges fall together, the least value is in the first."""
    share = F.array(*[F.lit(i / bins) for i in range(bins + 1)])
    edges = df.agg(F.array_distinct(F.percentile(value, share)).alias("edges"))
    above = F.size(F.filter(F.slice(F.col("edges"), 2, F.size("edges")), lambda e: e < F.col(value)))
    return df.filter(F.col(value).isNotNull()).join(F.broadcast(edges)).withColumn("bin", above.cast("long")).drop("edges")  # edges: one row


def crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """(row, column, n, percent of the row's rows)."""
    found = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))
    return found.withColumn("percent", F.col("n") * 100 / F.sum("n").over(Win.partitionBy(row)))


def hex_bins(df: DataFrame, x: str, y: str, x_max: float, y_max: float, grid: int) -> DataFrame:
    """Hexagonal bins: of two shifted lattices the nearer point takes the row."""
    u, v = F.col(x) / x_max * grid, F.col(y) / y_max * (grid / 1.7320508075688772)
    a1, b1 = F.round(u), F.round(v)
    a2, b2 = F.floor(u), F.floor(v)
    d1 = (u - a1) * (u - a1) + 3 * (v - b1) * (v - b1)
    d2 = (u - a2 - 0.5) * (u - a2 - 0.5) + 3 * (v - b2 - 0.5) * (v - b2 - 0.5)
    near = d1 < d2
    return df.groupBy(F.when(near, a1).otherwise(a2 + 0.5).alias("hx"), F.when(near, b1).otherwise(b2 + 0.5).alias("hy")).agg(F.count(F.lit(1)).alias("n"))


def fixed_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in the order of a digest of the key and the seed: the same rows on any cluster."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}"))), key).limit(n)


def with_total(df: DataFrame, key: str, total: str, **aggregates: Column) -> DataFrame:
    """Aggregates by key with a grand-total row."""
    rolled = df.rollup(key).agg(F.grouping(key).alias("__all"), *[c.alias(n) for n, c in aggregates.items()])
    return rolled.withColumn(key, F.when(F.col("__all") == 1, total).otherwise(F.col(key))).drop("__all")
