"""Sets of links and tables: unions, comparisons and reconciliation."""

from __future__ import annotations

import difflib
import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.storage import written


def union_distinct(*sets: DataFrame) -> DataFrame:
    """(province, url) of all sets, trimmed and lower-cased, once each."""
    out = sets[0].select("province", "url")
    for s in sets[1:]:
        out = out.unionByName(s.select("province", "url"))
    return out.select("province", F.lower(F.trim("url")).alias("url")).filter("url <> ''").distinct()


def incremental_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """old and new once each, with is_new telling those that old did not have."""
    keys = ["province", "url"]
    both = old.select(*keys, F.lit(False).alias("is_new")).unionByName(new.select(*keys, F.lit(True).alias("is_new")))
    return both.groupBy(*keys).agg(F.min("is_new").alias("is_new"))


def name_key(x: Column) -> Column:
    return F.lower(F.trim(x))


def compare_full(left: DataFrame, right: DataFrame, key: Column, *columns: str) -> DataFrame:
    """Rows of names that both have (by key), full outer by key and exact name, the columns of either side suffixed."""
    a = left.select(key.alias("key"), "name", *[F.col(c).alias(f"{c}_1") for c in columns])
    b = right.select(key.alias("key"), "name", *[F.col(c).alias(f"{c}_2") for c in columns])
    shared_a = a.join(b.select("key"), "key", "left_semi")
    shared_b = b.join(a.select("key"), "key", "left_semi")
    return shared_a.join(shared_b, ["key", "name"], "full_outer")


def only_in_one(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Values that one side lacks, with the side that has them."""
    a, b = left.select(column).distinct(), right.select(column).distinct()
    return a.join(b, column, "left_anti").withColumn("source", F.lit(1)).unionByName(b.join(a, column, "left_anti").withColumn("source", F.lit(2)))


def in_both(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    return left.join(right.select(column), column, "left_semi")


def reconcile(links: DataFrame, success: DataFrame, errors: DataFrame, timeouts: DataFrame, variant: str = "current") -> DataFrame:
    """(province, url, type) of what has to be fetched again, with the type's rank.

    current: an error is an Error always, a listed link without outcome is Missing unless it timed out for good.
    older and middle: a timeout comes before an error and is listed as Timeout; they differ in the order of the types.
    """
    order = {
        "current": ("Error", "Missing", "Timeout"),
        "older": ("Timeout", "Error", "Missing"),
        "middle": ("Error", "Missing", "Timeout"),
    }[variant]
    keys = ["province", "url"]
    flag = lambda df, name: df.select(*keys).distinct().withColumn(name, F.lit(True))
    listed = flag(links, "listed").join(flag(errors, "error"), keys, "full_outer")
    joined = listed.join(flag(success, "ok"), keys, "left").join(flag(timeouts, "late"), keys, "left")
    error, late = F.coalesce("error", F.lit(False)), F.coalesce("late", F.lit(False))
    missing = F.coalesce("listed", F.lit(False)) & F.col("ok").isNull()
    if variant == "current":
        kind = F.when(error, "Error").when(missing & ~late, "Missing")
    else:
        kind = F.when(late & (error | missing), "Timeout").when(error, "Error").when(missing, "Missing")
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("type")) - 1
    return joined.select(*keys, kind.alias("type")).filter("type IS NOT NULL").withColumn("rank", rank)


def compare_folders(left: DataFrame, right: DataFrame) -> DataFrame:
    """(name, status) of (name, content) rows: only_left, only_right, same or different; JSON is compared by value."""
    canon = lambda c: F.coalesce(F.to_json(F.try_parse_json(c)), c)
    a = left.select("name", canon(F.col("content")).alias("a"), F.lit(True).alias("in_a"))
    b = right.select("name", canon(F.col("content")).alias("b"), F.lit(True).alias("in_b"))
    status = (
        F.when(F.col("in_b").isNull(), "only_left").when(F.col("in_a").isNull(), "only_right").when(F.col("a").eqNullSafe(F.col("b")), "same").otherwise("different")
    )
    return a.join(b, "name", "full_outer").select("name", status.alias("status"))


def urls_by_folder(links: DataFrame, folder: str, url: str) -> DataFrame:
    """Sorted urls of each folder, one line each. A folder is one output row, as its file is."""
    return links.groupBy(folder).agg(F.array_join(F.array_sort(F.collect_list(url)), "\n").alias("urls"), F.count(F.lit(1)).alias("n"))


def json_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """(name, diff) of the (name, content) rows that both sides have and that differ: a unified diff of the key-sorted text."""
    pairs = left.select("name", F.col("content").alias("a")).join(right.select("name", F.col("content").alias("b")), "name")

    def lines(text: str | None) -> list[str]:
        try:
            return json.dumps(json.loads(text or "null"), indent=2, sort_keys=True, ensure_ascii=False).splitlines()
        except ValueError:
            return (text or "").splitlines()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            diffs = ["\n".join(difflib.unified_diff(lines(x), lines(y), lineterm="")) for x, y in zip(a, b, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(diffs, pa.string())], names=["name", "diff"])

    return pairs.mapInArrow(run, "name string, diff string").filter("diff <> ''")


def _is_container(v: Column) -> Column:
    """Whether a variant is an object or an array that has anything in it."""
    kind = F.schema_of_variant(v)
    return F.coalesce((kind.startswith("OBJECT<") & (kind != "OBJECT<>")) | (kind.startswith("ARRAY<") & (F.to_json(v) != "[]")), F.lit(False))


def json_leaves(documents: DataFrame) -> DataFrame:
    """(name, path, value) of every leaf of (name, content) rows: a scalar, null or empty container as a variant, and its path.

    Containers are exploded level by level, all documents at once, so the rounds are as many as the deepest document has
    levels. Paths read like ``$.rooms[0].price``; keys of other than letters, digits and underscores are quoted. Malformed
    documents and nulls have no leaves.
    """
    spark, found = documents.sparkSession, []
    level = documents.select("name", F.lit("$").alias("path"), F.try_parse_json("content").alias("value")).filter("value IS NOT NULL")
    while True:
        level = written(level.withColumn("is_container", _is_container(F.col("value"))), "json-level")
        found.append(level.filter("NOT is_container").select("name", "path", "value"))
        inner = level.filter("is_container").select("name", "path", F.col("value").alias("container"))
        if inner.isEmpty():
            break
        parts = inner.lateralJoin(spark.tvf.variant_explode(F.col("container").outer()))
        plain = F.col("key").rlike("^[A-Za-z0-9_]+$")
        step = F.when(F.col("key").isNull(), F.concat(F.lit("["), "pos", F.lit("]"))).when(plain, F.concat(F.lit("."), "key")).otherwise(F.concat(F.lit('."'), "key", F.lit('"')))
        level = parts.select("name", F.concat("path", step).alias("path"), "value")
    return reduce(DataFrame.unionByName, found)


def json_changes(left: DataFrame, right: DataFrame) -> DataFrame:
    """(name, path, change, before, after) of the leaves in which (name, content) rows of both sides differ.

    change is added, removed or changed; before and after are JSON text. Numbers are compared by value, so 1 and 1.0 are equal,
    and the order of keys and the white space do not matter. Names that one side lacks, or has malformed, are left out
    (compare_folders tells those); a name has to be unique on each side.
    """
    canon = lambda df, name: df.select("name", F.to_json(F.try_parse_json("content")).alias(name)).filter(F.col(name).isNotNull())
    shared = written(canon(left, "a").join(canon(right, "b"), "name").filter("a <> b").select("name").distinct(), "differing")  # equal ones have no changes
    leaf = lambda df, text, number: json_leaves(df.join(shared, "name", "left_semi")).select(
        "name", "path", F.to_json("value").alias(text), F.when(F.schema_of_variant("value").rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get("value", "$", "double")).alias(number)
    )
    both = leaf(left, "before", "a").join(leaf(right, "after", "b"), ["name", "path"], "full_outer")
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed")
    same = F.col("before").eqNullSafe(F.col("after")) | F.coalesce(F.col("a") == F.col("b"), F.lit(False))
    return both.filter(~same).select("name", "path", change.alias("change"), "before", "after")
