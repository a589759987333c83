"""Quality rules and cross-document line frequency, in Spark SQL functions only.

Base rules look at one text. The line rule hashes every normalised line (lower case, white space runs as one
space, trimmed), counts the documents of a host that hold it and takes a line out where that count is above
``limit = max(min_texts, share * the host's documents)``. A document of which such lines make up more than half of the words
is depleted and rejected. Documents with equal texts count as one, so copying a document does not make its lines frequent
(and near-dedup, not this rule, decides on copies).

Documents are read once into a table of figures and line hashes in the shared folder; counts, limits and verdicts come from it.
Windows of 3 words are compared by 64-bit hashes.

Nulls: a null text has no words and fails the base rules; a null host is a host of its own; null ids are kept.
Repeated rows all get the same verdict. Extra columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.names import any_names
from staylens.llm.storage import table, written

BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
_BLANK_CHARS = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50
MIN_TEXTS = 20
HOST_SHARE = 0.05
DEPLETED_PERCENT = 50


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value bound as a lambda variable, so it is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def window_hashes(words: Column) -> Column:
    """A hash of each 3 consecutive words."""
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))


def places_by_hash(hashes: Column) -> Column:
    """Places of the windows in the order of their hashes, none if no hash is there twice: the low bits of a number are the place,
    the others the hash's, so plain numbers are sorted."""
    low = _low_bits(hashes)
    packed = F.transform(hashes, lambda h, i: h.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), packed).otherwise(F.array().cast("array<bigint>"))


def _low_bits(hashes: Column) -> Column:
    """Ones as wide as the places need."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(F.size(hashes) + 1))).cast("long") - 1


def covered_words(hashes: Column, ordered: Column) -> Column:
    """Words that lie in a window found twice or more, from the ordered places."""

    def count(low: Column) -> Column:
        at = lambda x: F.get(hashes, x.bitwiseAND(low).cast("int"))
        same = lambda x, j: F.coalesce(at(F.get(ordered, j)) == at(x), F.lit(False))
        hit = F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1))
        places = F.sort_array(F.transform(hit, lambda x: x.bitwiseAND(low)))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last"))
        step = lambda a, i: F.struct((a["n"] + F.least(F.lit(3).cast("long"), i - a["last"])).alias("n"), i.alias("last"))
        return F.aggregate(places, start, step, lambda a: a["n"])

    return F.when(F.size(ordered) == 0, F.lit(0).cast("long")).otherwise(_let(_low_bits(hashes), count))


def base_stats(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, row_key, the per-text figures of each row, and more as named by their alias."""
    own = docs.select(row_key().alias("row_key"), "doc_id", "text", *more).columns[3:]
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    return (
        docs.select("doc_id", row_key().alias("row_key"), text.alias("text"), *more)
        .select(
            "doc_id",
            "row_key",
            *own,
            split_words(F.col("text")).alias("words"),
            F.length(_without(F.col("text"), _BLANK_CHARS)).cast("long").alias("word_chars"),
            (F.length("text") - F.length(_without(F.col("text"), _SYMBOLS))).cast("long").alias("n_symbols"),
            lines.alias("lines_in"),
        )
        .select(
            "doc_id",
            "row_key",
            *own,
            F.size("words").cast("long").alias("n_words"),
            "word_chars",
            "n_symbols",
            (F.size("lines_in") - F.size(F.array_distinct("lines_in"))).cast("long").alias("n_dup_lines"),
            window_hashes(F.col("words")).alias("hashes"),
        )
        .select("doc_id", "row_key", *own, *figures, "hashes", F.sort_array(places_by_hash(F.col("hashes"))).alias("ordered"))
        .select("doc_id", "row_key", *own, *figures, covered_words(F.col("hashes"), F.col("ordered")).alias("n_repeat_words"))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT),
        )
    )


def row_key() -> Column:
    """Tells rows apart (with doc_id); repeated rows share it."""
    return F.xxhash64("source", "text")


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), BLANKS, " "))


def facts(docs: DataFrame) -> DataFrame:
    """base_stats() of each row with its host, the key of its text, and the hash and number of words of each line; written."""
    normal = F.filter(F.transform(F.split("text", "\n"), normal_line), lambda x: x != "")
    lines = F.transform(normal, lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(F.split(x, " ")).cast("long").alias("n")))
    host = F.coalesce(F.concat(F.lit("h:"), F.col("source").cast("string")), F.lit("null"))
    return written(base_stats(docs, host.alias("host"), F.xxhash64("text").alias("text_key"), lines.alias("lines")), "lines")


def frequent_lines(known: DataFrame, min_texts: int = MIN_TEXTS, share: float = HOST_SHARE) -> DataFrame:
    """host, line and number of texts of the lines above the limit.

    A line of a third of all rows is pre-aggregated on the map side; no task gathers its rows.
    """
    hosts = known.select("host", "text_key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_texts"))
    limit = F.greatest(F.lit(float(min_texts)), F.col("host_texts") * share)
    lines = known.select("host", "text_key", F.explode(F.array_distinct("lines.line")).alias("line"))
    counted = lines.distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("texts")).filter(F.col("texts") > min_texts)
    return counted.join(hosts, "host").filter(F.col("texts") > limit).select("host", "line", "texts")


def line_removals(known: DataFrame, min_texts: int = MIN_TEXTS, share: float = HOST_SHARE) -> DataFrame:
    """doc_id, row_key, removed_words and the hashes of the removed lines, of rows that lose any."""
    lines = known.select("host", "doc_id", "row_key", F.posexplode("lines").alias("pos", "x")).select("host", "doc_id", "row_key", "pos", "x.line", "x.n")
    return (
        lines.join(frequent_lines(known, min_texts, share).select("host", "line"), ["host", "line"])
        .groupBy("doc_id", "row_key", "pos")
        .agg(F.max("n").alias("n"), F.max("line").alias("line"))
        .groupBy("doc_id", "row_key")
        .agg(F.sum("n").alias("removed_words"), F.collect_set("line").alias("removed_lines"))
    )


def _verdicts(docs: DataFrame, min_texts: int, share: float) -> DataFrame:
    known = facts(docs)
    stats, gone = known.drop("lines", "host", "text_key").alias("s"), line_removals(known, min_texts, share).alias("g")
    on = F.col("s.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("s.row_key") == F.col("g.row_key"))
    removed = F.coalesce(F.col("removed_words"), F.lit(0))
    kept = ~F.col("base_failed") & (removed * 100 <= F.col("n_words") * DEPLETED_PERCENT)
    return stats.join(gone, on, "left").select("s.*", removed.alias("removed_words"), "removed_lines", kept.alias("kept"))


def judge(docs: DataFrame, min_texts: int = MIN_TEXTS, share: float = HOST_SHARE) -> DataFrame:
    """One row per row of docs: the figures, base_failed, removed_words and kept."""
    return _verdicts(docs, min_texts, share).drop("row_key", "removed_lines")


@any_names
def filter_documents(docs: DataFrame, min_texts: int = MIN_TEXTS, share: float = HOST_SHARE) -> DataFrame:
    """docs without the rejected rows, and without the lines above the limit in the kept ones; same columns."""
    kept = _verdicts(docs, min_texts, share).filter("kept").groupBy("doc_id", "row_key").agg(F.first("removed_lines").alias("removed_lines")).alias("k")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), row_key().alias("row_key")).alias("d")
    on = F.col("d.row.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.row_key") == F.col("k.row_key"))
    left = F.array_join(
        F.filter(
            F.split("row.text", "\n"), lambda x: ~F.array_contains(F.col("removed_lines"), F.xxhash64(normal_line(x)))
        ),
        "\n",
    )
    text = F.when(F.col("removed_lines").isNull(), F.col("row.text")).otherwise(left)
    return rows.join(kept, on).select(*[text.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def op7_line_quality(spark, sf_dir: str) -> DataFrame:
    """Contract query: the figures and the verdict of every document."""
    return judge(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, p.i AS i, words[p.i] || ' ' || words[p.i + 1] || ' ' || words[p.i + 2] AS g
      FROM w, LATERAL (SELECT unnest(range(1, len(words) - 1)) AS i) p),
h AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM h, (SELECT unnest([0, 1, 2]) AS o) GROUP BY doc_id),
l AS (SELECT doc_id, source, text, trim(regexp_replace(lower(x), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS line
      FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS x FROM d)),
n AS (SELECT source, line, count(DISTINCT text) AS texts FROM l WHERE line <> '' GROUP BY source, line),
t AS (SELECT source, count(DISTINCT text) AS host_texts FROM d GROUP BY source),
f AS (SELECT n.source, n.line FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source
      WHERE n.texts > greatest({float(MIN_TEXTS)}, host_texts * {HOST_SHARE}::DOUBLE)),
r AS (SELECT l.doc_id, sum(len(string_split(l.line, ' '))) AS removed_words
      FROM l JOIN f ON l.source IS NOT DISTINCT FROM f.source AND l.line = f.line GROUP BY l.doc_id),
b AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(removed_words, 0)::BIGINT AS removed_words
      FROM w LEFT JOIN c ON c.doc_id = w.doc_id LEFT JOIN r ON r.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words) AS base_failed, removed_words,
  (NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words) AND removed_words * 100 <= n_words * {DEPLETED_PERCENT}) AS kept
FROM b
"""
