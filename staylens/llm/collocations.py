"""Phrases that occur together, from vertical lists of positions.

Texts are cut into blocks of bounded bytes by language; a block holds, of each of its phrases, the ascending list of the
positions at which it occurs (positions are word numbers of the block with a gap between pieces). Phrases grow by a word a level:
the list of a frequent phrase, moved on by one word, is merge-joined by position with the lists of the frequent phrases that begin
there and share its other words, so a phrase (w1 .. wk) meets (w2 .. wk+1) exactly where its list meets the postings of the adjacent word wk+1. The
length of a phrase's list is its exact frequency in the block. Frequencies of all blocks are added in a shuffle by phrase, which has
a row per block and phrase, and phrases that remain frequent are sent back to their blocks. Only these get lists that are written: most
phrases are rare, so a block's phrases are found once to be counted, without positions and a share of them at a time, and once more for
the lists of the frequent ones. Phrases are named by 64-bit numbers
(the least place, block and number, of a row of theirs), so nothing rests on hashes, and no vocabulary is broadcast.

What a block holds is bounded by ``block_bytes`` (a longer text is a block of its own). A phrase's rows in a shuffle are at most
the number of blocks, however frequent it is.

Nulls: a null text has no words, a null lang is ``und`` (and one with the value ``und``). doc_id is not read; repeated rows count as
often as they stand. Texts without words, empty tables and languages without candidates give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylens.llm.coded_words import coded_words
from staylens.llm.skew import spread_join
from staylens.llm.storage import discard, release, table, written
from staylens.llm.words import LOWER, slices
from staylens.llm.workers import map_batches

LEAST, LONGEST, INSIDE_PERCENT, FIRST = 30, 4, 80, 2000
BLOCK_BYTES = 16_000_000
#: Bits of a phrase's number within its block, and of a block's number within its task.
NUMBER_BITS, BLOCK_BITS = 28, 15
#: Lists and their rows are the bulk of what is written.
LIST_CODEC = "zstd"
#: Tasks that rank a language's phrases before the last one.
RANK_TASKS = 64
#: Shares of a level's phrases that are counted one after the other: the shuffle of a share is gone before that of the next.
ROUNDS = 2

_ENDS = [ord(c) for c in ".,;:!?\n\v\f\r"]
IS_END = np.isin(np.arange(256), _ENDS)
IS_WORD = ~np.isin(np.arange(256), [*_ENDS, 32, 9])

WORD_LISTS = "block long, lang string, words array<string>, lengths array<int>, positions binary"
#: Of the frequent phrases of a block alone.
LISTS = "block long, ids array<long>, lengths array<int>, positions binary"
PHRASES = "block long, lefts array<long>, rights array<long>, places array<long>, lengths array<int>"


def pack(positions: np.ndarray, lengths: np.ndarray) -> bytes:
    """Position lists as differences in seven bits a byte, as inverted indexes keep them; a list starts with its first position."""
    gaps = np.diff(positions, prepend=0)
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    gaps[starts] = positions[starts]
    size = 1 + sum((gaps >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    first = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(5):
        some = size > k
        out[first[some] + k] = ((gaps[some] >> 7 * k) & 127) | np.where(size[some] > k + 1, 128, 0)
    return out.tobytes()


def unpack(packed: bytes, lengths: np.ndarray) -> np.ndarray:
    """The position lists that pack() has packed."""
    data = np.frombuffer(packed, np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    first = np.concatenate([[0], np.flatnonzero(data < 128)[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(first, np.diff(np.append(first, len(data))))
    total = np.cumsum(np.add.reduceat((data & 127).astype(np.int64) << 7 * place, first))
    many = lengths[lengths > 0].astype(np.int64)
    starts = np.cumsum(many) - many
    return total - np.repeat(np.concatenate([[0], total[starts[1:] - 1]]), many)


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of a block of texts, the lengths of their position lists, and these lists one after the other."""
    names, codes, positions, at = [], [], [], 0
    shift = 0
    for part in slices(texts):
        words = coded_words(part, IS_WORD, LOWER)
        if not len(words.codes):
            continue
        piece = np.cumsum(IS_END[part.data])[words.starts] + np.searchsorted(part.offsets, words.starts, "right")
        breaks = np.concatenate([[1], (np.diff(piece) > 0).astype(np.int64)])
        place = at + np.arange(len(piece)) + np.cumsum(breaks)
        at = int(place[-1]) + 1
        names.append(words.names)
        codes.append(words.codes + shift)
        positions.append(place)
        shift += len(words.names)
    if not names:
        return pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, np.int64)
    merged = pa.concat_arrays(names).dictionary_encode()
    codes = merged.indices.to_numpy()[np.concatenate(codes)]
    used, number = np.unique(codes, return_inverse=True)
    order = np.argsort(number, kind="stable")
    return merged.dictionary.take(pa.array(used)).cast(pa.string()), np.bincount(number).astype(np.int32), np.concatenate(positions)[order]


def _number(task: int, k: int) -> int:
    return (task << BLOCK_BITS) + k


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """WORD_LISTS of the rows of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get().partitionId(), 0
        waiting: dict[str, list[pa.Array]] = defaultdict(list)
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal k, held
            for lang in sorted(waiting):
                names, lengths, positions = word_lists(pa.chunked_array(waiting[lang], pa.string()).combine_chunks())
                if len(names):
                    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (names, pa.array(lengths))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([_number(task, k)]), pa.array([lang]), *lists, pa.array([pack(positions, lengths)], pa.binary())],
                        names=["block", "lang", "words", "lengths", "positions"],
                    )
                    k += 1
            waiting.clear()
            held = 0

        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            numbers = langs.indices.to_numpy()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                waiting[lang].append(batch.column("text").take(pa.array(np.flatnonzero(numbers == i))))
            held += batch.column("text").nbytes
            if held >= block_bytes:
                yield from flush()
        yield from flush()

    lang, text = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    return docs.select(lang, text).filter(F.col("text").isNotNull()).transform(map_batches, run, WORD_LISTS)


def extended(lengths: np.ndarray, positions: np.ndarray, known: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(left ids, right ids, list lengths, positions) of what begins with one frequent phrase and goes on with another.

    known are numbers of the frequent phrases among the block's lists, ascending, and ids their names.
    """
    name = np.zeros(len(lengths), np.int64)
    name[known] = np.arange(1, len(known) + 1)
    of = np.repeat(name, lengths)
    of, at = of[of > 0] - 1, positions[of > 0]
    order = np.argsort(at, kind="stable")
    of, at = of[order], at[order]
    # Merge join by position: of the lists, each moved on by one, with the lists themselves. A position holds one phrase of a length.
    meets = np.flatnonzero(at[1:] == at[:-1] + 1)
    pair = of[meets] * len(known) + of[meets + 1]
    order = np.argsort(pair, kind="stable")  # positions ascend within a pair
    pair, place = pair[order], at[meets][order]
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
    return ids[pair[first] // max(1, len(known))], ids[pair[first] % max(1, len(known))], np.diff(np.append(first, len(pair))).astype(np.int32), place


def _frequent(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    """rows (keys, place, n) of phrases with n >= least in all, with that sum f and their name id."""
    own = Window.partitionBy(*keys)
    return rows.withColumn("f", F.sum("n").over(own)).filter(F.col("f") >= least).withColumn("id", F.min("place").over(own)).drop("n")


def _words(lists: DataFrame) -> DataFrame:
    """A row (lang, word, place, n) of each list of each block of WORD_LISTS."""
    place = (F.shiftleft(F.col("block"), NUMBER_BITS) + F.col("pos")).alias("place")
    zipped = lists.select("block", "lang", F.posexplode(F.arrays_zip("words", "lengths")))
    return zipped.select("lang", F.col("col.words").alias("word"), place, F.col("col.lengths").cast("long").alias("n"))


def _by_block(lists: DataFrame, frequent: DataFrame) -> DataFrame:
    """A level's lists with ``known``, the numbers and ids of the frequent rows (place, id) of their block."""
    block, number = F.shiftright("place", NUMBER_BITS).alias("block"), F.col("place").bitwiseAND((1 << NUMBER_BITS) - 1).alias("number")
    back = frequent.select(block, F.struct(number, "id").alias("own")).groupBy("block").agg(F.sort_array(F.collect_list("own")).alias("known"))
    return lists.join(back, "block")


def _numbers(batch: pa.RecordBatch, i: int, name: str) -> np.ndarray:
    return batch.column(name).slice(i, 1).flatten().to_numpy(zero_copy_only=False)


def _record(block: pa.Array, lists: dict[str, np.ndarray], **more: pa.Array) -> pa.RecordBatch:
    """One row of a block, its lists and further columns."""
    lists = {name: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for name, x in lists.items()}
    return pa.RecordBatch.from_pydict({"block": block} | lists | more)


def _grown(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """extended() of the i-th block of LISTS."""
    ids, lengths = _numbers(batch, i, "ids"), _numbers(batch, i, "lengths")
    return extended(lengths, unpack(batch.column("positions")[i].as_py(), lengths), np.arange(len(ids)), ids)


def _kept(lists: DataFrame, frequent: DataFrame, grow: bool) -> DataFrame:
    """LISTS of the frequent rows (place, id): of these lists, or of what grows from them by a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                known = batch.column("known").slice(i, 1).flatten().flatten()
                number, ids = (x.to_numpy(zero_copy_only=False) for x in known)
                if grow:
                    _, _, lengths, positions = _grown(batch, i)
                else:
                    lengths = _numbers(batch, i, "lengths")
                    positions = unpack(batch.column("positions")[i].as_py(), lengths)
                own = np.zeros(len(lengths), bool)
                own[number] = True
                positions = positions[np.repeat(own, lengths)]
                yield _record(batch.column("block").slice(i, 1), {"ids": ids, "lengths": lengths[number]}, positions=pa.array([pack(positions, lengths[number])], pa.binary()))

    columns = ["block", "lengths", "positions", *(["ids"] if grow else [])]
    return _by_block(lists.select(*columns), frequent).transform(map_batches, run, LISTS)


def _round(lefts: np.ndarray, rights: np.ndarray, rounds: int) -> np.ndarray:
    """In which round a phrase is counted, the same in all blocks."""
    mixed = (lefts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + rights.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(40)).astype(np.int64) % rounds


def _phrases(lists: DataFrame, rounds: int, turn: int) -> DataFrame:
    """A row (left, right, place, n) of each phrase of each block of one word more than those of LISTS, of one of the rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lefts, rights, many, _ = _grown(batch, i)
                own = np.flatnonzero(_round(lefts, rights, rounds) == turn)
                if len(own):
                    places = (batch.column("block")[i].as_py() << NUMBER_BITS) + own
                    yield _record(batch.column("block").slice(i, 1), {"lefts": lefts[own], "rights": rights[own], "places": places, "lengths": many[own]})

    zipped = lists.transform(map_batches, run, PHRASES).select(F.explode(F.arrays_zip("lefts", "rights", "places", "lengths")).alias("x"))
    return zipped.select(F.col("x.lefts").alias("left"), F.col("x.rights").alias("right"), F.col("x.places").alias("place"), F.col("x.lengths").cast("long").alias("n"))


def _spelled(phrases: DataFrame, shorter: DataFrame) -> DataFrame:
    """Frequent (left, right, id, f) with their text and the frequencies of all their beginnings and ends, by length."""
    phrases = phrases.select("id", "left", "right", "f")
    ends = lambda side, *columns: shorter.select(F.col("id").alias(side), *columns)
    own = F.array("f")
    left = spread_join(phrases, ends("left", "lang", F.col("phrase").alias("start"), "begins"), "left", "id")
    both = spread_join(left, ends("right", F.col("word").alias("next"), F.col("ends").alias("tails")), "right", "id")
    return both.select(
        "lang", "id", "left", "right", "f", F.concat_ws(" ", "start", "next").alias("phrase"), F.col("next").alias("word"),
        F.concat("begins", own).alias("begins"), F.concat("tails", own).alias("ends"),
    )


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """Tables (lang, id, left, right, f, phrase, word, begins, ends) of the frequent phrases of 1, 2, .. words.

    left and right name the phrase without its last and its first word, begins and ends hold the frequencies of the phrase's first
    and last 1, 2, .. words, itself included.
    """
    return _mined(docs, least, longest, block_bytes)[0]


def _mined(docs: DataFrame, least: int, longest: int, block_bytes: int, rounds: int = ROUNDS) -> tuple[list[DataFrame], DataFrame]:
    lists = written(blocks(docs, block_bytes), "word-lists", LIST_CODEC)
    words = _words(lists)
    totals = written(words.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    rows = written(_frequent(words, ["lang", "word"], least), "words", LIST_CODEC)
    parts = [rows]
    none = F.lit(None).cast("long")
    one = rows.filter(F.col("id") == F.col("place")).select(
        "lang", "id", none.alias("left"), none.alias("right"), "f", F.col("word").alias("phrase"), "word", F.array("f").alias("begins"), F.array("f").alias("ends")
    )
    found = [written(one, "phrases-1")]
    for k in range(2, longest + 1):
        release(docs.sparkSession)
        kept = written(_kept(lists, rows, k > 2), "lists", LIST_CODEC)
        discard(lists, *parts)
        lists, parts = kept, []
        for turn in range(rounds):
            parts.append(written(_frequent(_phrases(lists, rounds, turn), ["left", "right"], least), "phrases", LIST_CODEC))
            release(docs.sparkSession)
        rows = reduce(DataFrame.unionByName, parts)
        found.append(written(_spelled(rows.filter(F.col("id") == F.col("place")).drop("place"), found[-1]), f"phrases-{k}"))
    discard(lists, *parts)
    return found, totals


def score(a: Column, begins: Column, ends: Column, words: int) -> Column:
    """(score, l, r) of the lowest-scoring cut of phrases of so many words, the earliest of equal ones."""
    cuts = []
    for k in range(1, words):
        l, r = begins[k - 1], ends[words - k - 1]  # noqa: E741
        wide = lambda c: c.cast("decimal(20,0)")
        cuts.append(F.struct(F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * wide(a), wide(l) + wide(r)).cast("long").alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
    return F.least(*cuts) if len(cuts) > 1 else cuts[0]


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, inside_percent: int = INSIDE_PERCENT, first: int = FIRST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each language's first phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase inside a longer one that has ``inside_percent`` of its occurrences is dropped. A phrase of one word more lies between it
    and any longer one and is at least as frequent, so phrases of one word more decide.
    """
    found, totals = _mined(docs, least, longest, block_bytes)
    kept = []
    for words in range(2, longest + 1):
        own = found[words - 1].select("lang", "id", "phrase", F.col("f").alias("a"), score(F.col("f"), F.col("begins"), F.col("ends"), words).alias("cut"))
        if words < longest:
            longer = found[words]
            inside = longer.select(F.col("left").alias("id"), "f").unionByName(longer.select(F.col("right").alias("id"), "f")).groupBy("id").agg(F.max("f").alias("around"))
            own = own.join(inside, "id", "left").filter(F.coalesce(F.lit(100) * F.col("around") < F.lit(inside_percent) * F.col("a"), F.lit(True)))
        kept.append(own.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    every = kept[0]
    for more in kept[1:]:
        every = every.unionByName(more)
    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = every.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_TASKS)))
    best = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*by))).filter(F.col("rank") <= first)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by)).cast("long")).filter(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    """Contract query: each language's first 2000 phrases of 2 to 4 words."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, ws[i:i + k - 1] AS phrase, k FROM s CROSS JOIN (VALUES (1), (2), (3), (4)) AS t(k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, phrase, k, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT x.lang, x.phrase, x.k, x.a, y.a AS l, z.a AS r, y.k AS cut, (2000000::HUGEINT * x.a // (y.a + z.a))::BIGINT AS score
      FROM f x, LATERAL (SELECT unnest(range(1, x.k)) AS at) t JOIN f y ON y.lang = x.lang AND y.phrase = x.phrase[:t.at]
      JOIN f z ON z.lang = x.lang AND z.phrase = x.phrase[t.at + 1:] WHERE x.k > 1),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (SELECT lang, phrase[i:i + m - 1] AS phrase, max(a) AS most FROM (
      SELECT lang, phrase, a, k, m, unnest(range(1, k - m + 2)) AS i FROM f CROSS JOIN (VALUES (2), (3)) AS t(m) WHERE m < k) GROUP BY ALL),
kept AS (SELECT b.* FROM b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase WHERE coalesce(100 * o.most < 80 * b.a, true)),
named AS (SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, score FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named) JOIN n USING (lang) WHERE rank <= 2000
"""
