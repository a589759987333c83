"""Word segmentation by a unigram lattice: the cheapest path over words and terms whose costs are learnt from the corpus.

A text is a row of tokens, runs of word characters and single other signs. Between two words that stand side by side a term of
several words may span; its cost is the negative logarithm of its share of all words, in millionths, plus ``penalty`` for each word
that it joins. The cheapest path through a text's lattice (Viterbi) is its segmentation, where words of a term are joined by
underscores. So words are joined that occur together much more often than their frequencies alone would have it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from staylens.storage import written

TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
LONGEST, LEAST, MAX_WORDS, MAX_TERMS, PENALTY = 3, 20, 100_000, 50_000, 3_000_000
#: Tokens that are counted together before they are shuffled.
CHUNK = 1_000_000
#: Bytes of text that are taken at once; a longer text is taken alone.
PIECE = 1_000_000
#: Runs of more words take their path one by one, the others side by side.
LONG_RUN = 1_000
#: Above the cost of any path.
_NONE = 1 << 60


def kinds(spark: SparkSession) -> np.ndarray:
    """Of each code point 2 if it is one of a word's, 1 if another sign, 0 if white space, as Spark's expressions take it."""
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    df = spark.createDataFrame([(points[i : i + 4096],) for i in range(0, len(points), 4096)], "x string")
    out = np.zeros(0x110000, np.uint8)
    for row in df.select(F.regexp_replace("x", r"[\p{L}\p{N}_\s]+", ""), F.regexp_replace("x", r"[^\p{L}\p{N}_]+", "")).collect():
        for kind, found in enumerate(row, 1):
            out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return out


class Tokens(NamedTuple):
    """Tokens of rows one after the other as codes, their names by code, the rows' bounds, and the run of words each is in (else -1)."""

    codes: np.ndarray
    names: pa.Array
    bounds: np.ndarray
    runs: np.ndarray


def token_lists(texts: pa.Array, kind_of: np.ndarray) -> pa.ListArray:
    """Tokens of each text, whose code points are looked up in kinds(): an expression of Spark's makes an object of each token."""
    rows = [x.decode("utf-8", "replace") if x else "" for x in texts.cast(pa.binary()).to_pylist()]
    text = "\n".join([*rows, ""])
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = kind_of[points]
    word, sign, kept = kind == 2, kind == 1, kind > 0
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    starts, ends = np.flatnonzero(first | sign), np.flatnonzero(last | sign) + 1
    size = 1 + (points >= 0x80).astype(np.uint8) + (points >= 0x800) + (points >= 0x10000)
    before = np.concatenate([[0], np.cumsum(np.where(kept, size, 0), dtype=np.int64)])
    data = np.frombuffer(text.encode(), np.uint8)[np.repeat(kept, size)]
    offsets = np.concatenate([[0], before[ends]]).astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
    bounds = np.concatenate([[0], np.searchsorted(starts, np.cumsum([len(x) + 1 for x in rows]))])
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), found)


def coded(rows: pa.ListArray) -> Tokens:
    found = rows.flatten().dictionary_encode()
    codes = found.indices.to_numpy().astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(rows).to_numpy())])
    kinds = np.array([t[0] == "_" or t[0].isalnum() for t in found.dictionary.to_pylist()], bool)
    is_word = kinds[codes] if len(codes) else np.zeros(0, bool)
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    firsts = bounds[:-1][bounds[:-1] < len(codes)]
    begins[firsts] = is_word[firsts]
    return Tokens(codes, found.dictionary, bounds, np.where(is_word, np.cumsum(begins) - 1, -1))


def pieces(batches: Iterator[pa.RecordBatch], text: str, kind_of: np.ndarray) -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
    """The batches' rows, with their tokens, in batches of at most PIECE bytes of text or of one row: a batch of Spark's may hold
    millions of tokens, and a worker's arrays hold a few hundred bytes for each."""
    for batch in batches:
        ends, at, done = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(), dtype=np.int64), 0, 0
        while at < len(ends):
            stop = max(at + 1, int(np.searchsorted(ends, done + PIECE, "right")))
            piece = batch.slice(at, stop - at)
            yield piece, token_lists(piece.column(text), kind_of)
            at, done = stop, ends[stop - 1]


def _counted(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    """(term, words, n) of the terms of a few batches at a time, each once."""

    def counts(waiting: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        found = coded(pa.concat_arrays(waiting))
        ids, names = found.codes, []  # of the terms that begin at a token, and the words of each
        at = np.flatnonzero(found.runs >= 0)
        for k in range(1, longest + 1):
            if k > 1:
                at = at[at + k - 1 < len(found.codes)]
                at = at[found.runs[at + k - 1] == found.runs[at]]
            if not len(at):
                return
            keys, first, number, n = np.unique(ids[at] * len(found.names) + found.codes[at + k - 1] if k > 1 else ids[at], return_index=True, return_inverse=True, return_counts=True)
            ids = np.full(len(found.codes), -1)
            ids[at] = number
            names = [found.names.take(pa.array(found.codes[at[first] + j])) for j in range(k)]
            term = pc.binary_join_element_wise(*names, " ") if k > 1 else names[0]
            yield pa.RecordBatch.from_arrays([term, pa.array(np.full(len(keys), k, np.int32)), pa.array(n.astype(np.int64))], names=["term", "words", "n"])

    waiting, held = [], 0
    for batch in batches:
        waiting.append(batch.column("tokens"))
        held += len(waiting[-1].flatten())
        if held >= CHUNK:
            yield from counts(waiting)
            waiting, held = [], 0
    if held:
        yield from counts(waiting)


def _counted_texts(batches: Iterator[pa.RecordBatch], longest: int, kind_of: np.ndarray) -> Iterator[pa.RecordBatch]:
    lists = (pa.RecordBatch.from_arrays([found], names=["tokens"]) for _, found in pieces(batches, "text", kind_of))
    yield from _counted(lists, longest)


def learn_terms(df: DataFrame, text: str, longest: int = LONGEST, least: int = LEAST, max_words: int = MAX_WORDS, max_terms: int = MAX_TERMS, penalty: int = PENALTY) -> DataFrame:
    """(term, words, cost) of the lattice: the ``max_words`` most frequent words, and of each length from 2 words to ``longest``
    the ``max_terms`` most frequent terms that occur ``least`` times (parameters that bound the model, ties by term).

    Costs are whole numbers, so paths compare exactly. Terms are in lower case and never span a sign.
    """
    kind_of = df.sparkSession.sparkContext.broadcast(kinds(df.sparkSession))
    counts = df.select(F.lower(text).alias("text")).mapInArrow(lambda batches: _counted_texts(batches, longest, kind_of.value), "term string, words int, n long")
    # Dealt first: a chunk has each term once, so a sum before the shuffle would hold all and save few.
    summed = counts.repartition("term").groupBy("term", "words").agg(F.sum("n").alias("n")).filter((F.col("words") == 1) | (F.col("n") >= least))
    counted = written(summed, "terms")  # read for the total and for the ranks
    total = counted.filter("words = 1").agg(F.sum("n").alias("total"))
    ranked = counted.filter((F.col("words") == 1) | (F.col("n") >= least))
    most = F.when(F.col("words") == 1, max_words).otherwise(max_terms)
    # Of each task's share first, so that the last rank sees no more than the model may hold from each.
    for part in ([F.pmod(F.xxhash64("term"), F.lit(64))], []):
        ranked = ranked.withColumn("rank", F.row_number().over(Win.partitionBy("words", *part).orderBy(F.desc("n"), "term"))).filter(F.col("rank") <= most)
    cost = F.round((F.ln("total") - F.ln("n")) * 1_000_000).cast("long") + penalty * (F.col("words") - 1)
    return ranked.join(F.broadcast(total)).select("term", "words", cost.alias("cost"))  # total: one row


def best_path(words: list[str], costs: dict[str, int], longest: int, unknown: int) -> list[int]:
    """Numbers of words of the pieces of the cheapest path; of equal ones those whose last pieces are the shorter."""
    best, back = [0], [0]
    for i in range(1, len(words) + 1):
        least, size = best[i - 1] + costs.get(words[i - 1], unknown), 1
        for k in range(2, min(longest, i) + 1):
            cost = costs.get(" ".join(words[i - k : i]))
            if cost is not None and best[i - k] + cost < least:
                least, size = best[i - k] + cost, k
        best.append(least)
        back.append(size)
    pieces, i = [], len(words)
    while i:
        pieces.append(back[i])
        i -= back[i]
    return pieces[::-1]


class Model(NamedTuple):
    """Costs of terms, by term and as a trie: a term is found from the one without its last word, in ``keys`` of its length (number
    of the shorter one times the number of words, and the last word), and has the cost at its place there."""

    costs: dict[str, int]
    unknown: int
    words: dict[str, int]
    single: np.ndarray
    keys: list[np.ndarray]
    more: list[np.ndarray]


def model(costs: dict[str, int]) -> Model:
    unknown = max((c for k, c in costs.items() if " " not in k), default=0)
    split = [(tuple(k.split(" ")), c) for k, c in costs.items()]
    words = {w: i for i, w in enumerate(sorted({w for k, _ in split for w in k}))}
    single = np.full(len(words) + 1, unknown, np.int64)  # the last stands for all other words
    for k, c in split:
        if len(k) == 1:
            single[words[k[0]]] = c
    number, keys, more = {(w,): i for w, i in words.items()}, [], []
    for size in range(2, max((len(k) for k, _ in split), default=1) + 1):
        own = dict.fromkeys((k[:size] for k, _ in split if len(k) > size), _NONE) | {k: c for k, c in split if len(k) == size}
        placed = sorted((number[k[:-1]] * len(single) + words[k[-1]], k, c) for k, c in own.items())
        number = {k: i for i, (_, k, _) in enumerate(placed)}
        keys.append(np.array([x[0] for x in placed], np.int64))
        more.append(np.array([x[2] for x in placed], np.int64))
    return Model(costs, unknown, words, single, keys, more)


def _costs(found: Tokens, lower: list[str], m: Model) -> list[np.ndarray]:
    """Of each token and length, the cost of the term of so many words that ends with it."""
    word = np.array([m.words.get(w, len(m.single) - 1) for w in lower], np.int64)[found.codes]
    out, at, number = [m.single[word]], np.arange(len(word)), word
    for k, (keys, costs) in enumerate(zip(m.keys, m.more, strict=True), 2):
        inside = at + k - 1 < len(word)
        at, number = at[inside], number[inside]
        same = (found.runs[at] >= 0) & (found.runs[at + k - 1] == found.runs[at])
        at, number = at[same], number[same]
        wanted = number * len(m.single) + word[at + k - 1]
        place = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
        hit = keys[place] == wanted if len(keys) else np.zeros(len(at), bool)
        at, number = at[hit], place[hit]
        cost = np.full(len(word), _NONE)
        cost[at + k - 1] = costs[number]
        out.append(cost)
    return out


def joined(found: Tokens, m: Model) -> np.ndarray:
    """Which tokens are joined with the one before: best_path() of all runs side by side."""
    lower = [t.lower() for t in found.names.to_pylist()]
    out = np.zeros(len(found.codes), bool)
    at = np.flatnonzero(found.runs >= 0)
    if not len(at):
        return out
    start, size = at[np.flatnonzero(np.diff(found.runs[at], prepend=-1))], np.bincount(found.runs[at])
    for a, n in zip(start[size > LONG_RUN].tolist(), size[size > LONG_RUN].tolist(), strict=True):
        for pieces in best_path([lower[c] for c in found.codes[a : a + n].tolist()], m.costs, len(m.keys) + 1, m.unknown):
            out[a + 1 : a + pieces] = True
            a += pieces
    order = np.argsort(-size, kind="stable")
    order = order[size[order] <= LONG_RUN]
    start, size = start[order], size[order]
    costs, back = _costs(found, lower, m), np.ones(len(found.codes), np.int64)
    best = [np.zeros(len(start), np.int64)]
    for j in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -j, "left"))  # runs of more than j words
        here = start[:n] + j
        least = best[-1][:n] + costs[0][here]
        for k in range(2, min(len(costs), j + 1) + 1):
            cost = best[-k][:n] + costs[k - 1][here]
            back[here[cost < least]] = k
            least = np.minimum(least, cost)
        best = [*best[-len(costs) :], least]
    left = size.copy()
    while len(left):
        end = start + left - 1
        pieces = back[end]
        for k in range(1, len(costs)):
            out[end[pieces > k] - (k - 1)] = True
        left = left - pieces
        start, left = start[left > 0], left[left > 0]
    return out


def segmented(rows: pa.ListArray, m: Model) -> pa.Array:
    """Tokens of each row with a space between pieces and underscores within them."""
    found = coded(rows)
    between = np.where(joined(found, m), 2, 1)
    between[found.bounds[:-1][found.bounds[:-1] < len(between)]] = 0
    parts = pc.binary_join_element_wise(pa.array(["", " ", "_"]).take(pa.array(between)), found.names.take(pa.array(found.codes)), "")
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(found.bounds.astype(np.int32)), parts), "")


def _segmented_batches(batches: Iterator[pa.RecordBatch], text: str, name: str, m: Model, kind_of: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch, found in pieces(batches, text, kind_of):
        yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in batch.schema.names} | {name: segmented(found, m)})


def segment_lattice(df: DataFrame, text: str, terms: DataFrame, name: str = "word_segmented") -> DataFrame:
    """df with the segmentation of a text column by learn_terms(); null and blank texts give an empty one.

    The terms are sent to every executor: learn_terms() bounds their number. A word without a cost costs as one that occurs once.
    """
    costs = {r["term"]: r["cost"] for r in terms.select("term", "cost").toLocalIterator()}
    sent = df.sparkSession.sparkContext.broadcast((model(costs), kinds(df.sparkSession)))
    schema = df.withColumn(name, F.lit("")).schema

    return df.mapInArrow(lambda batches: _segmented_batches(batches, text, name, *sent.value), schema)
