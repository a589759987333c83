"""Periodic runs of the words of whole texts: a suffix automaton with ordered end positions, merged small to large.

A run is a stretch of consecutive words with smallest period q and at least max(``least``, 2 q) words that no neighbouring
word extends with the same period. The words of a run but for its first q are repetitions; collapsed() drops them.

Each text is a task's own work, so nothing is shuffled. A run of ``least`` words or more has half of ``least`` consecutive words
that stand a period further on again, at every place: words that no window of so many words covers which the text holds
twice are in no run, and a run is never longer than the stretch between such words. The automaton is built of the other
stretches, each alone (windows are compared by hashes, which can only add a stretch).

Nulls: a null text has no words; a row with a null doc_id is kept and reads as it stands. Repeated rows get equal results,
extra columns are ignored, an empty table gives no rows. Texts without runs have n_runs 0 and nulls for the longest run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.coded_words import coded_words
from staylens.llm.storage import table
from staylens.llm.suffix_automaton import runs
from staylens.llm.words import BLANK_SPLIT, mix, slices
from staylens.llm.workers import map_batches

#: Words of the shortest run.
LEAST = 12
RESULT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
#: Row numbers and places (text number, start of its words, number of words) -> place that each word is read from.
Rewrite = Callable[[object, int], np.ndarray | None]


def stretches(codes: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> Iterator[tuple[int, int]]:
    """Word ranges, by place, that hold every run of at least ``least`` words."""
    k = least // 2
    n = len(codes) - k + 1
    if n < 2:
        return
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    letters = mix(codes.astype(np.uint64))
    rolled = mix(letters[:n] ^ owner[:n].astype(np.uint64))
    for j in range(1, k):
        rolled = mix(rolled ^ letters[j : j + n])
    whole = np.flatnonzero(owner[:n] == owner[k - 1 :])
    order = whole[np.argsort(rolled[whole])]
    ranked = rolled[order]
    twice = np.zeros(len(order), bool)
    same = ranked[1:] == ranked[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    at = order[twice]
    depth = np.zeros(len(codes) + 1, np.int32)
    np.add.at(depth, at, 1)
    np.add.at(depth, at + k, -1)
    covered = np.cumsum(depth)[:-1] > 0
    starts = covered.copy()
    starts[1:] &= ~covered[:-1] | (owner[1:] != owner[:-1])
    ends = covered.copy()
    ends[:-1] &= ~covered[1:] | (owner[1:] != owner[:-1])
    for a, b in zip(np.flatnonzero(starts).tolist(), (np.flatnonzero(ends) + 1).tolist(), strict=True):
        if b - a >= least:
            yield a, b


def runs_of_texts(codes: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Of each text, (start, length, period) of its runs by start and period; starts are word numbers of the text."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(bounds) - 1)]
    for a, b in stretches(codes, bounds, least):
        text = int(np.searchsorted(bounds, a, "right")) - 1
        shift = a - int(bounds[text])
        found[text] += [(start + shift, n, q) for start, n, q in runs(codes[a:b].tolist(), least)]
    return found


def repetitions(found: list[list[tuple[int, int, int]]], bounds: np.ndarray) -> np.ndarray:
    """Of each word whether a run contains it after its first period."""
    depth = np.zeros(int(bounds[-1]) + 1, np.int32)
    for first, own in zip(bounds[:-1].tolist(), found, strict=True):
        for start, n, q in own:
            depth[first + start + q] += 1
            depth[first + start + n] -= 1
    return np.cumsum(depth)[:-1] > 0


def joined(codes: np.ndarray, bounds: np.ndarray, names: pa.Array) -> pa.Array:
    """Of each text, its words joined by one space."""
    lists = pa.LargeListArray.from_arrays(pa.array(bounds.astype(np.int64)), names.take(pa.array(codes)))
    return pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Place that each of a document's n words is read from where the contract plants a period, else None."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def documents(batches: Iterator[pa.RecordBatch], rewrite: Rewrite, least: int = LEAST) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, pa.Array, list]]:
    """By slices: doc_ids, word codes and their bounds by text, the words by code, and each text's runs."""
    for batch in batches:
        ids = batch.column("doc_id")
        for texts in slices(batch.column("text")):
            own = ids.slice(texts.first, len(texts.offsets) - 1)
            words = coded_words(texts, BLANK_SPLIT)
            codes = words.codes.copy()
            for doc_id, a, b in zip(own.to_pylist(), words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
                place = rewrite(doc_id, b - a)
                if place is not None:
                    codes[a:b] = words.codes[a:b][place]
            yield own, codes, words.bounds, words.names, runs_of_texts(codes, words.bounds, least)


def as_they_stand(doc_id: int | None, n: int) -> None:
    return None


def find_runs(docs: DataFrame, least: int = LEAST, rewrite: Rewrite = as_they_stand) -> DataFrame:
    """doc_id, start, length and period of each run of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, _, _, found in documents(batches, rewrite, least):
            row = np.repeat(np.arange(len(found)), [len(x) for x in found])
            flat = np.array([r for own in found for r in own], np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), *(pa.array(flat[:, k]) for k in range(3))], names=["doc_id", "start", "length", "period"])

    return _texts(docs).transform(map_batches, run, "doc_id long, start long, length long, period long")


def collapsed(docs: DataFrame, least: int = LEAST, rewrite: Rewrite = as_they_stand) -> DataFrame:
    """doc_id and text without repetitions, its words joined by one space (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, codes, bounds, names, found in documents(batches, rewrite, least):
            yield pa.RecordBatch.from_arrays([ids, _kept(codes, bounds, names, found).cast(pa.string())], names=["doc_id", "text"])

    return _texts(docs).transform(map_batches, run, "doc_id long, text string")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _kept(codes: np.ndarray, bounds: np.ndarray, names: pa.Array, found: list) -> pa.Array:
    keep = ~repetitions(found, bounds)
    before = np.concatenate([[0], np.cumsum(keep)])
    return joined(codes[keep], before[bounds], names)


def digests(docs: DataFrame, least: int = LEAST, rewrite: Rewrite = as_they_stand) -> DataFrame:
    """One row per row of docs: see RESULT."""
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, codes, bounds, names, found in documents(batches, rewrite, least):
            best = [max(own, key=lambda r: (r[1], -r[0], -r[2])) if own else (None,) * 3 for own in found]
            columns = [
                [len(own) for own in found],
                *([b[k] for b in best] for k in range(3)),
                [None if n is None else 1000 * n // q for _, n, q in best],
            ]
            lists = [sha("".join(f"{s},{n},{q}\n" for s, n, q in own).encode()) for own in found]
            texts = [sha(x.as_buffer()) for x in _kept(codes, bounds, names, found)]
            arrays = [ids, *(pa.array(c, pa.int64()) for c in columns), pa.array(lists, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in RESULT.split(", ")])

    return _texts(docs).transform(map_batches, run, RESULT)


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Contract query: the runs of every whole document, of which a tenth is rewritten with a period."""
    return digests(table(spark, sf_dir, "documents"), rewrite=planted)


#: Pairs of equal words at each distance q, stretches of consecutive pairs (islands), and of equal stretches the smallest period.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
c AS (SELECT rid, doc_id, ws, len(ws)::BIGINT AS n, xor(4294967295::BIGINT, list_reduce(
      list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1),
        lambda i: [ord(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda s, b: CASE WHEN b >= 0 THEN xor(s, b) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384::BIGINT) ELSE s >> 1 END)) AS h FROM d),
g AS (SELECT *, coalesce(h % 10 = 0 AND n > 0, false) AS planted, h // 10 AS g FROM c),
r AS (SELECT rid, doc_id, n, ws, CASE WHEN planted THEN g % n ELSE n END AS a,
             CASE WHEN planted THEN 1 + (n - g % n) // (3 + g % 8) ELSE 1 END AS p FROM g),
w AS (SELECT rid, i, ws[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word FROM (SELECT rid, ws, a, p, unnest(range(0, n)) AS i FROM r)),
e AS (SELECT x.rid, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.rid = y.rid AND x.word = y.word AND x.i < y.i),
isl AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM e),
s AS (SELECT rid, q, min(i) AS start, count(*) + q AS length FROM isl GROUP BY rid, q, island HAVING count(*) >= q AND count(*) + q >= 12),
runs AS (SELECT rid, start, length, min(q) AS period FROM s GROUP BY rid, start, length),
best AS (SELECT rid, count(*) AS n_runs, first(struct_pack(s := start, n := length, q := period) ORDER BY length DESC, start, period) AS b,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM runs GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS t FROM w ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.n AS length, b.q AS period, 1000 * b.n // b.q AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM r LEFT JOIN best USING (rid) LEFT JOIN kept USING (rid)
"""
