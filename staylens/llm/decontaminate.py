"""Benchmark decontamination with an FM-index for each shard of documents.

Words are runs of digits, ASCII letters (A-Z lower-cased) and characters beyond ASCII. The windows of an item are its
runs of 10 words (one window if it has fewer). Each shard (whole documents of about SHARD_WORDS words) becomes a text
of benchmark-word symbols; every run of other words and every end of a document is one separator. Backward search
through wavelet ranks finds the windows' row ranges, sampled suffix positions locate them, and the words hit are merged
into spans.

The benchmark goes to the tasks in batches of about BATCH_BYTES of text. Documents pass once for each batch and are written
to the shared folder in between, so neither a task nor the driver holds more than one batch at a time, however large the
benchmark is. Nothing is shuffled.

Nulls: a null text has no words; a null item text has no windows; items with a null id count as hits but are not named.
Repeated rows each get their result, repeated item ids count once, extra columns of any name are kept by cut() and ignored
by scan(). Without items nothing is hit; without documents the result is empty.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.llm.fm_index import FMIndex
from staylens.llm.names import any_names
from staylens.llm.storage import table, written
from staylens.llm.words import ALNUM_SPLIT, LOWER, Words, slices, split_words
from staylens.llm.workers import map_batches

WINDOW = 10
SHARD_WORDS = 1_000_000
BATCH_BYTES = 8_000_000
_FILTER_BITS = 20
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, item_ids array<string>, spans array<struct<start:long,stop:long>>"


class Windows(NamedTuple):
    """Windows of a batch of items, as symbols from 1 of the sorted word hashes."""

    words: np.ndarray
    patterns: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]


def windows_of(items: list[tuple[object, str | None]], window: int = WINDOW) -> Windows:
    column = pa.array([text for _, text in items], pa.string())
    found: dict[tuple[int, ...], set[str]] = defaultdict(set)
    for texts in slices(column):
        words = split_words(texts, ALNUM_SPLIT, LOWER)
        for i in range(len(texts.offsets) - 1):
            own = words.hashes[words.bounds[i] : words.bounds[i + 1]].tolist()
            name = items[texts.first + i][0]
            for at in range(max(1, len(own) - window + 1) if own else 0):
                found[tuple(own[at : at + window])] |= {str(name)} if name is not None else set()
    vocabulary = np.array(sorted({h for w in found for h in w}), np.uint64)
    patterns = np.zeros((len(found), window), np.int64)
    for row, w in enumerate(found):
        patterns[row, window - len(w) :] = np.searchsorted(vocabulary, np.array(w, np.uint64)) + 1
    return Windows(vocabulary, patterns, np.array([len(w) for w in found], np.int64), [sorted(x) for x in found.values()])


def symbols(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """1 + place in the vocabulary, 0 for other words; a bit table spares most other words the search."""
    out = np.zeros(len(hashes), np.int64)
    if len(vocabulary):
        shift = np.uint64(64 - _FILTER_BITS)
        table = np.zeros(1 << _FILTER_BITS, bool)
        table[vocabulary >> shift] = True
        maybe = np.flatnonzero(table[hashes >> shift])
        place = np.minimum(np.searchsorted(vocabulary, hashes[maybe]), len(vocabulary) - 1)
        out[maybe] = np.where(vocabulary[place] == hashes[maybe], place + 1, 0)
    return out


def shard_hits(parts: list[np.ndarray], batch: Windows) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each document of a shard (its symbols): window, first word and length of every occurrence."""
    lengths = np.array([len(p) + 1 for p in parts])
    whole = np.concatenate([x for p in parts for x in (p, np.zeros(1, np.int64))])
    ends = np.cumsum(lengths)
    kept = np.ones(len(whole), bool)  # of consecutive separators the last
    kept[:-1] = (whole[:-1] != 0) | (whole[1:] != 0)
    place = np.flatnonzero(kept)
    index = FMIndex(whole[kept], len(batch.words))
    low, high = index.search(batch.patterns, batch.lengths)
    many = high - low
    window = np.repeat(np.arange(len(many)), many)
    rows = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
    at = place[index.locate(rows)]
    doc = np.searchsorted(ends, at, "right")
    order = np.lexsort((at, doc))
    window, at, doc = window[order], at[order], doc[order]
    cuts = np.searchsorted(doc, np.arange(len(parts) + 1))
    starts = ends - lengths
    return [
        (window[a:b], at[a:b] - starts[i], batch.lengths[window[a:b]])
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
    ]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of word ranges; ranges that touch become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _shards(column: pa.Array) -> Iterator[tuple[int, list[Words]]]:
    """Documents of a batch as (first row, words of slices) by about SHARD_WORDS words."""
    held: list[Words] = []
    first = n = rows = 0
    for texts in slices(column):
        words = split_words(texts, ALNUM_SPLIT, LOWER)
        held.append(words)
        n += len(words.hashes)
        rows += len(words.bounds) - 1
        if n >= SHARD_WORDS:
            yield first, held
            held, first, n = [], rows, 0
    if held:
        yield first, held


def _marked(batch: pa.RecordBatch, found: Windows) -> Iterator[tuple[int, int, list[tuple[int, int]], set[str]]]:
    """Row, words, spans and items of each row, in order."""
    for first, held in _shards(batch.column("text")):
        parts = [
            s[a:b]
            for w in held
            for s in [symbols(w.hashes, found.words)]
            for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)
        ]
        for i, (window, at, length) in enumerate(shard_hits(parts, found)):
            spans = merge(list(zip(at.tolist(), (at + length).tolist(), strict=True)))
            yield first + i, len(parts[i]), spans, {x for k in np.unique(window).tolist() for x in found.items[k]}


def _spans_array(rows: list[list[tuple[int, int]]]) -> pa.Array:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    return pa.array([[{"start": a, "stop": b} for a, b in r] for r in rows], kind)


def _batches(benchmark: DataFrame, most: int) -> Iterator[tuple[bool, list[tuple[object, str | None]]]]:
    """Whether it is the last, and its items, of each of the batches of about most bytes of text; collected one at a time.

    A repeated item is one and an item without a text none. Items of one text are of any number, so batches are cut by both.
    """
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull()).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    n = int(size // most) + 1
    part = F.pmod(F.xxhash64("text", "item_id"), F.lit(n))
    for k in range(n):
        yield k == n - 1, [(r[0], r[1]) for r in items.filter(part == k).collect()]


def _free_name(name: str, taken: list[str]) -> str:
    while name.lower() in {x.lower() for x in taken}:
        name += "_"
    return name


def _pass(docs: DataFrame, benchmark: DataFrame, final, schema: str | T.StructType, most: int) -> DataFrame:
    """docs once through each batch of the benchmark; final makes a record batch of a batch, its words, spans and items."""
    spark, columns = docs.sparkSession, docs.columns
    s, i = _free_name("spans", columns), _free_name("items", columns)
    state = T.StructType.fromDDL(f"`{s}` array<struct<start:long,stop:long>>, `{i}` array<string>")
    held = T.StructType([*docs.schema.fields, *state.fields])
    first = True
    for last, items in _batches(benchmark, most):
        found = spark.sparkContext.broadcast(windows_of(items))

        def run(stream: Iterator[pa.RecordBatch], found=found, first=first, last=last) -> Iterator[pa.RecordBatch]:
            for batch in stream:
                n_words, spans, items = [], [], []
                for row, n, own, names in _marked(batch, found.value):
                    if not first:
                        own = merge(own + [(x["start"], x["stop"]) for x in batch.column(s)[row].as_py()])
                        names = names | set(batch.column(i)[row].as_py())
                    n_words.append(n)
                    spans.append(own)
                    items.append(sorted(names))
                own = pa.RecordBatch.from_arrays([batch.column(k) for k in range(len(columns))], names=columns)
                if last:
                    yield final(own, n_words, spans, items)
                else:
                    yield pa.RecordBatch.from_arrays([*own.columns, _spans_array(spans), pa.array(items, pa.list_(pa.string()))], names=held.names)

        docs = docs.transform(map_batches, run, schema if last else held)
        if not last:
            docs, first = written(docs, "decontaminated"), False
            found.destroy()
    return docs


def _digests(batch: pa.RecordBatch, n_words: list, spans: list, items: list) -> pa.RecordBatch:
    hit = [sum(b - a for a, b in own) for own in spans]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(n_words, pa.int64()),
            pa.array(hit, pa.int64()),
            pa.array([len(x) for x in items], pa.int64()),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
            pa.array([x > 0 for x in hit], pa.bool_()),
            pa.array(items, pa.list_(pa.string())),
            _spans_array(spans),
        ],
        names="doc_id n_words n_hit n_items items_sha256 contaminated item_ids spans".split(),
    )


def scan(docs: DataFrame, benchmark: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per row of docs: see RESULT."""
    return _pass(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, _digests, RESULT, batch_bytes)


def _cut(batch: pa.RecordBatch, n_words: list, spans: list, items: list) -> pa.RecordBatch:
    column = batch.column("text")
    texts = column.to_pylist()
    for part in slices(column):
        if any(spans[part.first : part.first + len(part.offsets) - 1]):
            words = split_words(part, ALNUM_SPLIT, LOWER)
            for i in range(len(part.offsets) - 1):
                if own := spans[part.first + i]:
                    base, raw = part.offsets[i], part.data[part.offsets[i] : part.offsets[i + 1]].tobytes()
                    left, at = [], 0
                    for a, b in own:
                        left.append(raw[at : words.starts[words.bounds[i] + a] - base])
                        at = words.ends[words.bounds[i] + b - 1] - base
                    texts[part.first + i] = b"".join([*left, raw[at:]]).decode()
    names = batch.schema.names
    return pa.RecordBatch.from_arrays([pa.array(texts, column.type) if n == "text" else c for n, c in zip(names, batch.columns, strict=True)], names=names)


@any_names
def cut(docs: DataFrame, benchmark: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """docs with the merged spans taken out of the texts; same columns and rows."""
    return _pass(docs, benchmark, _cut, docs.schema, batch_bytes)


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document against the whole benchmark; the named items and the merged spans as text."""
    found = scan(table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    spans = F.array_join(F.transform("spans", lambda x: F.concat(x["start"], F.lit("-"), x["stop"])), ",")
    return found.withColumns({"item_ids": F.array_join("item_ids", ","), "spans": spans})


ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
occ AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT doc_id, occ.i, occ.k, win.item_id FROM occ JOIN win ON win.g = occ.g AND win.k = occ.k),
pos AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hit))),
island AS (SELECT doc_id, min(p) - 1 AS a, max(p) AS b FROM (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS g FROM pos) GROUP BY doc_id, g),
n AS (SELECT doc_id, sum(b - a) AS n_hit, string_agg(a || '-' || b, ',' ORDER BY a) AS spans FROM island GROUP BY doc_id),
it AS (SELECT doc_id, list(DISTINCT item_id::VARCHAR ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(array_to_string(ids, ','), '') AS item_ids, coalesce(spans, '') AS spans
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""
