"""Toxicity scores by non-negative positive-unlabelled learning.

The classifier is a logistic model over the presence of hashed words. Confirmed toxic texts are the positives P and all
other texts unlabelled U. With prior p the risk is p R_P(+) + max(0, R_U(-) - p R_P(-)); where the bracket turns
negative its gradient is reversed, so the model cannot gain by memorising positives. Training is plain numpy on the
driver over a bounded sample: at most ``max_positive`` positive and ``max_unlabelled`` unlabelled rows, the first by a
hash of doc_id, whatever the table's size (both are parameters, see Settings). The prior is the share of label 1 among all
labels of the training folds, held between ``least_prior`` and ``most_prior``.

Features: of 2**bits hashed words those that at least ``min_docs`` sample texts hold and that a positive text holds more
often than chance allows (``max_features`` at most, a model parameter). They are counted and chosen as a table; the driver gets
the chosen words and their places in each sample row, never a text. Scores read whole texts.

Nulls: a null text scores like an empty one; rows with a null doc_id are scored as held out and never trained on; labels
of absent documents, null labels and labels other than 0 or 1 are ignored, of repeated labels the largest counts, of rows that
share a doc_id one is trained on. Without any positive label, or any document, every score is the prior. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.storage import discard, table, written
from staylens.llm.words import ALNUM_SPLIT, LOWER, slices, split_words
from staylens.llm.workers import map_batches

FOLDS = 5
SEED = 17
RESULT = "doc_id long, held_out boolean, score double, predicted int"


class Settings(NamedTuple):
    bits: int = 22
    max_positive: int = 4_000
    max_unlabelled: int = 8_000
    min_docs: int = 5
    max_features: int = 4_096
    epochs: int = 60
    batch: int = 512
    rate: float = 0.05
    l2: float = 1e-5
    least_prior: float = 1e-4
    most_prior: float = 0.9


class Model(NamedTuple):
    """Sorted feature ids, their weights, the bias and the class prior."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    bits: int


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True))


def presence(column: pa.Array, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By slices: first row, row of each (row, hashed word) pair and the hashed word, pairs once each."""
    for texts in slices(column):
        words = split_words(texts, ALNUM_SPLIT, LOWER)
        n = np.diff(words.bounds)
        pair = (np.repeat(np.arange(len(n), dtype=np.uint64), n) << np.uint64(bits)) | (words.hashes >> np.uint64(64 - bits))
        pair = np.unique(pair)
        yield texts.first, (pair >> np.uint64(bits)).astype(np.int64), (pair & np.uint64((1 << bits) - 1)).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(features: np.ndarray, x_p: np.ndarray, x_u: np.ndarray, prior: float, s: Settings = Settings()) -> Model:
    """The non-negative PU classifier of rows of positive and of unlabelled texts, a column for each of the sorted features."""
    prior = min(max(prior, s.least_prior), s.most_prior)
    if not len(x_p) or not len(x_u):
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))), s.bits)
    rng = np.random.default_rng(SEED)
    w, b = np.zeros(len(features)), float(np.log(prior / (1 - prior)))
    m, v, step = np.zeros(len(w) + 1), np.zeros(len(w) + 1), 0
    for _ in range(s.epochs):
        order_u = rng.permutation(len(x_u))
        for at in range(0, len(order_u), s.batch):
            u = x_u[order_u[at : at + s.batch]]
            p = x_p[rng.integers(0, len(x_p), min(s.batch, len(x_p)))]
            f_p, f_u = _sigmoid(p @ w + b), _sigmoid(u @ w + b)
            # Sigmoid losses, bounded as the risk's difference needs: l(+) = 1 - f and l(-) = f, slopes -f(1-f) and f(1-f).
            s_p, s_u = f_p * (1 - f_p) / len(p), f_u * (1 - f_u) / len(u)
            if f_u.mean() >= prior * f_p.mean():
                g_p, g_u = -2 * prior * s_p, s_u
            else:
                g_p, g_u = prior * s_p, -s_u
            grad = np.append(p.T @ g_p + u.T @ g_u + s.l2 * w, g_p.sum() + g_u.sum())
            step += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            move = s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            w, b = w - move[:-1], b - move[-1]
    return Model(features, w, b, s.bits)


def _sample(docs: DataFrame, labels: DataFrame, s: Settings) -> tuple[DataFrame, float]:
    """(doc_id, positive, text) of the sample, a row for each doc_id of either kind, and the prior."""
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    by = F.xxhash64("doc_id", F.lit(SEED))
    text = docs.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    there = text.select("doc_id").distinct()
    positives = known.filter("toxic = 1").select("doc_id").join(there, "doc_id", "left_semi").orderBy(by, "doc_id").limit(s.max_positive)
    # Unlabelled are of all texts, as the class prior is; a hash threshold spares sorting most of their ids.
    total = text.agg(F.count(F.lit(1))).first()[0]
    share = min(1.0, s.max_unlabelled / max(1, total))
    unlabelled = there.filter(F.pmod(by, F.lit(1_000_000)) < int(share * 1_200_000) + 1).orderBy(by, "doc_id").limit(s.max_unlabelled)
    ids = positives.withColumn("positive", F.lit(True)).unionByName(unlabelled.withColumn("positive", F.lit(False)))
    rows = text.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "positive").agg(F.min("text").alias("text"))
    return written(rows, "sample"), toxic / n if n else 0.1


def _words(sample: DataFrame, bits: int) -> DataFrame:
    """(doc_id, positive, word) of each distinct hashed word of the sample's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "positive"]
        for batch in batches:
            for first, row, word in presence(batch.column("text"), bits):
                take = pa.array(row + first)
                yield pa.RecordBatch.from_arrays([*(batch.column(n).take(take) for n in names), pa.array(word)], names=[*names, "word"])

    return sample.select("doc_id", "positive", "text").transform(map_batches, run, "doc_id long, positive boolean, word long")


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Fits on the rows of the training folds; what reaches the driver is bounded by s."""
    sample, prior = _sample(docs, labels, s)
    ids = [(r[0], r[1]) for r in sample.select("doc_id", "positive").orderBy("doc_id").collect()]
    place = {True: {}, False: {}}
    for doc_id, positive in ids:
        place[positive][doc_id] = len(place[positive])
    n_p, n_u = len(place[True]), len(place[False])
    words = written(_words(sample, s.bits), "words")
    counts = words.groupBy("word").agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u")).filter(F.col("p") >= s.min_docs)
    share_p, share_u = F.col("p") / max(1, n_p), (F.col("u") + 0.5) / (n_u + 1)
    spread = F.greatest(F.sqrt(share_u * (1 - F.least(share_u, F.lit(0.999))) / max(1, n_p)), F.lit(1e-9))
    z = (share_p - share_u) / spread
    chosen = counts.filter((z > 4) & (share_p > share_u * 2)).orderBy(F.desc(z), "word").limit(s.max_features).select("word")
    features = np.array(sorted(r[0] for r in chosen.collect()), np.int64)
    column = {w: i for i, w in enumerate(features.tolist())}
    x = {True: np.zeros((n_p, len(features)), np.float32), False: np.zeros((n_u, len(features)), np.float32)}
    if column:
        own = words.join(F.broadcast(docs.sparkSession.createDataFrame([(w,) for w in column], "word long")), "word")
        for r in own.groupBy("doc_id", "positive").agg(F.collect_list("word").alias("words")).collect():
            x[r["positive"]][place[r["positive"]][r["doc_id"]], [column[w] for w in r["words"]]] = 1
    discard(sample, words)
    return fit(features, x[True], x[False], prior, s)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of docs: see RESULT. The model is as large as its settings allow, whatever the data."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = sent.value
        table = np.zeros(1 << m.bits, np.float64)
        table[m.features] = m.weights
        for batch in batches:
            total = np.full(batch.num_rows, m.bias)
            for first, row, word in presence(batch.column("text"), m.bits):
                n = int(row[-1]) + 1 if len(row) else 0
                total[first : first + n] += np.bincount(row, table[word], n)
            p = _sigmoid(total)
            arrays = [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *arrays], names=["doc_id", "held_out", "score", "predicted"]
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string")
    ).transform(map_batches, run, RESULT)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document scored by a model of the training folds' labels."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
