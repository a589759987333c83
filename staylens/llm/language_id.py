"""Language of whole texts by a bidirectional gated recurrent network over bytes (byte_gru.py), trained in numpy.

A text is cut into windows of ``window`` bytes (letters A-Z in lower case); the network labels every byte of every window with a
probability for each language, and the document's probabilities are their means over all its bytes.

The network is trained on the driver over a bounded sample: of the rows of the training folds with a lang, at most ``max_docs``,
dealt evenly to the languages and chosen by a hash of doc_id, and of each ``windows_per_doc`` windows at hashed places (parameters,
see Settings). Every lang value of the training folds is a class. lang, source and doc_id are no inputs of a prediction.

Nulls: a null text and one without a letter (Unicode L) get ``und`` with score 0; a row with a null doc_id is held out; a row
without lang is never trained on. Repeated rows get equal results, an empty text has no letter. Without any training row all
predictions are ``und``; with one language that one. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylens.llm import byte_gru
from staylens.llm.storage import table
from staylens.llm.words import LOWER, Texts, slices
from staylens.llm.workers import map_batches

FOLDS = 5
UNKNOWN = "und"
LETTER = r"\p{L}"
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"
#: Windows that pass through the network together.
WINDOWS_AT_ONCE = 2048


class Settings(NamedTuple):
    window: int = 64
    hidden: int = 8
    max_docs: int = 4_000
    windows_per_doc: int = 6
    steps: int = 300
    batch: int = 256
    rate: float = 0.02
    shortest: int = 4
    seed: int = 23


class Model(NamedTuple):
    langs: list[str]
    network: byte_gru.Network | None
    window: int


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True))


def sample(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(lang, bytes) of the sample's windows."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(LETTER))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return known.limit(0).select("lang", F.col("text").cast("binary").alias("bytes"))
    each = max(1, s.max_docs // len(counts))
    place = F.xxhash64("doc_id", F.lit(s.seed))
    # A hash threshold a little above each language's share spares sorting all ids; the first by hash stay.
    rate = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, (1.2 * each + 20) / n))))
    near = known.filter(F.pmod(place, F.lit(1 << 40)) < rate[F.col("lang")] * float(1 << 40))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(place, "doc_id", F.xxhash64("text")))
    chosen = near.withColumn("rank", rank).filter(F.col("rank") <= each)
    data = F.col("text").cast("binary")
    spots = F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.lit(s.windows_per_doc)), lambda k: F.lit(1) + F.pmod(F.xxhash64("doc_id", k), F.greatest(F.lit(1), F.length(data) - s.window + 1)))
    )
    return chosen.select("lang", data.alias("data"), F.explode(spots).alias("at")).select("lang", F.expr(f"substring(data, int(at), {s.window})").alias("bytes"))


def train(docs: DataFrame, s: Settings = Settings()) -> Model:
    """Fits on the rows of the training folds; what reaches the driver is bounded by s."""
    rows = sorted((r["lang"], bytes(r["bytes"])) for r in sample(docs, s).collect())
    langs = sorted({lang for lang, _ in rows})
    if len(langs) < 2:
        return Model(langs, None, s.window)
    rng = np.random.default_rng(s.seed)
    x = np.zeros((s.window, len(rows)), np.uint8)
    mask = np.zeros((s.window, len(rows)), np.float32)
    for k, (_, data) in enumerate(rows):
        if rng.random() < 0.25:  # the network meets short texts, too
            data = data[: rng.integers(s.shortest, s.window + 1)]
        x[: len(data), k] = LOWER[np.frombuffer(data, np.uint8)]
        mask[: len(data), k] = 1
    number = {lang: k for k, lang in enumerate(langs)}
    label = np.array([number[lang] for lang, _ in rows])
    network = byte_gru.train(x, mask, label, len(langs), s.hidden, s.steps, min(s.batch, len(rows)), s.rate, s.seed)
    return Model(langs, network, s.window)


def pooled(model: Model, texts: Texts) -> np.ndarray:
    """(text, language) means of the labels of all bytes of each text; zeros for a text of no bytes."""
    size = np.diff(texts.offsets)
    many = -(-size // model.window)
    owner = np.repeat(np.arange(len(size)), many)
    first = np.concatenate([[0], np.cumsum(many)])
    start = texts.offsets[owner] + (np.arange(len(owner)) - first[owner]) * model.window
    filled = np.minimum(model.window, texts.offsets[owner + 1] - start)
    total = np.zeros((len(model.langs), len(size)))
    # Full windows go together, and short ones with others of about their length.
    order = np.argsort(-filled, kind="stable")
    for at in range(0, len(order), WINDOWS_AT_ONCE):
        own = order[at : at + WINDOWS_AT_ONCE]
        longest = int(filled[own[0]])
        step = np.arange(longest)[:, None]
        full = int(filled[own[-1]]) == longest
        mask = None if full else (step < filled[own]).astype(np.float32)
        place = start[own] + step
        x = LOWER[texts.data[place if full else np.minimum(place, len(texts.data) - 1)]]
        p = byte_gru.label_positions(model.network, x, mask)
        if mask is not None:
            p *= mask
        for k, sums in enumerate(p.sum(axis=1, dtype=np.float64)):
            total[k] += np.bincount(owner[own], sums, len(size))
    return (total / np.maximum(size, 1)).T


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of docs: see RESULT. The model is as large as its settings and the languages allow, whatever the rows."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = sent.value
        names = [*m.langs, UNKNOWN]
        for batch in batches:
            for texts in slices(batch.column("text")):
                part = batch.slice(texts.first, len(texts.offsets) - 1)
                readable = part.column("readable").to_numpy(zero_copy_only=False).astype(bool)
                p = pooled(m, texts) if m.network else np.ones((part.num_rows, len(m.langs)))
                best = p.argmax(axis=1) if m.langs else np.zeros(part.num_rows, np.int64)
                score = np.clip(p.max(axis=1, initial=0.0), 0, 1) * readable
                label = pa.array(names).take(pa.array(np.where(readable, best, len(m.langs))))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), label, pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.coalesce(text.rlike(LETTER), F.lit(False)).alias("readable"), text.alias("text")
    ).transform(map_batches, run, RESULT)


def op12_language_id(spark, sf_dir: str) -> DataFrame:
    """Contract query: the language of every whole document by a network of the training folds."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs))
