"""Main text of pages by a linear-chain conditional random field over DOM leaf blocks.

Each leaf block has features of its ancestors (tags; words of class, id and role) and of its text. The chain's weights are
trained by gradient ascent on labelled pages; Viterbi decoding marks the main blocks, which are joined by line breaks.

Nulls: a null or empty page has an empty text. A page that is cut off in a tag, comment or script ends there. Repeated rows
get equal results, other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.labelled_pages import labelled_page, plain_page
from staylens.llm.leaf_blocks import Block, blocks
from staylens.llm.storage import table
from staylens.llm.workers import map_batches

TRAIN_PAGES, PLAIN_PAGES, SEED = 500, 200, 1000
#: A feature has to occur in so many labelled blocks.
LEAST_COUNT = 5
STEPS, RATE, L2 = 400, 0.1, 0.005
SCHEMA = "page_id long, url string, text string, n_chars long"


class Model(NamedTuple):
    """Weights of feature x label, of label pairs, and of the first label."""

    index: dict[str, int]
    emit: np.ndarray
    step: np.ndarray
    start: np.ndarray


def features(b: Block, before: Block | None, after: Block | None) -> list[str]:
    n = len(b.text)
    words = b.text.count(" ") + 1
    linked = b.link_chars / n
    size = "0" if n < 20 else "1" if n < 60 else "2" if n < 150 else "3" if n < 400 else "4"
    link = "0" if linked == 0 else "1" if linked < 0.34 else "2" if linked < 0.8 else "3"
    out = [*(x for x in b.names if x != "m:"), f"tag:{b.tag}", f"size:{size}", f"link:{link}", f"size,link:{size}{link}", "bias"]
    tags = ",".join(sorted(x[2:] for x in b.names if x.startswith("t:") and x not in ("t:html", "t:body")))
    marked = "m:" in b.names
    out.append(f"path:{tags},{marked}")
    if b.text[-1] in ".?!…\"”":
        out.append("ends:sentence")
    if words > 3 and any(c in b.text for c in ".,;"):
        out.append("has:stops")
    if "©" in b.text:
        out.append("has:copyright")
    out.append(f"before:{before.tag if before else 'none'}")
    out.append(f"after:{after.tag if after else 'none'}")
    return out


def page_features(found: list[Block]) -> list[list[str]]:
    return [features(b, found[i - 1] if i else None, found[i + 1] if i + 1 < len(found) else None) for i, b in enumerate(found)]


def train(pages: list[tuple[str, set[str]]]) -> Model:
    """Maximum likelihood with an L2 penalty; all pages go through forward-backward together."""
    rows = [(blocks(html), main) for html, main in pages]
    rows = [(b, main) for b, main in rows if b]
    names = [page_features(b) for b, _ in rows]
    labels = [[int(x.text in main and x.tag != "title") for x in b] for b, main in rows]
    counts: dict[str, int] = {}
    for page in names:
        for block in page:
            for f in block:
                counts[f] = counts.get(f, 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= LEAST_COUNT))}
    longest = max(map(len, labels))
    x = np.zeros((sum(map(len, labels)), len(index)), np.float32)
    y = np.zeros((len(rows), longest), np.int64)
    there = np.zeros((len(rows), longest), bool)
    n = 0
    for p, page in enumerate(names):
        for t, block in enumerate(page):
            x[n, [index[f] for f in block if f in index]] = 1
            y[p, t], there[p, t] = labels[p][t], True
            n += 1
    emit, step, start = np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2)
    gold = np.eye(2)[y] * there[..., None]
    score = np.zeros((*y.shape, 2))
    pairs = np.einsum("pta,ptb->ab", gold[:, :-1], gold[:, 1:])
    theta = np.zeros(emit.size + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(STEPS):
        emit, step, start = theta[: emit.size].reshape(-1, 2), theta[emit.size : -2].reshape(2, 2), theta[-2:]
        score[there] = x @ emit.astype(np.float32)
        unary, pair, first = _marginals(score, step, start, there)
        g_emit = x.T @ (gold - unary)[there].astype(np.float32)
        g_step = pairs - pair
        g_start = gold[:, 0].sum(0) - first
        grad = np.concatenate([g_emit.ravel(), g_step.ravel(), g_start]) / len(rows) - L2 * theta / len(rows)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + RATE * (m / (1 - 0.9 ** (i + 1))) / (np.sqrt(v / (1 - 0.999 ** (i + 1))) + 1e-8)
    return Model(index, theta[: emit.size].reshape(-1, 2).copy(), theta[emit.size : -2].reshape(2, 2).copy(), theta[-2:].copy())


def _marginals(score: np.ndarray, step: np.ndarray, start: np.ndarray, there: np.ndarray):
    """Expected labels, label pairs and first labels of padded chains, by forward-backward in log space."""
    n, longest, _ = score.shape
    ahead, back = np.zeros_like(score), np.zeros_like(score)
    ahead[:, 0] = score[:, 0] + start
    for t in range(1, longest):
        new = np.logaddexp(ahead[:, t - 1, 0, None] + step[0], ahead[:, t - 1, 1, None] + step[1]) + score[:, t]
        ahead[:, t] = np.where(there[:, t, None], new, ahead[:, t - 1])
    for t in range(longest - 2, -1, -1):
        tail = back[:, t + 1] + score[:, t + 1]
        new = np.logaddexp(step[:, 0] + tail[:, 0, None], step[:, 1] + tail[:, 1, None])
        back[:, t] = np.where(there[:, t + 1, None], new, 0)
    total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    unary = np.exp(ahead + back - total[:, None, None]) * there[..., None]
    joint = ahead[:, :-1, :, None] + step + (back + score)[:, 1:, None, :] - total[:, None, None, None]
    pair = (np.exp(joint) * there[:, 1:, None, None]).sum((0, 1))
    return unary, pair, unary[:, 0].sum(0)


def viterbi(model: Model, names: list[list[str]]) -> list[int]:
    """The likeliest labels of a page's blocks."""
    find = model.index.get
    known = [[i for f in block if (i := find(f)) is not None] for block in names]
    lengths = np.array([len(k) for k in known])
    flat = np.array([i for k in known for i in k], np.int64)
    scores = np.add.reduceat(model.emit[flat], np.cumsum(lengths) - lengths, axis=0).tolist() if len(flat) else []
    if not scores:
        return []
    (s00, s01), (s10, s11) = model.step.tolist()
    a, b = scores[0][0] + model.start[0], scores[0][1] + model.start[1]
    came: list[tuple[int, int]] = []
    for x, y in scores[1:]:
        to0, to1 = int(b + s10 > a + s00), int(b + s11 > a + s01)
        a, b = (b + s10 if to0 else a + s00) + x, (b + s11 if to1 else a + s01) + y
        came.append((to0, to1))
    out = [int(b > a)]
    for to in reversed(came):
        out.append(to[out[-1]])
    return out[::-1]


def main_text(model: Model, page: str) -> str:
    found = blocks(page, model.index)
    if not found:
        return ""
    marks = viterbi(model, page_features(found))
    return "\n".join(b.text for b, keep in zip(found, marks, strict=True) if keep)


@lru_cache(maxsize=1)
def default_model() -> Model:
    return train([labelled_page(SEED + i) for i in range(TRAIN_PAGES)] + [plain_page(SEED + i) for i in range(PLAIN_PAGES)])


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 500):
                part = batch.slice(at, 500)
                texts = [main_text(m, h.as_py() or "") for h in part.column("html")]
                arrays = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), *arrays], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).transform(map_batches, run, SCHEMA)


def op9_html_text(spark, sf_dir: str) -> DataFrame:
    """Contract query: the main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
