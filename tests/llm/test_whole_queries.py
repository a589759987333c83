"""op3 and op9 as whole queries against plain loops."""

import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa

from staylens.llm import html_crf, toxicity
from staylens.llm.leaf_blocks import blocks
from staylens.llm.words import ALNUM_SPLIT, LOWER, slices, split_words

DATA = "/root/testdata/sf0.001"


def hashed(word, bits):
    """The hashed word of one word alone."""
    return int(split_words(next(slices(pa.array([word]))), ALNUM_SPLIT, LOWER).hashes[0] >> np.uint64(64 - bits))


def plain_words(text):
    return set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)})))


def test_toxicity_query_equals_a_plain_sum(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    got = {r.doc_id: r for r in toxicity.op3_toxicity(spark, DATA).collect()}
    hashes = {}
    for r in docs.collect():
        found = {hashes.setdefault(w, hashed(w, model.bits)) for w in plain_words(r.text)}
        score = 1 / (1 + math.exp(-(model.bias + sum(weight.get(h, 0.0) for h in found))))
        own = got[r.doc_id]
        assert math.isclose(own.score, score, abs_tol=1e-9) and own.predicted == int(score >= 0.5)
        assert own.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_toxicity_minimises_the_risk_of_its_loss():
    """The corrected risk, term by term, of the fitted model, of the prior alone and of the model moved a little."""
    rng = np.random.default_rng(5)
    x_p = (rng.random((60, 4)) < [0.9, 0.7, 0.3, 0.3]).astype(np.float32)
    x_u = (rng.random((200, 4)) < [0.2, 0.2, 0.3, 0.3]).astype(np.float32)
    prior = 0.15

    def risk(w, b):
        sigmoid = lambda row: 1 / (1 + math.exp(-(sum(float(a) * float(c) for a, c in zip(w, row, strict=True)) + b)))
        p, u = [sigmoid(r) for r in x_p], [sigmoid(r) for r in x_u]
        positive = prior * sum(1 - f for f in p) / len(p)
        return positive + max(0.0, sum(u) / len(u) - prior * sum(p) / len(p))

    fitted = toxicity.fit(np.arange(4), x_p, x_u, prior, toxicity.Settings(epochs=400, batch=256, rate=0.02))
    least = risk(fitted.weights, fitted.bias)
    assert least < risk(np.zeros(4), math.log(prior / (1 - prior))) - 0.02
    assert fitted.weights[0] > abs(fitted.weights[2]) and fitted.weights[0] > abs(fitted.weights[3])


def test_html_query_equals_the_best_of_all_labellings(spark):
    model = html_crf.default_model()
    got = {r.page_id: r for r in html_crf.op9_html_text(spark, DATA).collect()}
    tried = 0
    for r in spark.read.parquet(f"{DATA}/pages.parquet").collect():
        found = blocks(r.html or "")
        names = html_crf.page_features(found)
        if len(found) <= 11:
            emit = [sum((model.emit[model.index[f]] for f in own if f in model.index), np.zeros(2)) for own in names]
            value = lambda p: (model.start[p[0]] if p else 0) + sum(emit[i][x] for i, x in enumerate(p)) + sum(model.step[a, b] for a, b in itertools.pairwise(p))  # noqa: B023, E731
            best = max(itertools.product((0, 1), repeat=len(found)), key=value)
            tried += 1
        else:
            best = html_crf.viterbi(model, names)
        text = "\n".join(b.text for b, keep in zip(found, best, strict=True) if keep)
        assert got[r.page_id].text == text and got[r.page_id].n_chars == len(text)
    assert tried > 3
