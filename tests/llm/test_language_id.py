"""The byte network: gradients against differences, a plain loop, held-out accuracy, edges."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from staylens.llm import byte_gru, language_id
from staylens.llm.words import slices

DATA = "/root/testdata/sf0.01"


def small(seed=3, hidden=3, labels=3):
    rng = np.random.default_rng(seed)
    x = rng.integers(97, 103, (9, 6)).astype(np.uint8)
    mask = (np.arange(9)[:, None] < np.array([9, 9, 4, 1, 7, 2])).astype(np.float32)
    return byte_gru.new_network(hidden, labels, rng), x, mask, np.array([0, 1, 2, 0, 1, 2])


def plain_labels(net, data):
    """One window by the formulas, byte by byte, in Python numbers."""
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    hidden = net.u.shape[2]
    sides = []
    for d in (0, 1):
        h, out = np.zeros(hidden), {}
        for t in range(len(data)) if d == 0 else reversed(range(len(data))):
            g, a = net.w[d][:, data[t]].astype(float), net.u[d].astype(float) @ h
            r, z = sigmoid(g[:hidden] + a[:hidden]), sigmoid(g[hidden : 2 * hidden] + a[hidden : 2 * hidden])
            n = np.tanh(g[2 * hidden :] + r * a[2 * hidden :])
            h = n + z * (h - n)
            out[t] = h
        sides.append(out)
    rows = []
    for t in range(len(data)):
        e = np.exp(net.o.astype(float) @ np.concatenate([sides[0][t], sides[1][t]]) + net.c[:, 0])
        rows.append(e / e.sum())
    return np.array(rows)


def test_gradients_equal_differences():
    net, x, mask, label = small()
    _, grad = byte_gru.gradients(net, x, mask, label)
    rng = np.random.default_rng(1)
    for p, g in zip(net, grad, strict=True):
        for _ in range(12):
            at = tuple(int(rng.integers(0, n)) for n in p.shape)
            at = (*at[:-1], int(x[at[0], at[1] % 6])) if p.shape[-1] == 256 else at
            value, losses = p[at], []
            for move in (0.01, -0.01):
                p[at] = value + move
                losses.append(byte_gru.gradients(net, x, mask, label)[0])
            p[at] = value
            assert abs((losses[0] - losses[1]) / 0.02 - g[at]) < 2e-3


def test_pooled_labels_equal_a_plain_loop():
    net, *_ = small()
    model = language_id.Model(["a", "b", "c"], net, 8)
    texts = ["", "Abc", "x" * 8, "hello, wörld of bytes \U0001f600 ...", "y" * 77, ""]
    got = np.concatenate([language_id.pooled(model, t) for t in slices(pa.array(texts))])
    for row, text in zip(got, texts, strict=True):
        data = text.translate({c: c + 32 for c in range(65, 91)}).encode()
        parts = [plain_labels(net, data[i : i + 8]) for i in range(0, len(data), 8)]
        assert np.allclose(row, np.concatenate(parts).mean(axis=0) if parts else 0, atol=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = {r.doc_id: r for r in language_id.op12_language_id(spark, DATA).collect()}
    truth = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(got) == docs.count() and all(got[r.doc_id].held_out for r in truth)
    assert sum(r.held_out for r in got.values()) == len(truth)
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in truth]) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_rows_and_other_columns_are_not_used(spark):
    s = language_id.Settings(steps=30, max_docs=200)
    docs = spark.createDataFrame([(i, ("der die das und " if i % 2 else "the of and to ") * 9, "de" if i % 2 else "en", "s") for i in range(300)], "doc_id long, text string, lang string, source string")
    one = language_id.train(docs, s)
    other = language_id.train(docs.selectExpr("doc_id", "text", "CASE WHEN pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 5) = 0 THEN 'xx' ELSE lang END AS lang"), s)
    assert one.langs == other.langs == ["de", "en"]
    assert all(np.array_equal(a, b) for a, b in zip(one.network, other.network, strict=True))
    got = {(r.doc_id, r.lang_pred) for r in language_id.predict(docs, one).collect()}
    assert got == {(i, "de" if i % 2 else "en") for i in range(300)}


@pytest.mark.parametrize("langs", [0, 1, 2])
def test_edges(spark, langs):
    texts = [None, "", " \n", "12 + 3", "é", "word " * 30_000, "\U0001f600", "日本"]
    rows = [(i, t, None, "s", 0.5, "x") for i, t in enumerate(texts)] + [(None, "null id", "en", None, None, None)] * 2
    rows += [(100 + i, "some words of it" if i % 2 else "quelques mots", ("en", "fr")[i % langs], "s", None, None) for i in range(40) if langs]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, readable string")
    got = language_id.predict(docs, language_id.train(docs, language_id.Settings(steps=20, max_docs=50))).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (0, 1, 2, 3, 6)] == ["und"] * 5 and by[None].held_out
    assert all((r.lang_pred == "und") == (langs == 0 or r.doc_id in (0, 1, 2, 3, 6)) and 0 <= r.score <= 1 for r in got)
    assert language_id.predict(docs.limit(0), language_id.Model([], None, 64)).count() == 0
