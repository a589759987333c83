"""The training-data operators against brute force, round trips and held-out labels, and their edge cases."""

import collections
import functools
import hashlib
import random
import re
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staylens.llm import bpe, chaining, decontaminate, html_crf, line_quality, near_dup, queries, substring_dedup, tool_calls, toxicity, url_filter, warc
from staylens.llm.bagminhash import signatures, similarity, weigh
from staylens.llm.fm_index import FMIndex
from staylens.llm.graph import components
from staylens.llm.labelled_pages import labelled_page, plain_page
from staylens.llm.leaf_blocks import blocks
from staylens.llm.storage import new_path
from staylens.llm.words import ALNUM_SPLIT, LOWER, slices, split_words

DATA = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t", "one", "É é 日本 \U0001f600", "a" * 5000, "word " * 3000]
WORDS = [f"w{i}" for i in range(3000)]


def frame(spark, texts, ids=None):
    """Documents with clashing extra columns, a null id and a repeated row."""
    rows = [(i if ids is None else ids[i], t, "en", f"s{i % 2}", 1, "x", "y") for i, t in enumerate(texts)]
    rows += [(None, "null id text", None, None, None, None, None), rows[-1]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node string, row_key string")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    want = duck.sql(queries.oracle_sql()[name])
    df = queries.queries()[name](spark, DATA)
    assert sorted(df.columns) == sorted(want.columns)
    got = sorted(str(tuple(r)) for r in df.select(*want.columns).collect())
    assert got == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("op", ["quality", "filter", "classes", "keep", "passages", "cut", "scan", "cut_bench", "digests", "encode", "score"])
def test_odd_and_empty_documents(spark, op):
    bench = spark.createDataFrame([("b", "one"), (None, None)], "item_id string, text string")
    run = {
        "quality": line_quality.judge,
        "filter": line_quality.filter_documents,
        "classes": near_dup.classes,
        "keep": near_dup.keep_one,
        "passages": substring_dedup.passages,
        "cut": substring_dedup.cut,
        "scan": lambda d: decontaminate.scan(d, bench),
        "cut_bench": lambda d: decontaminate.cut(d, bench),
        "digests": bpe.digests,
        "encode": bpe.encode,
        "score": lambda d: toxicity.score(d, toxicity.fit(np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros((0, 0)), 0.1)),
    }[op]
    docs = frame(spark, ODD)
    n = run(docs).count()
    assert n == docs.count() if op in ("quality", "classes", "cut", "scan", "cut_bench", "digests", "encode", "score") else n <= docs.count()
    if op in ("filter", "keep", "cut", "cut_bench"):
        assert run(docs).columns == docs.columns
    assert run(docs.limit(0)).count() == 0


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(2)
    for n, v in ((300, 2), (4000, 5), (4000, 90)):
        text = rng.integers(0, v + 1, n)
        text[n // 2 : n // 2 + n // 4] = text[: n // 4]
        text[-1] = 0
        index = FMIndex(text, v)
        for _ in range(40):
            p = rng.integers(1, v + 1, rng.integers(1, 6))
            low, high = index.search(p[None, :], np.array([len(p)]))
            got = sorted(index.locate(np.arange(low[0], high[0])))
            assert got == [i for i in range(n - len(p) + 1) if (text[i : i + len(p)] == p).all()]


def test_decontamination_in_batches_and_cut(spark):
    docs, bench = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/benchmark.parquet")
    once, often = decontaminate.scan(docs, bench), decontaminate.scan(docs, bench, 2000)
    assert sorted(map(str, once.collect())) == sorted(map(str, often.collect()))
    assert not decontaminate.scan(decontaminate.cut(docs, bench), bench).filter("contaminated").count()


@pytest.mark.parametrize("op", ["filter", "keep", "passages", "bench", "encode", "decode"])
def test_dotted_and_odd_column_names(spark, op):
    rows = [(i, f"w{i} " + "some words of a text that is long enough " * 3, 1, "x", "y") for i in range(4)] + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int, `c d``e` string, other_column_0 string").withColumn("source", F.lit("s"))
    bench = spark.createDataFrame([("b", "w1 some words of a text that is long")], "item_id string, text string")
    run = {"filter": line_quality.filter_documents, "keep": near_dup.keep_one, "passages": substring_dedup.cut, "bench": lambda d: decontaminate.cut(d, bench), "encode": bpe.encode, "decode": lambda d: bpe.decode(bpe.encode(d))}[op]
    out = run(docs)
    want = {"encode": "token_ids", "decode": "decoded"}
    assert [c for c in out.columns if c != want.get(op)] == [c for c in docs.columns if op not in want or c != "text"]
    assert all(r["a.b"] == 1 and r["c d`e"] == "x" and r["other_column_0"] == "y" for r in out.collect() if r["doc_id"] is not None)


def test_many_items_of_one_text(spark):
    """Items of equal texts, null ones and repeated rows are cut into bounded batches."""
    long = " ".join(WORDS[:40])
    rows = [(f"i{i}", long) for i in range(20_000)] + [(f"n{i}", None) for i in range(20_000)] + [("i1", long)] * 5_000 + [(None, long), ("s", "w1 w2")]
    bench = spark.createDataFrame(rows, "item_id string, text string")
    sizes = [sum(len(t) + 64 for _, t in items) for _, items in decontaminate._batches(bench, 500_000)]
    assert len(sizes) > 7 and max(sizes) < 1_000_000
    few = spark.createDataFrame([(f"i{i}", long) for i in range(300)] + [("n", None), ("s", "w1 w2")], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"a {long} b"), (2, "w0 w1 w2"), (3, None)], "doc_id long, text string")
    once, often = decontaminate.scan(docs, few).collect(), decontaminate.scan(docs, few, 8_000).collect()
    assert sorted(map(str, once)) == sorted(map(str, often))
    assert {r.doc_id: (r.n_hit, r.n_items) for r in often} == {1: (40, 301), 2: (2, 1), 3: (0, 0)}


def test_bagminhash_is_unbiased():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 100).astype(np.uint64)
    a, b = rng.integers(0, 9, 100), rng.integers(0, 9, 100)
    b = np.where(rng.random(100) < 0.6, a, b)
    x, y = np.repeat(base, a), np.repeat(base, b)
    s = signatures(2, *weigh(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)])), 20_000)
    assert similarity(x, y) == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert (s[0] == s[1]).mean() == pytest.approx(similarity(x, y), abs=0.015)


def test_near_duplicates_equal_brute_force(spark):
    r = random.Random(4)
    texts = []
    for copies in (1, 1, 2, 5, 30, 12, 3):
        base = r.choices(WORDS, k=120)
        for _ in range(copies):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3, 4])):
                t[r.randrange(120)] = r.choice(WORDS)
            texts.append(" ".join(t))
    texts += [None, "", "one two", "One, two", texts[0]]
    sets = []
    for t in texts:
        w = plain_words(t)
        sets.append(collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both, any_ = sum((sets[a] & sets[b]).values()), sum((sets[a] | sets[b]).values())
            if (texts[a] or "") == (texts[b] or "") or (both and both >= 0.8 * any_):
                root[max(find(a), find(b))] = min(find(a), find(b))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.class_id for r in near_dup.classes(docs).collect()} == {i: find(i) for i in range(len(texts))}
    assert {r.doc_id for r in near_dup.keep_one(docs).collect()} == {find(i) for i in range(len(texts))}


def test_many_repeated_rows_are_one_text(spark):
    r = random.Random(12)
    base = r.choices(WORDS, k=200)
    near = " ".join([*base[:100], "other", *base[101:]])
    rows = [(1, " ".join(base), "a.b")] * 10_000 + [(2, near, "c")] * 10_000 + [(3, near, "d"), (None, "alone", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string").repartition(4)
    begun = time.time()
    found = collections.Counter((r.doc_id, r.class_id) for r in near_dup.classes(docs).collect())
    assert found == {(1, 1): 10_000, (2, 1): 10_000, (3, 1): 1, (None, None): 1} and time.time() - begun < 90
    assert sorted(map(str, near_dup.keep_one(docs).select("doc_id").collect())) == ["Row(doc_id=1)", "Row(doc_id=None)"]


def test_hot_buckets_are_dealt(spark, monkeypatch):
    """Every join of a bucket or a text with many partners goes through the salted one, with equal results."""
    monkeypatch.setattr(near_dup, "spread_join", functools.partial(near_dup.spread_join, least=2))
    r = random.Random(13)
    base = [r.choices(WORDS, k=80) for _ in range(3)]
    docs = spark.createDataFrame([(i, " ".join([*base[i % 3], r.choice(WORDS)])) for i in range(150)], "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dup.classes(docs).collect()} == {i: i % 3 for i in range(150)}


def test_cells_lose_no_link():
    r = np.random.default_rng(4)
    for n in (3, 60, 900):
        base = r.integers(0, 2**63, n, dtype=np.uint64)
        sets = [np.concatenate([base[r.random(n) < p], r.integers(0, 2**63, n // 8, dtype=np.uint64), np.repeat(base[:1], r.integers(0, 400))]) for p in r.random(40)]
        cells = np.stack([np.bincount((x % np.uint64(near_dup.CELLS)).astype(np.int64), minlength=near_dup.CELLS) for x in sets])
        i, j = (x.ravel() for x in np.meshgrid(range(40), range(40)))
        sizes = np.array([len(x) for x in sets])
        true = np.array([similarity(sets[a], sets[b]) for a, b in zip(i, j, strict=True)])
        for threshold in (0.3, 0.8):
            assert near_dup.cells_allow(cells[i], cells[j], sizes[i], sizes[j], threshold)[true >= threshold].all()


def test_crowded_buckets_are_searched_whole(spark, monkeypatch):
    """Every pair of different components that brute force allows, from blocks far smaller than the bucket."""
    monkeypatch.setattr(near_dup, "BLOCK", 7)
    r = random.Random(8)
    base = [r.choice(WORDS) for _ in range(120)]
    texts = {}
    for i in range(60):
        words = list(base)
        for at in r.sample(range(120), r.randint(1, 5)):
            words[at] = r.choice(WORDS)
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    signs = near_dup.signed(docs).drop("buckets")
    nodes = docs.select("doc_id", near_dup.text_node(F.col("text")).alias("node"), "text")
    rows = signs.join(nodes, "node").join(near_dup.shingle_cells(nodes.select("node", "text").distinct()), "node")
    rows = rows.select(F.explode(F.expr("array(5L, 9L)")).alias("bucket"), F.lit(60).cast("long").alias("size"), "node", "n", "sketch", "cells", (F.col("doc_id") % 3).cast("string").cast("binary").alias("component"))
    ids = {bytes(x.node): x.doc_id for x in nodes.collect()}
    got = {tuple(sorted((ids[bytes(x.a)], ids[bytes(x.b)]))) for x in near_dup.across(rows, 0.8).collect()}

    def grams(text):
        words = plain_words(text)
        return collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))

    bags = {i: grams(t) for i, t in texts.items()}
    links = {(i, j) for i in texts for j in texts if i < j and i % 3 != j % 3 and texts[i] != texts[j] and sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values())}
    assert len(links) > 20 and links <= got, (len(links), len(got), len(links - got))
    assert all(i % 3 != j % 3 for i, j in got) and len(got) < 60 * 59 / 2


def test_heavy_keys_join_whole(spark):
    from staylens.llm.skew import spread_join

    rows = spark.range(3000).select(F.col("id").alias("x"), F.when(F.col("id") % 3 != 0, F.col("id") % 700).when(F.col("id") % 9 != 0, F.lit(-1)).alias("k"))
    side = spark.range(-1, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        plain = rows.join(side, "k", how).select("x", "k", "v")
        assert sorted(map(str, spread_join(rows, side, "k", "x", how, least=100).select("x", "k", "v").collect())) == sorted(map(str, plain.collect()))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40) if i % 10 != 9] + [(100, i) for i in range(101, 160)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = collections.defaultdict(set)
    for r in rows:
        groups[r.component].add(r.node)
    assert all(c in nodes for c, nodes in groups.items())
    assert sorted(map(sorted, groups.values())) == [list(range(i, i + 10)) for i in range(0, 40, 10)] + [list(range(100, 160))]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_chains_equal_quadratic_search():
    r = random.Random(1)
    for _ in range(30):
        points = sorted({(r.randrange(60), r.randrange(60)) for _ in range(25)})
        best = {}
        for p in points:
            best[p] = 12 + max([0.0, *(best[q] - 0.15 * (p[0] - q[0] + p[1] - q[1]) for q in best if q[0] < p[0] and q[1] < p[1])])
        chain = chaining.chains(points)[0]
        score = 12 * len(chain) - 0.15 * (sum(chain[-1]) - sum(chain[0]))
        assert score == pytest.approx(max(best.values()))


def test_repeated_passages(spark):
    r = random.Random(5)
    words = lambda n: r.choices(WORDS, k=n)
    p, q = words(60), words(90)
    fuzzy = [w if i % 17 != 16 else "changed" for i, w in enumerate(q)]
    texts = {i: words(200) for i in range(20)} | {
        50: words(50) + p + words(40) + q, 51: p + words(100), 52: words(30) + fuzzy + words(5), 53: words(10) + p[:45] + words(20),
    }
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = {(x.doc_id, x.source_id, x.start, x.stop) for x in substring_dedup.passages(docs).collect()}
    assert found == {(51, 50, 0, 60), (52, 50, 30, 120)}
    left = {x.doc_id: x.text.split() for x in substring_dedup.cut(docs).collect()}
    assert left[51] == texts[51][60:] and len(left[52]) == 35 and all(left[i] == t for i, t in texts.items() if i not in (51, 52))


def test_repeats_behind_partial_copies(spark):
    r = random.Random(8)
    words = lambda n: r.choices(WORDS, k=n)
    texts, whole = {}, []
    for g in range(20):
        p, at = words(60), 10 * g
        texts |= {at: words(20) + p[:45] + words(20), at + 1: words(20) + p[30:] + words(20), at + 2: words(30) + p + words(30)}
        texts |= {at + 3: words(20) + p[:45] + words(20), at + 4: words(20) + p[15:] + words(9), at + 5: words(40) + p + words(10)}
        whole.append((at + 5, at + 2, 40, 100))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = {(x.doc_id, x.source_id, x.start, x.stop) for x in substring_dedup.passages(docs).collect()}
    assert found == set(whole)
    left = {x.doc_id: x.text.split() for x in substring_dedup.cut(docs).collect()}
    assert all(left[i] == (t if i % 10 != 5 else t[:40] + t[100:]) for i, t in texts.items())


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer

    theirs, ours = Tokenizer.from_file(bpe.default_path()), bpe.Tokenizer(bpe.default_path())
    r = random.Random(3)
    pieces = list("abcABC 's't've 'LL İıßẞΣσςéÉ́ \t\n\x1c\x1d\x85\xa0　​日本한ไ🎉²½Ⅷ_-.,'<|>") + ["<|startoftext|>", "<|endoftext|>"]
    texts = ["".join(r.choices(pieces, k=r.randint(0, 30))) for _ in range(3000)] + ["a" * 3000, "abcde" * 900, "!" * 700 + "x", "", "\n", None, "word " * 100_000]
    texts += [r.choice("ab-") * 39 + "é" * k for k in range(4)] + [x[0] for x in duckdb.sql(f"SELECT text FROM '{DATA}/documents.parquet'").fetchall()]
    want = [x.ids for x in theirs.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    encoded = list(ours.encode_column(pa.array(texts)))
    assert [e.ids[a:b].tolist() for e in encoded for a, b in zip(e.bounds, e.bounds[1:])] == want
    got = [bytes(x).decode() for e in encoded for x in ours.decode_column(e.ids, e.bounds)]
    assert got == [theirs.decode(i, skip_special_tokens=False) for i in want]
    assert ours.encode("Hello World's") == theirs.encode("Hello World's", add_special_tokens=False).ids
    assert ours.decode([1, 10**6, -1, 2]) == theirs.decode([1, 10**6, 2], skip_special_tokens=False)


def test_bpe_digests_equal_the_library(spark):
    """The whole query against the library."""
    from tokenizers import Tokenizer

    theirs, sha = Tokenizer.from_file(bpe.default_path()), lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {}
    for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall():
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), sha(" ".join(map(str, ids))), sha(theirs.decode(ids, skip_special_tokens=False)))
    assert {r[0]: tuple(r)[1:] for r in bpe.op10_bpe(spark, DATA).collect()} == want


def test_bpe_encode_and_decode_frames(spark):
    docs = spark.createDataFrame([(1, "Hello World's", "x", "y"), (2, None, None, None)], "doc_id long, text string, token_ids string, decoded string")
    encoded = bpe.encode(docs)
    assert encoded.columns == ["doc_id", "decoded", "token_ids"]
    assert {x.doc_id: x.decoded for x in bpe.decode(encoded).collect()} == {1: "hello</w> world</w> 's</w>", 2: ""}
    odd = spark.createDataFrame([(1, [encoded.first().token_ids[0], None, 10**6]), (2, None), (3, [])], "doc_id long, token_ids array<int>")
    assert [x.decoded for x in bpe.decode(odd).orderBy("doc_id").collect()] == ["hello</w>", "", ""]


def test_word_hashes_do_not_depend_on_slices():
    texts = pa.array(["Aé b1-c", "", "b1 " * 50, None, "x" * 300])
    whole = [split_words(s, ALNUM_SPLIT, LOWER) for s in slices(texts)]
    parts = [split_words(s, ALNUM_SPLIT, LOWER) for s in slices(texts, 10)]
    join = lambda ws: np.concatenate([w.hashes for w in ws])
    assert (join(whole) == join(parts)).all() and len(join(whole)) == 3 + 50 + 1


def test_toxicity_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    scored = toxicity.op3_toxicity(spark, d)
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = scored.filter("held_out").join(labels, "doc_id").select("toxic", "score", "predicted").collect()
    y, s = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    auc = np.mean((s[y == 1][:, None] > s[y == 0][None, :]) + 0.5 * (s[y == 1][:, None] == s[y == 0][None, :]))
    assert auc > 0.9 and np.mean([r.predicted for r in rows if r.toxic == 1]) > 0.75
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.02 and ((s >= 0) & (s <= 1)).all()


def test_toxicity_edges(spark):
    """Empty tables, no positive label, repeated and null ids, odd labels: every row gets a score, the prior where nothing is learnt."""
    docs = frame(spark, [*ODD, "vile slur " * 30])
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 1), (3, 2, None), (None, 1, 1), (900, 1, 1)], "doc_id long, toxic int, quality int")
    for d, l in ((docs, labels), (docs, labels.limit(0)), (docs.limit(0), labels), (docs.limit(0), labels.limit(0))):
        rows = toxicity.score(docs, toxicity.train(d, l)).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
        assert all(r.held_out for r in rows if r.doc_id is None)
        if l is not labels:
            assert len({round(r.score, 9) for r in rows}) == 1
    assert toxicity.score(docs.limit(0), toxicity.train(docs, labels)).count() == 0


def test_repeated_ids_are_trained_on_once(spark):
    rows = [(i, "awful vile words here", None) for i in range(60)] + [(1000 + i, f"plain text number {i % 7} about things", None) for i in range(300)]
    docs = spark.createDataFrame(rows * 3, "doc_id long, text string, positive string")
    labels = spark.createDataFrame([(i, 1) for i in range(60)] + [(1000 + i, 0) for i in range(300)], "doc_id long, toxic int")
    model, once = toxicity.train(docs, labels), toxicity.train(docs.distinct(), labels)
    assert len(model.features) and (model.features == once.features).all() and np.allclose(model.weights, once.weights)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    assert all(got[i] == (i < 60) for i in got)


def test_pages_are_extracted():
    model, wrong, n = html_crf.default_model(), 0, 0
    for seed in range(9000, 9080):
        page, main = labelled_page(seed)
        found = blocks(page)
        for b, keep in zip(found, html_crf.viterbi(model, html_crf.page_features(found)), strict=True):
            n, wrong = n + 1, wrong + ((b.text in main and b.tag != "title") != bool(keep))
    assert wrong / n < 0.01


def test_handmade_pages():
    """Blocks of pages that were labelled independently of the training pages."""
    from handmade_pages import PAGES

    model, right, marked, main = html_crf.default_model(), 0, 0, 0
    for page, texts in PAGES:
        assert set(texts) <= {b.text for b in blocks(page)}
        found = collections.Counter(html_crf.main_text(model, page).split("\n"))
        right += sum((found & collections.Counter(texts)).values())
        marked, main = marked + sum(found.values()), main + len(texts)
    print(f"precision {right / marked:.3f}, recall {right / main:.3f} of {main} blocks")
    assert right / marked > 0.85 and right / main > 0.85


def test_malformed_pages_lose_no_text():
    texts = lambda page: [b.text for b in blocks(page)]
    cases = {
        "<p title=don't>one</p><p>two</p><p>it's</p>": ["one", "two", "it's"],
        "a<svg/>b<p>c<svg><path/></svg>d": ["ab", "cd"],
        "<!-->x<p>y": ["x", "y"], "<!--->x": ["x"], "<!-- a --!>x": ["x"], "<!-- a -- > b -->x": ["x"], "x<!-- a": ["x"],
        '<p a="x>y>z"q>t': ["t"], '<p a="x>y': ["y"], '<a href=x"y>z</a>': ["z"], "<p a = 'b>c' d>e": ["e"], '<p b=1 " c>x</p>': ["x"], "<p a=>x": ["x"],
        "<svg>x<p>y": ["x", "y"], "<select>x": ["x"], "<script>x": [], "a<style>b</style >c": ["ac"], "a<textarea/>b</textarea>c": ["ac"],
        "<p>a<table><tr><td><div>b</div>c</td></tr></table>d": ["a", "b", "c", "d"],
        "<p class=q>" + "<span>" * 12 + "a<div>b": ["a", "b"],
        "<dl><dt>a<dd>b<dt>c<dd>d</dl>e": ["a", "b", "c", "d", "e"],
        "1 < 2 <3 &lt;p&gt; </x> </p>y": ["1 < 2 <3 <p>", "y"],
    }
    assert {page: texts(page) for page in cases} == cases
    assert "m:q" not in blocks("<p class=q>" + "<span>" * 12 + "a<div>b")[1].names


@pytest.mark.parametrize(
    "page",
    ["".join(f'<div class="c{i}">' for i in range(60_000)), "".join(f"<div id=c{i}><p>x" for i in range(30_000)), '<p a="' * 40_000, "<p a=" * 40_000 + '"x' * 40_000, "<svg>" * 40_000, "<p " + "= " * 80_000, "<p><object>" + "<div>" * 60_000],
)
def test_pages_are_read_in_linear_time(page):
    begun = time.time()
    blocks(page, {})
    assert time.time() - begun < 10


def test_plain_pages_have_their_text():
    main = lambda page: html_crf.main_text(html_crf.default_model(), page)
    assert main("<div><p>Short.</p></div>") == "Short."
    assert main("<p>One unmarked paragraph of a page, and nothing else at all.</p>").startswith("One unmarked")
    assert main("<body>Bare text here.<br>More of it.</body>") == "Bare text here. More of it."
    assert main("<article><h1>Terms</h1><dl><dt>Word</dt><dd>What it means.</dd><dt>Other</dt><dd>another one</dd></dl></article>") == "Terms\nWord\nWhat it means.\nOther\nanother one"
    wrong = n = 0
    for seed in range(9000, 9100):
        page, own = plain_page(seed)
        found = blocks(page)
        for b, keep in zip(found, html_crf.viterbi(html_crf.default_model(), html_crf.page_features(found)), strict=True):
            n, wrong = n + 1, wrong + ((b.text in own and b.tag != "title") != bool(keep))
    assert wrong / n < 0.01


def test_known_marks_give_equal_labels():
    model = html_crf.default_model()
    for seed in range(9100, 9140):
        page, _ = labelled_page(seed)
        whole = html_crf.viterbi(model, html_crf.page_features(blocks(page)))
        assert html_crf.viterbi(model, html_crf.page_features(blocks(page, model.index))) == whole


def test_deep_pages():
    page = "<div class=content>" * 50_000 + "<p>One sentence here, deep down.</p>" + "</b></div>" * 50_000 + "<article><p>" + "<em>" * 50_000 + "Two." + "</i></em>" * 20_000
    found = blocks(page)
    assert [b.text for b in found] == ["One sentence here, deep down.", "Two."] and "t:article" in found[1].names and "m:content" not in found[1].names


def test_viterbi_finds_the_best_path():
    m, rng = html_crf.default_model(), np.random.default_rng(0)
    names = [list(rng.choice(sorted(m.index), 5, replace=False)) for _ in range(7)]
    e = [sum(m.emit[m.index[f]] for f in block) for block in names]
    score = lambda p: m.start[p[0]] + sum(e[i][x] for i, x in enumerate(p)) + sum(m.step[a, b] for a, b in zip(p, p[1:]))
    best = max(np.ndindex(*[2] * 7), key=score)
    assert html_crf.viterbi(m, names) == list(best)


def test_page_edges(spark):
    body = "<article><h1>T</h1><p>One &amp; two<br>three &copy;</p><script>x</script><p>Four five six seven."
    pages = [(1, "u", f"<nav><ul><li><a href=/>Home</a></li></ul></nav>{body}"), (2, None, None), (3, "u", ""), (4, "u", "<"), (None, "u", "<p <!-- ")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    rows = {r.page_id: r.text for r in html_crf.extract(df).collect()}
    assert rows[1] == "T\nOne & two three ©\nFour five six seven." and rows[2] == rows[3] == "" and len(rows) == 5


def test_archives(spark):
    pages = [(5, "u", "x" * 200), (3, "v", "x" * 200), (None, None, None), (9, "w", "a\n\x00ü"), (9, "w", "a\n\x00ü"), (7, "q\r\nX: y", "x" * 200)]
    path = new_path(spark, "warc")
    warc.write_archives(warc.with_targets(spark.createDataFrame(pages, "page_id long, url string, html string")), path)
    rows = sorted(((r.page_id or 0), r.record_type, r.refers_to, r.payload_bytes, r.record_ok) for r in warc.read_archives(spark, path).collect())
    assert rows == [(0, "response", None, 0, True), (3, "response", None, 200, True), (5, "revisit", 3, 200, True), (7, "revisit", 3, 200, True), (9, "response", None, 5, True), (9, "response", None, 5, True)]
    assert warc.read_archives(spark, path).filter("problem IS NOT NULL").count() == 0
    path = new_path(spark, "warc")
    warc.write_archives(warc.with_targets(spark.createDataFrame([], "page_id long, url string, html string")), path)
    assert warc.read_archives(spark, path).count() == 0


def test_long_urls_are_read_back(spark):
    pages = [(1, "http://x.org/" + "a" * 200_000, "text"), (2, "http://x.org/" + "é" * 70_000, "text")]
    path = new_path(spark, "warc")
    warc.write_archives(warc.with_targets(spark.createDataFrame(pages, "page_id long, url string, html string")), path)
    rows = {r.page_id: (r.url, r.payload_bytes, r.record_ok, r.problem) for r in warc.read_archives(spark, path).collect()}
    assert rows == {i: (url, 4, True, None) for i, url, _ in pages}


def test_broken_records():
    sha = hashlib.sha256(b"payload").hexdigest()
    good, again = warc.record(1, "u", b"payload", sha), warc.record(2, "v", b"payload", sha, 1, "u")
    assert warc.parse_record(good) == (1, 7, sha, "response", None, "u") and warc.parse_record(again) == (2, 7, sha, "revisit", 1, "v")
    bad = [good[:-1], good.replace(b"payload", b"Payload"), good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"Content-Length: 7", b"Content-Length: x"), b"nothing"]
    bad += [good.replace(b"WARC-Date: 1970", b"WARC-Date: x"), re.sub(rb"WARC-Date: [^\r]*\r\n", b"", good), re.sub(rb"WARC-Record-ID: [^\r]*\r\n", b"", good)]
    bad += [re.sub(rb"WARC-Profile: [^\r]*\r\n", b"", again), again.replace(b"revisit/identical", b"revisit/other"), good.replace(b"X-Page-ID: 1", b"X-Page-ID: one")]
    for raw in bad:
        with pytest.raises(warc.WarcError):
            warc.parse_record(raw)
    for archive in (b"", b"junk", warc.DICT_MAGIC + b"\xff\0\0\0", warc.dictionary_frame([])[0] + b"junk!"):
        with pytest.raises(warc.WarcError):
            list(warc.frames(archive))


def test_frames_end_where_their_blocks_do():
    import zstandard

    r = random.Random(1)
    records = [b"", b"x" * 500_000, r.randbytes(300_000), b"short", b" ".join(r.choices([b"one", b"two", b"three"], k=90_000))]
    lead, _ = warc.dictionary_frame([])
    for packer in (zstandard.ZstdCompressor(3), zstandard.ZstdCompressor(1, write_checksum=True), zstandard.ZstdCompressor(3, write_content_size=False)):
        packed = [packer.compress(x) for x in records]
        assert list(warc.frames(lead + warc.SEPARATOR.join(packed))) == records
        whole = lead + b"".join(packed)
        for cut in (len(whole) - 1, len(lead) + len(packed[0]) + 3, len(whole) - len(packed[-1]) + 7):
            with pytest.raises(warc.WarcError):
                list(warc.frames(whole[:cut]))
    broken = bytearray(b"".join([lead, *map(zstandard.ZstdCompressor(3, write_checksum=True).compress, records)]))
    broken[-2] ^= 1  # a checksum: the other records are read
    found = list(warc.frames(bytes(broken)))
    assert found[:-1] == records[:-1] and isinstance(found[-1], warc.WarcError)


def test_a_long_archive_is_read_in_linear_time():
    import time

    import zstandard

    r = random.Random(2)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    payloads = [r.randbytes(5_000) for _ in range(10_000)]
    archive = b"".join([warc.dictionary_frame([])[0], *(zstandard.ZstdCompressor(1).compress(warc.record(i, "u", p, sha(p))) for i, p in enumerate(payloads))])
    began = time.time()
    assert len(archive) > 50_000_000 and [warc.parse_record(x)[:2] for x in warc.frames(archive)] == [(i, 5_000) for i in range(10_000)]
    assert time.time() - began < 10


def test_archives_are_bounded(spark, tmp_path):
    pages = spark.range(3000).selectExpr("id AS page_id", "concat('http://x.org/', id) AS url", "repeat(concat('text ', cast(id % 2000 AS string), ' and more '), 40) AS html").repartition(2)
    rows = warc.with_targets(pages)
    warc.write_archives(rows, f"file://{tmp_path}/w", date="2024-05-01T00:00:00Z", archive_bytes=20_000)
    files = [x for x in (tmp_path / "w").iterdir() if x.name.startswith("part-")]
    assert len(files) > 3 and max(x.stat().st_size for x in files) < 60_000 and all(x.read_bytes()[:4] == warc.DICT_MAGIC for x in files)
    raw = [x for f in files for x in warc.frames(f.read_bytes())]
    ids = [re.search(rb"WARC-Record-ID: (\S+)", x)[1] for x in raw]
    assert len(raw) == len(set(ids)) == 3000 and all(b"WARC-Date: 2024-05-01T00:00:00Z" in x for x in raw)
    got = {r.page_id: (r.record_type, r.refers_to, r.problem) for r in warc.read_archives(spark, f"file://{tmp_path}/w").collect()}
    assert got == {i: ("revisit", i - 2000, None) if i >= 2000 else ("response", None, None) for i in range(3000)}


def test_url_edges(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/7x?q", "http://free-bets.example.org/x", "http://freebets.example.org/", "http://x.org/casino", "http://b.example.net/de/81", "http://notexample.net/de/8"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in url_filter.judge_urls(df).collect()}
    assert got[0] == got[1] == got[2] == got[3] == ("", None, "allow")
    assert got[4] == ("a.example.com", "example.com/en/7", "allow") and got[5][2] == "block" and got[6][2] == "allow" and got[7][2] == "block"
    assert got[8][1:] == ("example.net/de/8", "block") and got[9][1:] == ("net/de/", "allow")


def test_urls_are_searched_as_a_whole(spark):
    urls = ["https://example.com/search?q=porn+casino", "www.casino-xxx.com/a", "http://x.org/#free-bets", "http://x.org/a?q=freebets", "http://x.org/a?next=http://y.org/XXX", "http://a.net/de/?q=casino"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.verdict, r.strict_hits, r.soft_hits) for r in url_filter.judge_urls(df).collect()}
    assert got[0] == ("example.com", "/search", "block", 2, 0) and got[1] == ("", "", "block", 2, 0)
    assert got[2] == ("x.org", "/", "block", 0, 2) and got[3][2:] == ("allow", 0, 0) and got[4][2:] == ("block", 1, 0)
    assert got[5] == ("a.net", "/de/", "allow", 1, 0)


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", 0, "lookup", '{"key":1.5,"query":"x","z":[1]}', []),
            (1, "b", 1, "nope", "{}", ["a"]),
            (1, "c", 2, "search", '{"query":3}', ["a", "b"]),
            (1, "d", 3, "search", "{bad", ["e"]),
            (1, "e", 4, "search", None, ["d"]),
            (1, None, 5, "search", "[1]", []),
            (1, "f", 6, "search", '{"query":"q" , "limit":2}', ["zz"]),
        ],
        "conv_id long, call_id string, turn long, name string, arguments string, needs array<string>",
    )
    results = spark.createDataFrame([("a", 9, "late"), ("a", 8, "first"), ("q", 1, "x"), (None, 2, "n")], "call_id string, turn long, content string")
    tools = spark.createDataFrame(tool_calls.TOOLS, "name string, parameter string, type string, required boolean")
    rows = {r.turn: r for r in tool_calls.linked(calls, results, tools).collect()}
    assert [rows[i].level for i in range(7)] == [0, 1, 2, None, None, None, None]
    assert [rows[i].errors for i in range(7)] == ["type:key,unknown:z", "tool", "type:query", "json", "json", "json", ""]
    assert rows[0].canonical == '{"arguments":{"key":1.5,"query":"x","z":[1]},"id":"a","name":"lookup","result":"first"}'
    assert rows[6].canonical == '{"arguments":{"limit":2,"query":"q"},"id":"f","name":"search","result":null}'
    assert tool_calls.orphans(calls, results).count() == 2
    assert tool_calls.linked(calls.limit(0), results, tools).count() == 0 and tool_calls.linked(calls, results.limit(0), tools.limit(0)).count() == 7


NUMBERS = {
    "1E2": "100", "100.0": "100", "1.0": "1", "-0.0": "0", "0e9": "0", "0.1e-7": "1e-8", "1e400": "1e+400", "-1.50E-3": "-0.0015", "0.000001": "0.000001", "1e-7": "1e-7",
    "123456789012345678901": "123456789012345678901", "1234567890123456789012": "1.234567890123456789012e+21", "1e21": "1e+21", "1e20": "100000000000000000000",
    "0.30000000000000000000000001": "0.30000000000000000000000001", "12.340": "12.34", "1e99999999999999999999": "1e99999999999999999999",
}


def test_equal_numbers_have_one_canonical_text(spark):
    rows = spark.createDataFrame([(f'{{"b":[{n}], "a" : {{"z":"{n}","y":{n}}}}}',) for n in NUMBERS] + [("[1 ,-2,\"-3 4\",true]",), ('"a\\"1"',), ("01",), ("1 2",), ('{"a":1} x',), (None,), ('{"a":1,"a":2}',)], "j string")
    got = [r[0] for r in rows.select(tool_calls.canonical(F.col("j"))).collect()]
    assert got[: len(NUMBERS)] == [f'{{"a":{{"y":{c},"z":"{n}"}},"b":[{c}]}}' for n, c in NUMBERS.items()]
    assert got[len(NUMBERS) :] == ['[1,-2,"-3 4",true]', '"a\\"1"', None, None, None, None, None]
    text = r"x\n\"" * 200_000
    long = spark.createDataFrame([('{"b":1.0,"a":"' + text + '"}',)], "j string").select(tool_calls.canonical(F.col("j"))).first()[0]
    assert long == '{"a":"' + text + '","b":1}'


def test_nested_schemas(spark):
    schema = [
        ("t", "filter", "object", True, None), ("t", "filter.lang", "string", True, ['"en"', '"de"']), ("t", "filter.range.low", "integer", True, None),
        ("t", "ids", "array<integer>", False, None), ("t", "names", "array<string>", False, None), ("t", "n", "number", False, None),
    ]
    schemas = spark.createDataFrame(schema, "name string, parameter string, type string, required boolean, allowed array<string>")
    cases = {
        '{"filter":{"lang":"en","range":{"low":1}}}': "",
        '{"filter":{"lang":"fr","range":{"low":1.5}},"n":1e400}': "type:filter.range.low,value:filter.lang",
        '{"filter":{"lang":"de","range":{"low":1E2}},"ids":[1,2.0],"names":[]}': "",
        '{"filter":{"range":{}},"ids":[1,"x"],"names":["a"]}': "missing:filter.lang,missing:filter.range.low,type:ids",
        '{"filter":{"lang":3},"ids":3,"other":{}}': "type:filter.lang,type:ids,unknown:other",
        '{"filter":"x"}': "missing:filter.lang,type:filter",
        "{}": "missing:filter",
        "[]": "json",
    }
    calls = spark.createDataFrame([(1, f"c{i}", i, "t", a, []) for i, a in enumerate(cases)], "conv_id long, call_id string, turn long, name string, arguments string, needs array<string>")
    results = spark.createDataFrame([], "call_id string, turn long, content string")
    got = {r.turn: r.errors for r in tool_calls.linked(calls, results, schemas).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_calls_that_share_identifiers_and_needs(spark):
    """Hot identifiers, hot needs and joints, against a plain topological order."""
    r = random.Random(6)
    needs = {i: sorted(r.sample(range(max(0, i - 40), i), min(i, r.choice([0, 1, 1, 1, 2, 3])))) if i % 50 else [0] * (i > 0) for i in range(600)}
    rows = [(1, f"c{i}", i, "search", "{}", [f"c{x}" for x in v]) for i, v in needs.items()] + [(1, None, 1000 + i, "search", "{}", ["c0"]) for i in range(300)]
    rows += [(2, "c5", 2000 + i, "search", "{}", [f"c{x}" for x in needs[5]]) for i in range(300)]
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, turn long, name string, arguments string, needs array<string>")
    results = spark.createDataFrame([("c5", 7 - i % 3, "r") for i in range(400)] + [("c0", 1, "x")], "call_id string, turn long, content string")
    tools = spark.createDataFrame(tool_calls.TOOLS, "name string, parameter string, type string, required boolean")
    level = {}
    for i, v in needs.items():
        level[i] = 1 + max(level[x] for x in v) if v else 0
    got = {x.turn: x for x in tool_calls.linked(calls, results, tools).collect()}
    assert len(got) == len(rows) and all(got[i].level == level[i] for i in needs)
    assert all(got[1000 + i].level is None and got[1000 + i].n_results == 0 for i in range(300))
    assert all((got[i].n_results, got[i].result_turn) == (400, 5) for i in [5, *range(2000, 2300)]) and got[0].n_results == 1


def test_long_chains_take_few_rounds(spark):
    rows = [(1, f"c{i}", i, "search", "{}", [f"c{i - 1}"] if i else []) for i in range(300)]
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, turn long, name string, arguments string, needs array<string>")
    assert {r.call_id: r.level for r in tool_calls.levels(calls).collect()} == {f"c{i}": i for i in range(300)}


def test_base_figures_and_depleted_documents(spark):
    r = random.Random(2)
    common = " ".join(r.choices(WORDS, k=60))
    texts = [common + "\n" + " ".join(r.choices(WORDS, k=70 if i % 2 else 50)) for i in range(60)] + [" ".join(r.choices(WORDS, k=80))]
    docs = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    kept = {x.doc_id: x.kept for x in line_quality.judge(docs).collect()}
    assert kept == {i: bool(i % 2) for i in range(60)} | {60: True}
    left = {x.doc_id: x.text for x in line_quality.filter_documents(docs).collect()}
    assert set(left) == {i for i in range(61) if kept[i]} and all(common not in t for t in left.values())


def _runs(words, n=50):
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]


def _components(bags):
    """Classes of texts by brute force: a weighted Jaccard similarity of 0.8 or more of five-word shingles, joined."""
    up = {i: i for i in bags}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(bags)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = bags[i], bags[j]
            if a and b and min(sum(a.values()), sum(b.values())) >= 0.8 * max(sum(a.values()), sum(b.values())):
                if sum((a & b).values()) >= 0.8 * sum((a | b).values()) - 1e-9:
                    x, y = top(i), top(j)
                    up[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def _bag(text):
    words = plain_words(text)
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else collections.Counter()


def test_near_dup_query_equals_brute_force(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall())
    want = _components({i: _bag(t) for i, t in texts.items()})
    first = {}
    for i in sorted(texts):  # texts without words are copies of each other if equal
        if not plain_words(texts[i]):
            want[i] = first.setdefault(texts[i] or "", i)
    got = near_dup.op4_near_dup(spark, DATA).collect()
    assert {r.doc_id: r.class_id for r in got} == want and all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_repeated_passage_query_against_brute_force(spark):
    """Every word in a run of 50 that an earlier document has lies in a passage found, and every passage found is one."""
    words = {i: plain_words(t) for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall()}
    got = substring_dedup.op5_substring_dedup(spark, DATA).collect()
    seen, missed, found = set(), 0, collections.defaultdict(set)
    for r in got:
        assert r.source_id < r.doc_id and r.stop - r.start >= 50 and r.matched >= 0.8 * max(r.stop - r.start, r.source_stop - r.source_start)
        both = collections.Counter(words[r.doc_id][r.start : r.stop]) & collections.Counter(words[r.source_id][r.source_start : r.source_stop])
        assert sum(both.values()) >= r.matched
        found[r.doc_id] |= set(range(r.start, r.stop))
    total = 0
    for i in sorted(words):
        own = _runs(words[i])
        covered = {k + d for k, run in enumerate(own) if run in seen for d in range(50)}
        missed, total = missed + len(covered - found[i]), total + len(covered)
        seen |= set(own)
    assert total > 500 and not missed


def test_pipeline_against_brute_force(spark, duck):
    """Each stage on what the stage before has kept, against plain Python or SQL."""
    from tokenizers import Tokenizer

    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, DATA), "stage")
        kept.append(docs)
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    quality, near, passages, bench, tokens = ({r.doc_id: r for r in x.collect()} for x in kept)
    verdicts = dict(duck.sql(f"SELECT doc_id, kept FROM ({line_quality.ORACLE})").fetchall())
    assert set(quality) == {i for i, ok in verdicts.items() if ok}
    classes = _components({i: _bag(r.text) for i, r in quality.items()})
    assert set(near) == set(classes.values()) and all(near[i].text == quality[i].text for i in near)
    seen = set()
    for i in sorted(near):
        assert not seen & set(_runs(plain_words(passages[i].text))), i
        seen |= set(_runs(plain_words(near[i].text)))
    windows = {w for (t,) in duck.sql("SELECT text FROM benchmark").fetchall() for w in (_runs(plain_words(t), 10) or [tuple(plain_words(t))]) if w}
    assert set(bench) == set(passages)
    for r in bench.values():
        own = plain_words(r.text)
        assert not any(w in windows for n in {len(x) for x in windows} for w in _runs(own, n))
    theirs = Tokenizer.from_file(bpe.default_path())
    assert {i: list(r.token_ids) for i, r in tokens.items()} == {i: theirs.encode(r.text or "", add_special_tokens=False).ids for i, r in bench.items()}


def test_pipeline_runs_its_stages(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, DATA).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows) and all(r.n_tokens == len(r.token_ids) for r in rows)
