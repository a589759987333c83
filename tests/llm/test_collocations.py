"""Collocations against a plain count of all phrases."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from staylens.llm import collocations


def plain(rows, least, longest, first, inside=80):
    """The contract, phrase by phrase."""
    total, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate({c: c + 32 for c in range(65, 91)})):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    kept = collections.defaultdict(list)
    often = {p: a for p, a in f.items() if a >= least}
    inner = collections.Counter()
    for (lang, p), a in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inner[lang, p[i : i + k]] = max(inner[lang, p[i : i + k]], a)
    for (lang, p), a in often.items():
        if len(p) > 1 and 100 * inner[lang, p] < inside * a:
            cut = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            kept[lang].append((-cut[0], -a, " ".join(p).encode(), f[lang, p[: cut[1]]], f[lang, p[cut[1] :]]))
    return sorted((lang, i + 1, p.decode(), -a, le, r, total[lang], -s) for lang, own in kept.items() for i, (s, a, p, le, r) in enumerate(sorted(own)[:first]))


def frame(spark, rows):
    return spark.createDataFrame([(i % 7, text, lang, "x", 1) for i, (lang, text) in enumerate(rows)], "doc_id long, text string, lang string, word string, `rank.f` int")


@pytest.mark.parametrize("block_bytes", [1, 700, 16_000_000])
def test_phrases_equal_a_plain_count(spark, block_bytes):
    random.seed(4)
    phrases = ["of the", "New York City", "a a a", "it is what it is", "É x y", "日本 語"]
    rows = [(None, None), ("en", ""), ("en", " .,!? "), ("xx", "one"), ("und", "x y z " * 30), (None, "x y z, x\ty\x0bz " * 9), ("xx", "word " * 4000), ("xx", "w" * 60_000)]
    for _ in range(120):
        parts = [random.choice([*phrases, "up", "down", "the", "THE", "of"]) + random.choice([" ", "  ", ". ", ",", "\n", "\t"]) for _ in range(random.randint(0, 60))]
        rows.append((random.choice(["en", "fr", None]), "".join(parts)))
    rows += rows[20:40] * 2
    got = collocations.collocations(frame(spark, rows), least=8, first=60, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got)) == plain(rows, 8, 4, 60)


def test_other_lengths_and_no_candidates(spark):
    rows = [("en", "a b c d e f " * 12)] * 2
    assert sorted(map(tuple, collocations.collocations(frame(spark, rows), least=5, longest=6).collect())) == plain(rows, 5, 6, 2000)
    assert sorted(map(tuple, collocations.collocations(frame(spark, rows), least=5, longest=2).collect())) == plain(rows, 5, 2, 2000)
    assert collocations.collocations(frame(spark, rows), least=500).count() == 0
    assert collocations.collocations(frame(spark, rows).limit(0)).count() == 0


def test_frequent_phrases_carry_their_parts(spark):
    found = collocations.frequent_phrases(frame(spark, [("en", "a b c. a b. b c. a")]), least=1, longest=3)
    assert {(r.phrase, r.f, tuple(r.begins), tuple(r.ends)) for r in found[2].collect()} == {("a b c", 1, (3, 2, 1), (2, 2, 1))}
    assert {(r.phrase, r.f) for r in found[1].collect()} == {("a b", 2), ("b c", 2)}


def test_scores_beyond_64_bits(spark):
    huge = 9_000_000_000_000_000_000
    df = spark.createDataFrame([(huge, [huge, huge], [huge, huge])], "a long, b array<long>, e array<long>")
    assert df.select(collocations.score(df.a, df.b, df.e, 2).alias("s")).select("s.score", "s.l").first() == (1_000_000, huge)


def test_packed_lists_are_read_back():
    rng = np.random.default_rng(6)
    for n in (0, 1, 5, 3000):
        lengths = rng.integers(1, 40, n).astype(np.int32)
        lists = [np.sort(rng.choice(rng.choice([50, 20_000, 1_000_000]), k, replace=False) * rng.choice([1, 2000])) for k in lengths]
        positions = np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64)
        assert np.array_equal(collocations.unpack(collocations.pack(positions, lengths), lengths), positions)


def test_lists_are_vertical_and_whole():
    words, lengths, positions = collocations.word_lists(pa.array(["b a b. a", "a b"]))
    lists = dict(zip(words.to_pylist(), np.split(positions, np.cumsum(lengths)[:-1]), strict=True))
    ids = np.array([{"a": 10, "b": 20}[w] for w in words.to_pylist()])
    assert sorted(words.to_pylist()) == ["a", "b"] and [np.diff(x).min() > 0 for x in lists.values()] == [True, True]
    lefts, rights, many, place = collocations.extended(lengths, positions, np.array([0, 1]), ids)  # both are frequent
    assert {(x, y): n for x, y, n in zip(lefts.tolist(), rights.tolist(), many.tolist(), strict=True)} == {(10, 20): 2, (20, 10): 1} and many.sum() == len(place)


def test_lists_are_written_of_frequent_phrases_alone(spark, monkeypatch):
    """Rare phrases are counted and leave no list, and each round counts its own share of the phrases."""
    seen = {}
    keep = collocations.written

    def noted(df, what, *codec):
        table = keep(df, what, *codec)
        if what in ("lists", "phrases"):
            seen.setdefault(what, []).append([r.asDict() for r in table.collect()])
        return table

    monkeypatch.setattr(collocations, "written", noted)
    rare = " ".join(f"{a} {b}" for a in "cdefgh" for b in "cdefgh")
    rows = [("en", "a b a b. " * 5 + rare + ".")] * 3 + [("fr", "a b. " * 20)]
    found = collocations.frequent_phrases(frame(spark, rows), least=25, longest=3)
    assert {(r.phrase, r.f) for r in found[1].collect()} == {("a b", 30)} and found[2].count() == 0
    words, pairs = seen["lists"]
    assert {len(r["ids"]) for r in words} == {8} and {len(r["ids"]) for r in pairs} == {1}  # of 38 pairs that stand in the block
    assert [len(r["ids"]) for r in pairs] == [len(r["lengths"]) for r in pairs] and len(seen["phrases"]) == 2 * collocations.ROUNDS
    ids = np.arange(4000)
    assert 1800 < (collocations._round(ids << 43, ids[::-1] << 28, 2) == 1).sum() < 2200
