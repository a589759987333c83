"""Periodic runs against every period at every place."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from staylens.llm import periodic_runs
from staylens.llm.suffix_automaton import Positions, runs

EMPTY = hashlib.sha256(b"").hexdigest()


def plain_runs(s, least=2):
    """(start, length, smallest period): stretches of pairs at each distance, of equal stretches the smallest period."""
    out = {}
    for q in range(1, len(s) // 2 + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((a, n, q) for (a, n), q in out.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 4).flatmap(lambda k: st.lists(st.integers(0, k), max_size=60)), st.integers(1, 9), st.integers(0, 59))
def test_runs_equal_brute_force(letters, period, start):
    assert runs(letters) == plain_runs(letters)
    again = [letters[i] if i < start else letters[start + (i - start) % period] for i in range(len(letters)) if start + period <= len(letters)]
    assert runs(again, 12) == plain_runs(again, 12)


def test_runs_of_the_densest_words():
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    assert runs(b) == plain_runs(b)
    assert runs([0] * 5000) == [(0, 5000, 1)]
    assert runs([]) == runs([1]) == runs([1, 2, 3]) == []


def test_ordered_positions_keep_their_neighbours():
    random.seed(5)
    order = random.sample(range(10_000), 5_000)
    own, held = Positions(order[0]), [order[0]]
    for x in order[1:]:
        below, above = [y for y in held[-40:] if y < x], [y for y in held[-40:] if y > x]
        before, after = own.insert(x)
        assert before < x and (after == -1 or after > x)
        assert not below or max(below) <= before
        assert not above or min(above) >= after > x
        held.append(x)
    assert list(own) == sorted(order) and own.size == len(order)


def plain_document(doc_id, text):
    """The contract, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n and doc_id is not None:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words, 12)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(listed), sha(kept)


def test_documents_with_runs_edges_and_clashing_names(spark):
    random.seed(2)
    texts = [None, "", " \t\n", "a " * 11, "a " * 12, "a b " * 6, "a\x0bb\x0ca\rb " * 4, "x " + "a b c d e f g " * 2, "ä ö " * 9, "word " * 1_500, "q" * 100_000]
    for _ in range(150):
        some = [random.choice("abc") for _ in range(random.randint(0, 90))]
        texts.append(" ".join(random.choice([some, some * 3, [*some, *"uvwxyz", *some]])))
    rows = [(i, t, "en", 1, "x") for i, t in enumerate(texts)] + [(7, texts[7], None, 2, "y"), (None, "b " * 30, None, 3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_runs long, `start.of` string")
    got = collections.Counter(tuple(r) for r in periodic_runs.digests(docs, rewrite=periodic_runs.planted).collect())
    assert got == collections.Counter(plain_document(r[0], r[1]) for r in rows)


def test_interfaces_of_runs(spark):
    docs = spark.createDataFrame([(1, "x " + "a b c " * 5 + "y"), (2, None), (None, "no run here")], "doc_id long, text string")
    assert [tuple(r) for r in periodic_runs.find_runs(docs).collect()] == [(1, 1, 15, 3)]
    assert {r.doc_id: r.text for r in periodic_runs.collapsed(docs).collect()} == {1: "x a b c y", 2: "", None: "no run here"}
    assert [r.length for r in periodic_runs.find_runs(docs, 16).collect()] == []
    assert periodic_runs.digests(docs.limit(0)).count() == 0


@pytest.mark.parametrize("least", [2, 3, 12, 13])
def test_stretches_lose_no_run(least):
    import numpy as np

    random.seed(least)
    for _ in range(200):
        parts = [[random.randrange(3) for _ in range(random.randint(0, 50))] for _ in range(3)]
        bounds = np.cumsum([0, *map(len, parts)])
        found = periodic_runs.runs_of_texts(np.array([c for p in parts for c in p], np.int64), bounds, least)
        assert found == [plain_runs(p, least) for p in parts]
