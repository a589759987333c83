"""Segmentation, language profiles, quantiles, structural differences, ranges of users and the funnel against brute force."""

import datetime
import hashlib
import itertools
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from staylens.functions import language, lexicons
from staylens.operators import links, profiles, quantiles, reviews, segmentation
from staylens.operators.stats import bigram_frequency
from staylens.plans import adapter, cleaning, text_queries

DATA = "/root/testdata/sf0.001"


def test_word_lists_hold_their_fixed_values():
    """Literal values, as a query and its SQL are built from the same lists."""
    assert len(lexicons.ENGLISH) == 212 and len(lexicons.INDONESIAN) == 21 and len(lexicons.ABBREVIATIONS) == 255
    assert {"highly_recommend", "fantastic_place", "perfect_location", "lovely_host", "quiet_area", "comfortable_bed", "motorbike_parking", "no_problem", "thank_you", "thanks_again", "best_wishes"} <= set(lexicons.ENGLISH)
    assert "hội an" in lexicons.INDONESIAN and lexicons.INDONESIAN[11:15] == ("da nang", "hội an", "hanoi", "ho chi minh")
    some = {"FRENCH": "petit", "ITALIAN": "colazione", "BRAZILIAN": "café da manhã", "ARABIC": "فندق", "CHINESE": "下龙湾", "KOREAN": "좋았어요", "JAPANESE": "ホーチミン", "THAI": "โฮจิมินห์", "VIETNAMESE": "vòi sen", "FOREIGN_INDICATORS": "coucher de soleil"}
    assert all(word in getattr(lexicons, name) for name, word in some.items())
    entries = itertools.chain.from_iterable(getattr(lexicons, n) for n in (*some, "ENGLISH", "INDONESIAN", "FOREIGN_TOKENS"))
    assert all(w == " ".join(w.split()) for w in entries)


def test_every_language_rule_decides_some_comment(spark):
    found = adapter.comments(spark, DATA).select(language.language_rule(F.col("text"), F.col("country")).alias("rule")).groupBy("rule").count()
    assert {r["rule"] for r in found.collect()} == {*range(1, 23), 24}


def test_cleaning_is_not_vacuous_and_its_funnel_adds_up(spark):
    seen = cleaning.Funnel()
    cleaned = cleaning.clean(cleaning.said(spark, DATA), ("review_id",), lexicon=cleaning.LEXICON, funnel=seen)
    rows, steps = cleaned.collect(), seen.rows()
    counts = [n for _, n in steps]
    assert [s for s, _ in steps] == list(cleaning.STEPS) and counts == sorted(counts, reverse=True) and len(set(counts)) > 4
    assert len(rows) == counts[-1] > 100 and sorted(r.stt for r in rows) == list(range(1, len(rows) + 1))
    assert any("_" in r.word_segmented for r in rows) and all(r.is_vietnamese for r in rows)


def paths(words, longest):
    """All segmentations of a list."""
    if not words:
        yield []
    for k in range(1, min(longest, len(words)) + 1):
        for rest in paths(words[k:], longest):
            yield [k, *rest]


def test_cheapest_path_of_all():
    random.seed(3)
    for _ in range(400):
        words = [random.choice("abcd") for _ in range(random.randint(0, 9))]
        costs = {" ".join(random.choice("abcd") for _ in range(random.randint(1, 3))): random.randint(0, 9) for _ in range(30)}

        def cost(sizes, words=words, costs=costs):
            at, total = 0, 0
            for k in sizes:
                piece = " ".join(words[at : at + k])
                total += costs.get(piece, 11 if k == 1 else math.inf)
                at += k
            return total

        found = segmentation.best_path(words, costs, 3, 11)
        least = min(map(cost, paths(words, 3)))
        # Of equal paths, the one whose last piece is shortest, then the one before it.
        assert cost(found) == least and found == min((p for p in paths(words, 3) if cost(p) == least), key=lambda p: p[::-1])


def test_segmentation_learns_terms(spark):
    random.seed(8)
    texts = [" ".join(random.choice(["khách sạn", "Khách Sạn", "đẹp", "sạch", "rất", "xa, gần"]) for _ in range(30)) for _ in range(60)] + [None, "", "...", "à _x_ 9"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    terms = segmentation.learn_terms(df, "text", penalty=1_000_000)
    found = {r.term: r for r in terms.collect()}
    assert found["khách sạn"].words == 2 and "xa gần" not in found
    out = {r.i: r.word_segmented for r in segmentation.segment_lattice(df, "text", terms).collect()}
    assert all("khách_sạn" in out[i].lower() and "khách sạn" not in out[i].lower() for i in range(60) if "khách" in texts[i].lower())
    assert all(out[i].replace("_", " ").split() == texts[i].replace(",", " ,").split() for i in range(60))
    assert (out[60], out[61], out[62], out[63].split()[-1]) == ("", "", ". . .", "9")
    assert segmentation.segment_lattice(df.limit(0), "text", terms).count() == 0
    few = segmentation.learn_terms(df, "text", max_words=2, max_terms=1)
    assert sorted(r.words for r in few.collect()) == [1, 1, 2, 3]


def test_language_profiles_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    profile = profiles.fit(docs.filter("doc_id % 5 <> 0"), "text", "lang")
    found = profiles.detect(docs.filter("doc_id % 5 = 0"), "doc_id", "text", profile).join(docs, "doc_id")
    good, n = found.agg(F.count_if(F.col("detected") == F.col("lang")), F.count(F.lit(1))).first()
    assert n > 150 and good / n > 0.98


def test_profiles_equal_a_plain_count(spark):
    import collections

    rows = [(1, "abab ab", "x"), (2, "bcd Bcd", "y"), (3, "zzz", "y"), (4, None, "x"), (5, "", None), (6, "ab bcd", None), (7, "123", "x"), (8, "q" * 40_000, None)]
    df = spark.createDataFrame(rows, "i long, t string, lang string")
    grams = lambda t: [g for s in [" " + " ".join("".join(c if c.isalpha() else " " for c in (t or "").lower()).split()) + " "] for g in (s[k : k + 3] for k in range(len(s) - 2))]
    count = collections.defaultdict(collections.Counter)
    for _, t, lang in rows:
        if lang:
            count[lang].update(grams(t))
    got = {(r.lang, r.gram): (r.weight, r.base) for r in profiles.fit(df, "t", "lang").collect()}
    base = {k: round((math.log(0.5) - math.log(sum(c.values()))) * 1e6) for k, c in count.items()}
    assert got == {(k, ""): (0, base[k]) for k in count} | {(k, g): (round((math.log(n + 0.5) - math.log(0.5)) * 1e6), base[k]) for k, c in count.items() for g, n in c.items()}
    want = {}
    for i, t, _ in rows:
        score = {k: sum(got.get((k, g), (0, 0))[0] + base[k] for g in grams(t)) for k in base}
        if grams(t):
            want[i] = min(score, key=lambda k: (-score[k], k))
    assert {r.i: r.detected for r in profiles.detect(df, "i", "t", profiles.fit(df, "t", "lang")).collect()} == want


def test_outside_detector_decides_what_is_left_open(spark):
    text = "xin cho ở lại một đêm nha bạn"
    df = spark.createDataFrame([("toi nay minh di choi ở day", "vi"), ("toi nay minh di choi o day", "vi"), ("toi nay minh di choi ở day", "en"), ("toi nay minh di choi ở day", None), (text, "en")], "t string, d string")
    got = [r[0] for r in df.select(language.is_vietnamese_simple(F.col("t"), None, F.col("d"))).collect()]
    assert got == [True, False, False, False, True]


@pytest.mark.parametrize("bins", [2, 512])
def test_quantiles_of_any_distribution(spark, bins):
    random.seed(1)
    odd = lambda: random.choice([random.gauss(0, 1), random.random() * 1e12, -random.random(), 5.0, 1 + random.randint(0, 9) * 2.3e-16])
    rows = [(k, odd()) for k in ("a", "b", None) for _ in range(150)]
    rows += [("d", 1.0), ("e", None), ("f", math.inf), ("f", 1.0), ("f", 2.0), ("f", -math.inf), ("f", 3.0), ("g", math.nan), ("h", -0.0), ("h", 0.0)]
    shares = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.n, r.q) for r in quantiles.quantiles(df, "k", "v", shares, bins).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        v = sorted(x for key, x in rows if key == k and x is not None and not math.isnan(x))
        if v:
            ends = [(s * (len(v) - 1), math.floor(s * (len(v) - 1)), math.ceil(s * (len(v) - 1))) for s in shares]
            want[k] = (len(v), [v[a] if a == b else (b - p) * v[a] + (p - a) * v[b] for p, a, b in ends])
    assert str(got.keys() ^ want.keys()) == "set()"
    assert all(got[k][0] == want[k][0] and all(x == y or (math.isnan(x) and math.isnan(y)) for x, y in zip(got[k][1], want[k][1], strict=True)) for k in want)
    assert quantiles.boxes(df.limit(0), "k", "v").count() == 0


def flat(x, path="$"):
    """Leaves of a JSON value by path."""
    if isinstance(x, dict) and x:
        for k, v in x.items():
            yield from flat(v, f"{path}.{k}" if k.replace("_", "a").isalnum() and k.isascii() else f'{path}."{k}"')
    elif isinstance(x, list) and x:
        for i, v in enumerate(x):
            yield from flat(v, f"{path}[{i}]")
    else:
        yield path, x


def test_structural_differences_of_random_documents(spark):
    random.seed(6)

    def value(depth):
        kind = random.randint(0, 7 if depth else 5)
        plain = [None, True, random.randint(0, 3), random.choice(["", "é", 'a"b']), 1.5, random.choice([[], {}])]
        return plain[kind] if kind < 6 else [value(depth - 1) for _ in range(random.randint(0, 3))] if kind == 6 else {random.choice(["a", "b c", "d_1", "é"]): value(depth - 1) for _ in range(3)}

    left = {f"n{i}": value(4) for i in range(60)}
    right = {k: v if random.random() < 0.3 else value(4) for k, v in left.items() if k != "n3"} | {"new": {"a": 1}}
    text = lambda docs, indent: [(k, json.dumps(v, ensure_ascii=False, indent=indent)) for k, v in docs.items()]
    frame = lambda rows: spark.createDataFrame(rows, "name string, content string")
    one, other = text(left, 1) + [("bad", "{"), ("none", None), ("same", "[1, 2.50]")], text(right, None) + [("bad", "{}"), ("none", "1"), ("same", "[1.0,2.5]")]
    got = {(r.name, r.path): (r.change, r.before and json.loads(r.before), r.after and json.loads(r.after)) for r in links.json_changes(frame(one), frame(other)).collect()}
    want = {}
    for name in left.keys() & right.keys():
        a, b = dict(flat(left[name])), dict(flat(right[name]))
        for path in a.keys() | b.keys():
            if path not in b:
                want[name, path] = ("removed", a[path], None)
            elif path not in a:
                want[name, path] = ("added", None, b[path])
            elif a[path] != b[path] or type(a[path]) is not type(b[path]):
                want[name, path] = ("changed", a[path], b[path])
    assert got == want and len({c for c, *_ in want.values()}) == 3
    assert links.json_changes(frame([]), frame(one)).count() == 0


@pytest.mark.parametrize("keep", ["first", "last"])
def test_one_guest_may_have_most_rows(spark, keep):
    random.seed(9)
    rows = [(i, random.choice(["hot"] * 8 + ["cold", None, "x"]), random.choice(["2023-01", "2023-02", "2023-04", "2023-05", None]), random.choice(["A", "a ", "b", None])) for i in range(600)]
    df = spark.createDataFrame(rows, "i int, user string, month string, said string").repartition(7)
    got = sorted(r.i for r in reviews.near_duplicates(df, "user", "said", "month", ("i",), keep=keep).collect())
    kept = []
    first = lambda m: datetime.date(int(m[:4]), int(m[5:]), 1)
    for user in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == user and r[2]), key=lambda r: (r[2], r[0]))
        for k, r in enumerate(own):
            near = own[k - 1] if keep == "first" and k else own[k + 1] if keep == "last" and k + 1 < len(own) else None
            same = near and user and r[3] and near[3] and r[3].strip().lower() == near[3].strip().lower() and abs((first(r[2]) - first(near[2])).days) <= 30
            kept += [] if same else [r[0]]
    assert got == sorted(kept)
    parts = df.rdd.getNumPartitions()
    assert parts == 7 and reviews.near_duplicates(df.limit(0), "user", "said", "month", ("i",), keep=keep).count() == 0


def test_bigrams_of_long_texts(spark):
    import time

    words = [f"w{i % 50}" for i in range(60_000)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, "one")], "i int, t string")
    begun = time.time()
    top = bigram_frequency(df, "t", 3).collect()
    assert [(r.term, r.n) for r in top] == [("w0 w1", 1200), ("w1 w2", 1200), ("w10 w11", 1200)] and time.time() - begun < 60


def test_digest_of_lattice_query_on_handmade_texts(spark, tmp_path):
    spark.createDataFrame([(1, "khách sạn " * 40), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{DATA}/orders.parquet").limit(0).write.parquet(f"{tmp_path}/orders.parquet")
    rows = {r.doc_id: r for r in text_queries.QUERIES["segment_lattice"](spark, str(tmp_path)).collect()}
    assert rows[2].pieces == 0 and rows[2].digest == hashlib.md5(b"").hexdigest() and rows[1].pieces == 80  # two words of half the text each are no term


@pytest.mark.parametrize("tracked", [64, 4096])
def test_frequent_terms_are_proven_or_counted(spark, tracked):
    import collections

    from staylens.operators import stats

    random.seed(2)
    words = [f"t{int(random.paretovariate(0.7)) % 5000}" for _ in range(20_000)] + ["even", "odd"] * 900
    df = spark.createDataFrame([(words[i : i + 50],) for i in range(0, len(words), 50)] + [(None,), ([],)], "w array<string>").repartition(5)
    want = sorted(collections.Counter(words).items(), key=lambda x: (-x[1], x[0]))
    for k in (1, 5, 40, 9000):
        assert sorted(map(tuple, stats.frequent_terms(df, F.col("w"), k, tracked).collect()), key=lambda x: (-x[1], x[0])) == want[:k]
    assert stats.frequent_terms(df.limit(0), F.col("w"), 3, tracked).count() == 0


def test_lattice_takes_bounded_pieces_of_a_batch(spark, monkeypatch):
    import pyarrow as pa
    from pyspark.sql import functions as F

    texts = ["khách sạn, rất_đẹp! 9٣ 😀x e\u0301 ऀक\u00a0Ⅷ a\x1cb\tc", "", None, "một " * 60, "\u200b\ud7ff\ue000\U0010ffff x²½_"] + [f"nhà {i} ở, gần biển" for i in range(40)]
    kind_of = segmentation.kinds(spark)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")
    found = df.select("i", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(segmentation.TOKEN), F.lit(0)).alias("t")).collect()
    want = [r.t for r in sorted(found)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    assert segmentation.token_lists(batch.column("text"), kind_of).to_pylist() == want
    sizes, coded = [], segmentation.coded
    monkeypatch.setattr(segmentation, "coded", lambda rows: sizes.append(len(rows.flatten())) or coded(rows))
    m = segmentation.model({"nhà": 1, "gần biển": 1})
    whole = [b.column("out").to_pylist() for b in segmentation._segmented_batches([batch], "text", "out", m, kind_of)]
    counts = [x for b in segmentation._counted_texts([batch], 3, kind_of) for x in b.to_pylist()]
    sizes.clear()
    monkeypatch.setattr(segmentation, "PIECE", 100)
    monkeypatch.setattr(segmentation, "CHUNK", 100)
    pieces = [b.column("out").to_pylist() for b in segmentation._segmented_batches([batch], "text", "out", m, kind_of)]
    assert sum(pieces, []) == whole[0] and len(pieces) > 10 and max(sizes) == 60  # the longest text, alone
    sizes.clear()
    totals = {}
    for x in (x for b in segmentation._counted_texts([batch], 3, kind_of) for x in b.to_pylist()):
        totals[x["term"]] = totals.get(x["term"], 0) + x["n"]
    assert totals == {x["term"]: x["n"] for x in counts} and len(sizes) > 2 and max(sizes) < 200
