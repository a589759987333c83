"""Work that grows with the distinct, the needed and the files, not with what is repeated."""

import random
import re

import pytest
from pyspark.sql import functions as F

from staylens.functions import language as L
from staylens.functions import lexicons
from staylens.functions import text as T
from staylens.plans import cleaning


def test_every_text_is_cleaned_once(spark, monkeypatch):
    said = ["phòng rất rất sạch sẽ, nhân viên được khen, ks gần biển", "the room was wonderful and clean", None, "", "phòng sạch sẽ, nhân viên thân thiện, rất đẹp"]
    rows = [(i, f"guest {i}", said[i % 5], "Vietnam" if i % 3 else None, f"2024-{1 + i % 12:02}", 9.0) for i in range(300)]
    df = spark.createDataFrame(rows, "i long, review_name string, positive_comment string, country string, month_year string, score double")
    cleaned, seen = cleaning.cleaned_texts, []

    def once(texts, *more):
        seen.append(texts.count())
        return cleaned(texts, *more)

    monkeypatch.setattr(cleaning, "cleaned_texts", once)
    out = cleaning.clean(df, ("i",), lexicon=("nhân viên",)).collect()
    assert seen == [10]  # five texts, with and without a country
    assert len(out) == 120 and sorted(r.stt for r in out) == list(range(1, 121))
    assert {r.word_segmented for r in out if r.i % 5 == 0} == {"phòng rất sạch sẽ nhân_viên tốt khen khách sạn gần biển"}


def test_a_table_in_one_row_group_is_dealt(spark, tmp_path):
    from staylens.sources.spread import spread

    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    sizes = [len(p) for p in spread(spark.read.option("maxPartitionBytes", 100).parquet(str(tmp_path / "t"))).rdd.glom().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 200


def plain_mapping(text: str) -> str:
    """apply_mapping() by a list of all keys, the longest first."""
    keys = sorted(lexicons.ABBREVIATIONS, key=len, reverse=True)
    pattern = r"(?i)\b(?:" + "|".join(map(re.escape, keys)) + r")\b"
    values = {k.lower(): v for k, v in lexicons.ABBREVIATIONS.items()}

    def cased(m):
        hit, word = m[0], values.get(m[0].lower(), m[0])
        if hit.upper() == hit and hit.lower() != hit:
            return word.upper()
        return word[0].upper() + word[1:].lower() if hit[0].upper() == hit[0] and hit[0].lower() != hit[0] else word

    return re.sub(pattern, cased, text), len(re.findall(pattern, text))


def test_keys_by_their_letters_equal_keys_one_by_one(spark):
    r = random.Random(5)
    keys = list(lexicons.ABBREVIATIONS)
    pieces = keys + [k.upper() for k in keys[:40]] + [k.capitalize() for k in keys[40:90]] + [k[:-1] for k in keys if len(k) > 2] + ["x", "đẹp", "-", "\x01", "_", "5", "*"]
    texts = ["".join(r.choice(pieces) + r.choice([" ", " ", " ", "", "-", ", "]) for _ in range(30)) for _ in range(400)]
    assert T.mapping_pattern(lexicons.ABBREVIATIONS).count("|") < 400 and len(T.mapping_pattern(lexicons.ABBREVIATIONS)) < 2500
    df = spark.createDataFrame([(t,) for t in texts], "x string").select("x", T.apply_mapping(F.col("x")).alias("y"), T.count_replacements(F.col("x")).alias("n"))
    assert [(r.y, r.n) for r in df.collect()] == [plain_mapping(t) for t in texts]


def test_words_are_looked_for_once_a_text(spark):
    words = ("ab", "b c", "cd", "é", "d  e")
    texts = ["ab ab ab", "a b c", "abcd cd\ncd é", "d  e d e", "", "xaby b\tc"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = df.select(L.word_hits(F.col("x"), words).alias("a"), L.listed_hits(F.col("x"), L.vocabulary(F.col("x")), words).alias("b"), F.length(L.vocabulary(F.col("x"))).alias("n"))
    assert all(r.a == r.b for r in got.collect()) and got.first().n == 2


def test_tables_of_several_sheets_are_whole(spark, tmp_path, monkeypatch):
    import functools

    import duckdb

    from staylens.plans import source_queries
    from staylens.sources import workbooks

    data, con = "/root/testdata/sf0.001", duckdb.connect()
    for name in "region nation customer supplier part orders lineitem".split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data}/{name}.parquet')")
    monkeypatch.setattr(workbooks, "write_workbooks", functools.partial(workbooks.write_workbooks, sheet_rows=50))
    got = source_queries.province_workbooks(spark, data).collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(source_queries.ORACLES["province_workbooks"]).fetchall())
    df = spark.createDataFrame([(i,) for i in range(9)], "i int")
    workbooks.write_workbooks({"a \"&' b": df, "z (2)": df}, str(tmp_path / "w"), {"a \"&' b": ("i",), "z (2)": ("i",)}, sheet_rows=4)
    assert {(r.sheet, r.place) for r in workbooks.read_workbooks(spark, str(tmp_path / "w"), joined=True).collect()} == {("a \"&' b", 0), ("z (2)", 3)}


def test_files_and_pages_are_the_work_of_many_tasks(spark):
    from staylens.plans import source_queries as S

    assert S.hotel_pages(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 4
    S.unreadable_files(spark, "/root/testdata/sf0.001")
    base = max((p for p in spark_folder(spark).glob("documents-*")), key=lambda p: p.stat().st_mtime)
    seen = {p.name[:10] for p in base.glob("part-*")}
    assert len(seen) >= 4  # part-00000, part-00001, ...


def spark_folder(spark):
    from pathlib import Path

    return Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))


def test_csv_is_cut_into_files(spark, tmp_path):
    from staylens import sinks
    from staylens.sources import files

    df = spark.range(10, numPartitions=1).selectExpr("'a\nb \"' || id AS hotel_name", "cast(id AS double) AS score")
    sinks.write_csv(df, str(tmp_path / "c"), most=3)
    assert len(list((tmp_path / "c").glob("part-*"))) == 4 and sinks.CSV_ROWS <= 1_000_000
    assert sorted(r.hotel_name for r in files.read_reviews_csv(spark, str(tmp_path / "c")).collect()) == sorted(f'a\nb "{i}' for i in range(10))


def test_grams_are_counted_by_batch(spark):
    import pyarrow as pa

    from staylens.operators import profiles as P

    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b", "a"]), pa.array([" xyxyxyx ", "  ", " xy𝒳 "])], names=["lang", "letters"])
    got = {(r["lang"], r["gram"]): r["n"] for b in P._counted([batch]) for r in b.to_pylist()}
    assert got == {("a", " xy"): 2, ("a", "xyx"): 3, ("a", "yxy"): 2, ("a", "yx "): 1, ("a", "xy𝒳"): 1, ("a", "y𝒳 "): 1}


def test_equal_documents_are_not_taken_apart(spark, monkeypatch):
    from staylens.operators import links

    frame = lambda n: spark.createDataFrame([(f"d{i}", f'{{"b": {i}, "a": [1, {n if i == 7 else 0}]}}') for i in range(50)], "name string, content string")
    leaves, seen = links.json_leaves, []

    def taken(documents):
        seen.append(documents.count())
        return leaves(documents)

    monkeypatch.setattr(links, "json_leaves", taken)
    assert [(r.name, r.path, r.before, r.after) for r in links.json_changes(frame(3), frame(4)).collect()] == [("d7", "$.a[1]", "3", "4")] and seen == [1, 1]


def test_runs_side_by_side_take_the_cheapest_path(spark, monkeypatch):
    import pyarrow as pa

    from staylens.operators import segmentation as G

    def plain(found, m):
        out, at = [], 0
        is_word = [t[0] == "_" or t[0].isalnum() for t in found]
        while at < len(found):
            end = at + 1
            while is_word[at] and end < len(found) and is_word[end]:
                end += 1
            for size in G.best_path([t.lower() for t in found[at:end]], m.costs, 4, m.unknown) if is_word[at] else [1]:
                out.append("_".join(found[at : at + size]))
                at += size
        return " ".join(out)

    r = random.Random(3)
    words = ["a", "B", "c", "đ", "_", "9"]
    m = G.model({w: r.randrange(9) for w in "abcđ"} | {" ".join(r.choices("abcđ", k=k)): r.randrange(14) for k in (2, 3, 4) for _ in range(12)})
    rows = [[r.choice(words + [".", "😀"] * (i % 2)) for _ in range(r.randrange(40))] for i in range(300)] + [[], ["."], ["a"] * 50]
    for longest in (1_000, 10):  # above it, one run after the other
        monkeypatch.setattr(G, "LONG_RUN", longest)
        for part in (rows, rows[:1], [[]]):
            assert G.segmented(pa.array(part, pa.list_(pa.string())), m).to_pylist() == [plain(t, m) for t in part]
    # Terms are counted by chunk: a row for each term of a chunk, not for each occurrence.
    batch = pa.RecordBatch.from_arrays([pa.array([["a", "b", ".", "a", "b", "a"], [], ["b", "a", "b"]])], names=["tokens"])
    got = sorted((x["term"], x["words"], x["n"]) for b in G._counted([batch, batch], 3) for x in b.to_pylist())
    assert got == [("a", 1, 8), ("a b", 2, 6), ("a b a", 3, 2), ("b", 1, 8), ("b a", 2, 4), ("b a b", 3, 2)]


def test_chains_on_one_diagonal_are_told_without_a_search():
    import numpy as np

    from staylens.llm import chaining as C
    from staylens.llm import substring_dedup as S

    r = random.Random(11)
    seen = 0
    for _ in range(400):
        at, points = r.randrange(50), []
        for _ in range(r.randrange(1, 12)):
            at += r.choice([1, 6, 20, 39, 40, 41] if r.random() < 0.3 else [1, 6, 12])
            points.append((at, at + 7 + (r.random() < 0.03)))
        points += points[:2]
        r.shuffle(points)
        x, y, group = S._sorted_anchors(*(np.array(v, np.int32) for v in zip(*points, strict=True)), np.zeros(len(points), np.int64))
        if S._single_chains(x, y, group, 1)[0]:
            seen += 1
            assert C.chains(points) == [list(zip(x.tolist(), y.tolist(), strict=True))]
    assert 100 < seen < 400


def test_short_extensions_equal_long_ones(monkeypatch):
    import numpy as np

    from staylens.llm import chaining as C

    r = random.Random(12)
    for _ in range(300):
        a = [r.randrange(3) for _ in range(r.randrange(90))]
        b = [v for v in a if r.random() < 0.95] if r.random() < 0.8 else [r.randrange(3) for _ in range(30)]
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        monkeypatch.setattr(C, "SHORT", 256)
        got = C._extend(a, b), C._extend(b, a)
        monkeypatch.setattr(C, "SHORT", -1)
        assert got == (C._extend(a, b), C._extend(b, a))


def test_hits_and_their_number_come_from_one_search(spark):
    texts = ["ks ko tốt", "KS \x01 ko\x01 Ks", "", None, "xks ks_ ks5 5*x 5* 5*", "nhân viên Nhân Viên, of the"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    both = df.select("x", T.replaced(F.col("x")).alias("r"), T.apply_mapping(F.col("x")).alias("y"), T.count_replacements(F.col("x")).alias("n")).collect()
    assert [(r.r.text, r.r.n) for r in both] == [(r.y, r.n) for r in both] == [plain_mapping(r.x) if r.x is not None else (None, 0) for r in both]
    told = df.select(T.segmented(F.col("x"), ("nhân viên", "of the")).alias("r")).collect()
    assert (told[5].r.text, told[5].r.n) == ("nhân_viên Nhân_viên, of_the", 3) and (told[3].r.text, told[3].r.n) == (None, 0)
    pattern = T.mapping_pattern({"ks": "", "of the": ""})
    assert T.BOUNDARY not in pattern and T.mapping_pattern({"5*": "", "ks": ""}).endswith(T.BOUNDARY)
    plan = df.select(T.replaced(F.col("x")).alias("r"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1


def test_marked_words_are_looked_for_among_the_marks_first(spark):
    r = random.Random(8)
    words = ("phòng", "đẹp", "é à", "éx à", "ok", "a b", "été", "😀")
    texts = ["".join(r.choice(["ph", "òng", "đ", "ẹ", "p", "é", " ", "à", "x", "ok", "a b", "t", "phòng", "😀"]) for _ in range(r.randrange(25))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    x = F.col("x")
    got = df.select(L.word_hits(x, words).alias("a"), L.listed_hits(x, L.vocabulary(x), words, L.beyond_ascii(x)).alias("b")).collect()
    assert all(g.a == g.b for g in got) and sum(g.a for g in got) > 400
    for most in (1, 2, 4):  # enough hits end the search
        got = df.select(L.word_hits(x, words).alias("a"), L.listed_hits(x, L.vocabulary(x), words, L.beyond_ascii(x), most).alias("b"), L.word_hits(x, words, most).alias("c")).collect()
        assert all(min(g.a, most) == min(g.b, most) == g.c for g in got)
