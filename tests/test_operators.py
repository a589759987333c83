import json

from pyspark.sql import functions as F

from staylens.operators import audit as A
from staylens.operators import links as K
from staylens.operators import reviews as R
from staylens.operators import stats as S
from staylens.plans import cleaning
from staylens.sources import files, html


def test_near_duplicates(spark):
    rows = [(0, "u", "x", "2023-02"), (1, "u", "x ", "2023-03"), (2, "u", "X", "2023-04"), (3, "v", "x", "2023-01"), (4, None, "x", "2023-01"), (5, None, "x", "2023-01"), (6, "w", "x", "bad")]
    df = spark.createDataFrame(rows, "i int, u string, t string, m string")
    assert sorted(r.i for r in R.near_duplicates(df, "u", "t", "m", ("i",)).collect()) == [0, 2, 3, 4, 5]
    assert sorted(r.i for r in R.near_duplicates(df, "u", "t", "m", ("i",), keep="last").collect()) == [1, 2, 3, 4, 5]


def test_rows_are_numbered_without_gaps(spark):
    df = spark.range(0, 997).withColumn("k", F.col("id") * 7919 % 997)
    assert [r.id for r in R.number_rows(df, "k", name="n").orderBy("n").collect()] == [r.id for r in df.orderBy("k").collect()]


def test_stay_codes(spark):
    df = spark.createDataFrame([("2 đêm",), ("abc",), ("xyz",), (None,)], "s string")
    assert {r.label: r.id for r in R.stay_codes(df, "s").collect()} == {"2 đêm": 2, "Unknown": 3, "abc": 4, "xyz": 5}
    assert {r.label: r.id for r in R.stay_codes(df, "s", compat=True).collect()} == {"2 đêm": 2, "Unknown": 0, "abc": 2, "xyz": 4}


def test_rolling_mean_needs_all_three(spark):
    df = spark.createDataFrame([("2023-01", 1.0), ("2023-02", 2.0), ("2023-04", 3.0)], "month_year string, score double")
    rows = S.rolling_mean(S.monthly(df, mean=F.avg("score")), "mean").collect()
    assert len(rows) == 4 and all(r.rolling is None for r in rows)


def test_quantile_bins_join_equal_edges(spark):
    df = spark.createDataFrame([(x,) for x in [1] * 6 + [2, 3, 4, 5]], "x int")
    bins = {r.x: r.bin for r in S.quantile_bins(df, "x", 10).distinct().collect()}
    assert bins[1] == 0 and bins[5] == max(bins.values()) and len(set(bins.values())) == len(set(bins))


def test_top_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [r.k for r in S.top_frequency(df, "k", 2).collect()] == ["c", "a"]


def test_reconcile_all_states(spark):
    urls = [(f"{a}{b}{c}{d}", a, b, c, d) for a in (0, 1) for b in (0, 1) for c in (0, 1) for d in (0, 1)]
    part = lambda i: spark.createDataFrame([("p", u[0]) for u in urls if u[i]], "province string, url string")
    for variant in ("current", "older", "middle"):
        got = {r.url: r.type for r in K.reconcile(part(1), part(2), part(3), part(4), variant).collect()}
        for u, listed, ok, error, late in urls:
            missing = listed and not ok
            if variant == "current":
                want = "Error" if error else "Missing" if missing and not late else None
            else:
                want = "Timeout" if late and (error or missing) else "Error" if error else "Missing" if missing else None
            assert got.get(u) == want, (variant, u)


def test_audit_tolerance_and_maps(spark):
    base = {"name": "A", "evaluation_categories": {c: 8.0 for c in A.REQUIRED_CATEGORIES}, "reviews": {"k": {"reviewer": {"country": "Việt Nam"}, "review": {"comment_positive": "x"}}}}
    docs = [json.dumps(base | {"total_rating": t}) for t in ("21", "22")] + ["{", json.dumps(base | {"reviews": "not found"})]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, content string")
    rows = {r.i: (r.error, r.review_count, r.vn_positive) for r in A.audited(A.parsed(df)).collect()}
    assert rows == {0: (None, 1, 1), 1: ("total differs", 1, 1), 2: ("unreadable", 0, 0), 3: ("reviews", 0, 0)}


def test_hotels_from_files(spark, tmp_path):
    folder = tmp_path / "crawl" / "da_lat"
    folder.mkdir(parents=True)
    review = {"reviewer": {"name": "N", "country": "Việt Nam"}, "review": {"date": "15/10/2023", "rating": "Tốt", "score": 8.0, "comment_positive": "sạch", "room_type": ""}}
    (folder / "a.json").write_text(json.dumps({"name": "H", "rating": "8,7", "reviews": [review]}))
    (folder / "bad.json").write_text("{oops")
    good, bad = files.read_hotels(spark, str(tmp_path / "crawl"))
    row = files.flatten(good, str(tmp_path / "crawl")).first()
    assert (row.province, row.hotel_avg_score, row.month_year, row.combined_text, row.room_type) == ("Đà Lạt", 8.7, "2023-10", "Tốt sạch", "Không rõ")
    assert bad.count() == 1


def test_review_cards(spark):
    card = (
        '<div data-testid="review-card"><div data-testid="review-avatar"><img src="a.png"><div>Lan</div><div>Việt Nam</div></div>'
        '<ul data-testid="review-stay-info"><li>Phòng đôi</li><li>2 đêm</li><li>Cặp đôi</li></ul><span data-testid="review-date">x</span>'
        '<h4 data-testid="review-title">Tốt</h4><div data-testid="review-score"><div aria-hidden="true">9,0</div></div></div>'
        '<div data-testid="review-card"><p data-testid="review-title">no stay</p></div>'
    )
    pages = spark.createDataFrame([(1, f"<h2 data-testid='property-name'>Inn</h2>{card}"), (2, None)], "page_id int, html string")
    rows = {r.page_id: r.hotel for r in html.extract_hotels(pages).collect()}
    assert rows[1].name == "Inn" and len(rows[1].reviews) == 1 and rows[1].reviews[0].review.score == 9.0
    assert rows[1].reviews[0].reviewer.name == "Lan" and rows[1].reviews[0].review.stay_duration == "2 đêm" and rows[2].reviews == []


def test_cleaning_keeps_vietnamese(spark):
    rows = [(1, "u", "Việt Nam", "2023-01", 9.0, "phòng sạch đẹp và nhân viên thân thiện", None, None), (2, "u", "UK", "2023-01", 9.0, "very good clean room, near the beach", None, None), (3, "w", "Việt Nam", "2023-01", 2.0, "phòng sạch đẹp và nhân viên thân thiện", None, None)]
    df = spark.createDataFrame(rows, "i int, review_name string, country string, month_year string, score double, positive_comment string, rating string, negative_comment string")
    out = cleaning.clean(df, ("i",), lexicon=("nhân viên",)).collect()
    assert [(r.i, r.stt) for r in out] == [(1, 1)] and "nhân_viên" in out[0].word_segmented


def documents_at(path, spark, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_char_dominance_of_whole_texts(spark, tmp_path):
    from staylens.plans import registry

    texts = ["a short start " + "x" * 400, "-----, and then a text like any other", "ééééééé\U0001f600", "aaaa", "", None, "\U0001f600" * 9 + "ab"]
    rows = registry.queries()["char_dominance"](spark, documents_at(tmp_path, spark, texts)).collect()
    most = lambda t: max(map(t.count, t), default=0)
    assert {r.doc_id: r.dominated for r in rows} == {i: len(t or "") >= 5 and most(t) > 0.7 * len(t) for i, t in enumerate(texts)}
    assert [r.dominated for r in sorted(rows)][:2] == [True, False]


def test_segmentation_of_whole_texts(spark, tmp_path):
    import hashlib
    import re

    from staylens.plans import registry
    from staylens.plans.text_queries import TERMS

    texts = ["Dịch vụ tốt, vị trí đẹp. xdịch vụ", "bữa sáng BỮA SÁNG bữa  sáng", "word " * 3000 + "giá cả", "", None, "no term of the list"]
    one = "|".join(re.escape(w) for w in sorted(TERMS, key=len, reverse=True))

    def joined(m):
        hit = m.group()
        word = hit.lower().replace(" ", "_")
        return word.upper() if hit.isupper() else word.capitalize() if hit[0].isupper() else word

    want = {i: None if x is None else hashlib.md5(re.sub(rf"(?i)\b(?:{one})\b", joined, x).encode()).hexdigest() for i, x in enumerate(texts)}
    rows = registry.queries()["segment_words"](spark, documents_at(tmp_path, spark, texts)).collect()
    assert {r.doc_id: r.digest for r in rows} == want
    assert want[2] != hashlib.md5(texts[2].encode()).hexdigest()


def test_mapping_with_the_whole_table(spark, tmp_path):
    import hashlib
    import re

    from staylens.functions.lexicons import ABBREVIATIONS
    from staylens.plans import registry

    assert len(ABBREVIATIONS) == 255
    texts = ["Take care, KHACH SAN 5*a 5* check-in", "double voucher hehe review", "check in check-out wi-fi ô tô xanh sm not worth", "word " * 3000 + "sea view", "", None, "Near Beach sach se sach"]
    one = "|".join(re.escape(w) for w in sorted(ABBREVIATIONS, key=len, reverse=True))

    def written_out(m):
        hit, word = m.group(), ABBREVIATIONS[m.group().lower()]
        return word.upper() if hit.isupper() else word.capitalize() if hit[0].isupper() else word

    want = {}
    for i, x in enumerate(texts):
        done, n = (None, 0) if x is None else re.subn(rf"(?i)\b(?:{one})\b", written_out, x)
        want[i] = (done and hashlib.md5(done.encode()).hexdigest() if x else x if x is None else hashlib.md5(b"").hexdigest(), n)
    rows = registry.queries()["text_mapping"](spark, documents_at(tmp_path, spark, texts)).collect()
    assert {r.doc_id: (r.digest, r.n) for r in rows} == want
    assert want[1][1] == 4


def test_whole_cleaning_of_texts(spark, tmp_path):
    import hashlib
    import unicodedata

    from staylens.plans import registry

    texts = [
        "Phòng sạch đẹp \U0001f600\U0001f600, nv rất thân thiện và ks ở gần bãi biển!!!",
        unicodedata.normalize("NFD", "Được ở gần bãi biển, dịch vụ tốt và giá cả hợp lý"),
        "Gọi số 0912345678 để đặt phòng, nhân viên rất nhiệt tình và vui vẻ",
        "\U0001f600", "", None, "the room was very good and clean, near the beach",
        "ăn sáng rất rất ngon, vị trí tốt được ở gần bãi biển",
    ]
    cleaned = {
        0: ("phòng sạch sẽ đẹp nhân viên rất thân thiện và khách sạn ở gần bãi biển", "phòng sạch_sẽ đẹp nhân_viên rất thân_thiện và khách_sạn ở gần_bãi_biển"),
        1: ("tốt ở gần bãi biển dịch vụ tốt và giá cả hợp lý", "tốt ở gần_bãi_biển dịch_vụ tốt và giá_cả hợp_lý"),
        2: ("gọi số để đặt phòng nhân viên rất nhiệt tình và vui vẻ", "gọi số để đặt_phòng nhân_viên rất nhiệt tình và vui_vẻ"),
        7: ("ăn sáng rất ngon vị trí tốt ở gần bãi biển", "ăn sáng rất ngon vị_trí tốt ở gần_bãi_biển"),
    }
    rows = registry.queries()["full_pipeline"](spark, documents_at(tmp_path, spark, texts)).collect()
    digest = lambda x: hashlib.md5(x.encode()).hexdigest()
    assert {r.review_id: (r.digest, r.segmented) for r in rows} == {i: (digest(a), digest(b)) for i, (a, b) in cleaned.items()}


def test_sheets_are_read_without_other_libraries(spark, tmp_path):
    import zipfile

    from staylens.sources import sheets

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    link = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    rows = [
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>n</t></is></c><c r="C1" t="s"><v>1</v></c></row>',
        '<row r="2"><c r="A2" t="s"><v>2</v></c><c r="C2" t="b"><v>1</v></c><c r="AA2"><v>9</v></c></row>',
        '<row r="3"><c r="B3"><v>4.5</v></c></row>',
    ]
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook {main} {link}><sheets><sheet name="One" r:id="r1"/><sheet name="Hai" r:id="r2"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>tên</t></si><si><r><t>o</t></r><r><t>k</t></r></si><si><t>Huế</t></si></sst>")
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData>{"".join(rows)}</sheetData></worksheet>')
        book.writestr("xl/worksheets/sheet2.xml", f"<worksheet {main}><sheetData/></worksheet>")
    df = sheets.read_sheet(spark, str(tmp_path / "a.xlsx"))
    assert df.columns == ["tên", "n", "ok"] and [tuple(r) for r in df.collect()] == [("Huế", None, "True"), (None, "4.5", None)]
    assert sheets.read_sheet(spark, str(tmp_path / "a.xlsx"), "Hai").columns == []


def test_cleaning_carries_no_texts_up_to_the_language_filter(spark, monkeypatch):
    from staylens.plans import cleaning

    seen, found = [], cleaning.R.near_duplicates
    monkeypatch.setattr(cleaning.R, "near_duplicates", lambda df, *rest: seen.append(df.columns) or found(df, *rest))
    good = "Phòng rất sạch đẹp, được ở gần bãi biển và nhân viên thân thiện"
    rows = [(1, "a", "2024-01", good), (2, "a", "2024-01", f" {good.upper()} "), (3, "b", "2024-01", good), (4, "b", "2024-03", good), (5, "b", "2024-03", "the room was very good and clean, near the beach"), (6, "c", "2024-01", None), (7, None, "2024-01", good), (8, None, "2024-01", good)]
    df = spark.createDataFrame([(i, u, m, 9.0, "Vietnam", t) for i, u, m, t in rows], "review_id long, review_name string, month_year string, score double, country string, positive_comment string")
    funnel = cleaning.Funnel()
    out = cleaning.clean(df, ("review_id",), funnel=funnel)
    assert sorted((r.review_id, r.stt) for r in out.collect()) == [(1, 3), (3, 4), (4, 5), (7, 1), (8, 2)]
    assert {r.positive_comment for r in out.collect()} == {good.replace(",", "")} and {r.country for r in out.collect()} == {"Vietnam"}
    assert out.columns == [*df.columns, "normalized_text", "is_vietnamese_raw", "is_vietnamese", "money_text", "word_segmented", "stt"]
    assert [n for _, n in funnel.rows()] == [8, 8, 7, 7, 6, 5]
    assert seen and not {"positive_comment", "normalized_text", "money_text", "word_segmented"} & set(seen[0])
