import pytest
from pyspark.sql import functions as F

from staylens.functions import dates as D
from staylens.functions import language as L
from staylens.functions import money as M
from staylens.functions import text as T
from staylens.functions import urls as U


@pytest.fixture(scope="module")
def apply(spark):
    def run(kind, values, f):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
        return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]

    return run


CASES = [
    ("string", T.remove_emoji, {"Đã ở Deluxe Double 500k, 0912345678 - OK! 한국 酒店 ไทย tốt": "Đã ở eluxe ouble k   OK   ไทย tốt", None: ""}),
    ("string", lambda x: T.remove_emoji(x, compat=False), {"Deluxe 500k 😀 :)": "Deluxe 500k"}),
    ("string", T.collapse_chars, {"good coffee  500000 sạch sẽeee": "god cofe 50 sạch sẽe"}),
    ("string", T.collapse_words, {"rất RẤT rất tốt ok ok": "rất tốt ok", "Khách sạn KHÁCH SẠN đẹp": "Khách sạn KHÁCH SẠN đẹp"}),
    ("string", lambda x: D.month_year(x, compat=True), {"15/10/2023": "2023-01", "31/12/2024": "2024-03", "2024-10": "2024-02", "Tháng 10 2024": "2024-10"}),
    ("string", D.month_year, {"15/10/2023": "2023-10", "31/12/2024": "2024-12", "10/2024": "2024-10", "2024-10": "2024-10", "October 2024": "2024-10", "no": None}),
    ("string", D.vietnamese_date, {"Đánh giá ngày 5 tháng 1 2024": "05/01/2024", "ngày 15 tháng 10 2023": "15/10/2023", "x": None}),
    ("long", M.number_words, {105: "một trăm năm", 15: "mười năm", 21: "hai mươi mốt", 25: "hai mươi lăm", 1001: "một nghìn lẻ một", 0: "không", 500000: "năm trăm nghìn"}),
    ("string", M.money_words, {"500k": "năm trăm nghìn đồng", "1.5M": "một triệu năm trăm nghìn đồng", "0": "không đồng", "1,000,000": "", "giá 500k": "", "0912345678": ""}),
    ("string", M.remove_phones, {"lh 0912345678 nhé": "lh nhé", "090 123 4567": "", "+84901234567": "+", "0901 234 567": "0901 234 567"}),
    ("string", M.is_phone, {"+84 901-234-567": True, "0123456789": False, None: False}),
    ("string", T.apply_mapping, {"KS check-in Được a": "KHÁCH SẠN nhận phòng Tốt anh", "5*": "5*", "5*x": "5 saox", None: None}),
    ("string", lambda x: T.apply_mapping(x, {"sạch": "sạch sẽ", "ks": "khách sạn"}), {"ks sạch sẽ": "khách sạn sạch sẽ sẽ"}),
    ("long", T.label_count, {4500: "4.5K", 1234567: "1.23M", 12: "12"}),
    ("long", lambda x: T.label_count(x, compat=True), {4500: "4.50KK", 1234567: "1.23MM"}),
    ("string", T.is_empty, {None: True, "  ": True, "abcd": True, ".....": True, "abcde": False}),
    ("string", T.stay_duration, {"2 đêm · tháng 10 2023": "2 đêm", "hai đêm": "hai đêm", None: ""}),
    ("string", T.dominated_by_char, {"aaaaaAAAAaaaaaaa": True, "hahahahahahahaha": False, None: False}),
    ("long", U.range_bucket, {50: "0-50", 51: "51-100", 100: "51-100", 101: "101-200"}),
    ("long", lambda x: U.range_bucket(x, compat=True), {51: "1-100"}),
    ("string", U.page_key, {"https://x/vn/a-b.vi.html?x=1": "a_b.json", "https://x/a_c.html": "a_c.json"}),
    ("string", lambda x: U.page_key(x, compat=True), {"https://x/a-b.vi.html": "a_b.vi.json"}),
    ("string", U.folder_of, {"a\\b\\c.txt": "b", "x/y/z": "y"}),
    ("string", U.slug_title, {"da-nang_city": "Da Nang City"}),
    ("string", U.is_range_folder, {"1-100": True, "-": False, "a-1": False, "100": False}),
    ("string", T.has_repeats, {"ok ok": True, "aaaa": True, "aaa b": False, None: False}),
    ("string", lambda x: L.is_vietnamese_simple(x, F.lit("Vietnam")), {"đẹp lắm": True, "nice": False, "phòng rất đẹp và sạch": True}),
    (
        "string",
        L.language_rule,
        {
            "phòng sạch sẽ, nhân viên thân thiện, rất đẹp": 17,
            None: 1,
            "đẹp lắm": 1,
            "nhan vien thân thiet chân tình": 5,
            "the room is clean and the staff is nice and kind here to stay": 15,
            "Phong rat sach va nhan vien than thien": 24,
        },
    ),
]


@pytest.mark.parametrize("kind,f,cases", CASES)
def test_vectors(apply, kind, f, cases):
    assert apply(kind, list(cases), f) == list(cases.values())


def test_nfc_composes_only_where_needed(spark):
    df = spark.createDataFrame([(1, "café"), (2, "plain"), (3, None)], "i int, t string")
    assert {r.i: r.t for r in T.nfc(df, "t").collect()} == {1: "café", 2: "plain", 3: None}


def test_idempotent(apply):
    texts = ["aaa  bbb!! :) 한국", "ok OK ok tốt tốt", "", "x"]
    for f in (T.remove_emoji, T.collapse_chars, T.collapse_words):
        once = apply("string", texts, f)
        assert apply("string", once, f) == once
