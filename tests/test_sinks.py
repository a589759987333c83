import pytest
from staylens import sinks
from staylens.sources import files
from staylens.streaming import windows


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([("Huế", 9.0, True, 'says "hi"\nthere'), ("Sapa", None, False, " ")], "province string, score double, is_vietnamese boolean, positive_comment string")
    sinks.write_csv(df, str(tmp_path / "csv"))
    back = files.read_reviews_csv(spark, str(tmp_path / "csv"))
    assert {(r.province, r.score, r.is_vietnamese) for r in back.collect()} == {("Huế", 9.0, True), ("Sapa", None, False)}
    sinks.write_sheets(sinks.province_report(df), str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report" / "Top_Provinces")).count() == 2
    assert sinks.processing_report(df.limit(0)).first().kept_percent is None and sinks.processing_report(df).first().kept_percent == 50
    sinks.write_learning_text(df, "positive_comment", "score", str(tmp_path / "dl"))
    assert [r.value for r in spark.read.text(str(tmp_path / "dl")).collect()] == ['9\tsays "hi" there']
    links = spark.createDataFrame([("a", "http://x/2"), ("a", "http://x/1"), ("b", "nothing")], "province string, url string")
    sinks.write_links(links, str(tmp_path / "links"))
    assert {(r.province, r.url) for r in files.read_links(spark, str(tmp_path / "links")).collect()} == {("province=a", "http://x/1"), ("province=a", "http://x/2")}


def test_requests(spark, tmp_path):
    (tmp_path / "requests.txt").write_text("# comment\nhttp://x | Huế|hue\nbroken|line\n")
    assert [tuple(r) for r in files.read_requests(spark, str(tmp_path / "requests.txt")).collect()] == [("http://x", "Huế", "hue")]


def test_stream_equals_batch(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(3).write.parquet(str(source))
    stream = windows.read_events(spark, str(source))
    windows.each_batch(stream, lambda b: b.filter("value > 0").select("event_id"), str(out), str(tmp_path / "c")).awaitTermination(60)
    want = spark.read.parquet(str(source)).filter("value > 0").count()
    assert spark.read.parquet(str(out)).count() == want
    counted = windows.hourly(windows.read_events(spark, str(source)))
    query = counted.writeStream.format("memory").queryName("hours").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert spark.sql("SELECT sum(n) FROM hours").first()[0] == spark.read.parquet(str(source)).count()


def test_workbooks_hold_every_sheet(spark, tmp_path):
    import zipfile

    from staylens.sources import sheets, workbooks

    rows = [(i % 3, i, "a<\"&'\x01 é\n" if i % 2 else None, 1.5) for i in range(25)]
    df = spark.createDataFrame(rows, "unit int, i int, `t.x` string, v double")
    one = {"Data": df, "Empty": df.filter("i < 0").select("i"), "Second & last": df.groupBy("unit").count()}
    workbooks.write_workbooks(one, str(tmp_path / "all"), {"Data": ("i",), "Empty": ("i",), "Second & last": ("unit",)})
    got = workbooks.read_workbooks(spark, str(tmp_path / "all" / "report.xlsx")).orderBy("place", "row").collect()
    assert [r.cells for r in got if r.sheet == "Data"] == [["unit", "i", "t.x", "v"]] + [[str(u), str(i), t and t.replace("\x01", ""), "1.5"] for u, i, t, _ in rows]
    assert [r.cells for r in got if r.sheet == "Empty"] == [["i"]] and [r.cells for r in got if r.place == 2] == [["unit", "count"], ["0", "9"], ["1", "8"], ["2", "8"]]
    assert sheets.read_sheet(spark, str(tmp_path / "all" / "report.xlsx"), "Second & last").count() == 3
    workbooks.write_workbooks({"Data": df}, str(tmp_path / "by"), {"Data": ("i",)}, by="unit", sheet_rows=4)
    found = workbooks.read_workbooks(spark, str(tmp_path / "by"))
    assert {r.sheet for r in found.filter("file = '0'").collect()} == {"Data", "Data (2)", "Data (3)"}
    assert sorted(int(r.cells[0]) for r in found.filter("row > 0").collect()) == list(range(25)) and found.rdd.getNumPartitions() == 9
    assert all(zipfile.ZipFile(p).testzip() is None for p in (tmp_path / "by").iterdir())
    assert [workbooks.letters(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_failed_and_repeated_runs_leave_each_url_once(spark, tmp_path):
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    from staylens.sources import run_log

    path = str(tmp_path / "log")
    urls = lambda *x: spark.createDataFrame([(u,) for u in x], "url string")
    run_log.append_run(urls("a", "b", None, "é\nx"), path, "one")
    with pytest.raises(PySparkException):
        run_log.append_run(spark.range(200).select(F.when(F.col("id") < 199, F.col("id").cast("string")).otherwise(F.raise_error(F.lit("lost"))).alias("url")), path, "two")
    assert run_log.read_log(spark, path).filter("run = 'two'").count() == 0
    run_log.append_run(urls("c"), path, "two")
    run_log.append_run(urls("c", "d"), path, "two")
    assert sorted(map(tuple, run_log.read_log(spark, path).collect())) == [("one", "a"), ("one", "b"), ("one", "é x"), ("two", "c"), ("two", "d")]
    assert sorted(p.name for p in (tmp_path / "log").iterdir()) == ["run=one", "run=two"]
    run_log.append_run(urls(), path, "one")
    assert run_log.read_log(spark, path).count() == 2 and run_log.read_log(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        run_log.append_run(urls("a"), path, "../up")


@pytest.mark.parametrize("variant", ["current", "older"])
def test_stream_of_events_ends_like_the_batch(spark, tmp_path, variant):
    import random

    from staylens.operators import links
    from staylens.streaming import reconciliation as S

    random.seed(4)
    events = [(f"p{i % 2}", f"u{random.randrange(12)}", random.choice([*S.KINDS, "other"])) for i in range(60)] + [(None, "u", "ok"), ("p", None, "listed")]
    schema = "province string, url string, kind string"
    for i in range(0, len(events), 16):  # batches, the last of them repeated
        spark.createDataFrame(events[i : i + 16], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    spark.conf.set(*S.STATE_STORE)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        S.changes(stream, variant).writeStream.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).format("parquet").start(f"{tmp_path}/out").awaitTermination()
    finally:
        spark.conf.unset(S.STATE_STORE[0])
    emitted = spark.read.parquet(f"{tmp_path}/out")
    flat = spark.createDataFrame(events, schema).filter("province IS NOT NULL AND url IS NOT NULL")
    part = lambda kind: flat.filter(f"kind = '{kind}'").select("province", "url")
    want = links.reconcile(part("listed"), part("ok"), part("error"), part("late"), variant).select("province", "url", "type")
    assert sorted(map(tuple, S.standing(emitted).collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, S.standing(emitted.unionByName(emitted)).collect())) == sorted(map(tuple, want.collect()))
    numbers = {}
    for r in sorted(emitted.collect()):
        assert r.number == numbers.get((r.province, r.url), 0) + 1
        numbers[r.province, r.url] = r.number
    assert len(emitted.collect()) < len(events) and max(numbers.values()) > 1
