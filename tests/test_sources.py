"""Readers of text formats, readings, orders, pages and streams."""

from pyspark.sql import functions as F

from lexmill.functions import fields, readings
from lexmill.operators import ordering, webreadings, wordstore
from lexmill.sources import sinks, text
from lexmill.streaming import tokens


def _lines(spark, *lines):
    return spark.createDataFrame([("f", k, line) for k, line in enumerate(lines)], "file string, line_no int, line string")


def test_files_and_lines(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.txt").write_text("一\n二\n", encoding="utf-8")
    (tmp_path / "y.txt").write_text("三", encoding="utf-8")
    rows = text.read_lines(spark, str(tmp_path), "*.txt").select("line_no", "line").collect()
    assert sorted(map(tuple, rows)) == [(0, "一"), (0, "三"), (1, "二")]
    (tmp_path / "long.log").write_text("".join(f"{k}行\n" for k in range(3000)), encoding="utf-8")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        long = text.read_lines(spark, str(tmp_path), "*.log")
        assert long.rdd.getNumPartitions() > 3 and sorted((r["line_no"], r["line"]) for r in long.collect()) == [(k, f"{k}行") for k in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    sinks.write_lines(_lines(spark, "b", "a"), F.col("line"), str(tmp_path / "out"), order=["line"])
    assert sorted(r["line"] for r in text.read_lines(spark, str(tmp_path / "out"), "*.txt").collect()) == ["a", "b"]


def test_formats(spark):
    lex = text.as_lexicon(_lines(spark, "中 zhong 12", "山", "", "国 guo kuo x"), with_freq=True).orderBy("line_no").collect()
    assert [(r["word"], list(r["readings"]), r["freq"]) for r in lex] == [("中", ["zhong"], 12), ("山", [], None), ("国", ["guo", "kuo"], None)]
    assert sorted(map(tuple, text.as_affixes(_lines(spark, "# c", "的 1", "最 0", "x 2", "")).collect())) == [("最", 0), ("的", 1)]
    assert [tuple(r) for r in text.as_strokes(_lines(spark, "一 1", "bad")).collect()] == [("一", 1)]
    assert text.as_unihan(_lines(spark, "U+4E2D\tkMandarin\tzhōng", "#", "x\ty\tz")).count() == 1
    assert {tuple(r) for r in text.as_ranks(_lines(spark, "甲 1", "乙", "甲")).collect()} == {("甲", 2), ("乙", 1)}
    two = spark.createDataFrame([("b", 0, "丙"), ("a", 0, "甲"), ("a", 1, "乙"), ("b", 1, "甲")], "file string, line_no int, line string")
    assert {tuple(r) for r in text.as_ranks(two).collect()} == {("甲", 3), ("乙", 1), ("丙", 2)}
    blocks = text.as_blocks(_lines(spark, "a X", "b\tY", "", "c Z", " ", "")).orderBy("block").collect()
    assert [[list(x) for x in r["rows"]] for r in blocks] == [[["a", "X"], ["b", "Y"]], [["c", "Z"]]]
    small = text.as_blocks(_lines(spark, "a X", "b\tY", "", "c Z", " ", ""), chunk=2).orderBy("block").collect()
    assert [(r["block"], r["rows"]) for r in small] == [(r["block"], r["rows"]) for r in blocks]
    assert text.read_options("; c\na=1\n b = 2\na=3\nno") == {"a": "1", "b": "2"}


def test_readings(spark):
    one = lambda f, s: spark.createDataFrame([(s,)], "s string").select(f(F.col("s"))).first()[0]
    for raw, want in {"lüe4": "lue", "lu:e": "lue", "lu:": "lv", "lu:4": "lu:4", "zhong1": "zhong", "a1:-3": "a:-3"}.items():
        assert one(readings.normalize_py, raw) == want
    assert one(readings.codepoint_to_chr, "U+20000") == "𠀀"
    assert one(readings.normalize_word_zhuyin, "lüè") == "lüe"
    assert one(readings.normalize_word_zhuyin, "nǚ") == "nv"
    # the final stands twice: only the last one loses its number
    assert one(readings.normalize_word_zhuyin, "hànhàn") == "han4han" and one(readings.normalize_word_zhuyin, "mama") == "ma5ma"
    assert one(readings.normalize_word_zhuyin, "bàba") == "bàba" and one(readings.normalize_word_zhuyin, "x") == "x"


def test_pages(spark):
    page = '<script language="JavaScript">spf("shan1");</script><script language="JavaScript">x</script>'
    pages = spark.createDataFrame([("山", page), ("水", None)], "word string, html string")
    assert {r["word"]: r["reading"] for r in webreadings.char_readings(pages).collect()} == {"山": "shan", "水": ""}
    tabs = '<span class="dicpy">a</span><DIV class="tab-page"><span class="dicpy"><b>háng</b>x</span><hr class="dichr"><span class="dicpy">no</span></DIV>'
    tabs += "<div class='tab-page'><span class=dicpy>xíng</span></div><span class=dicpy>no</span>"
    found = webreadings.page_readings(spark.createDataFrame([("行", tabs), ("无", None)], "word string, html string"))
    assert {r["word"]: list(r["readings"]) for r in found.collect()} == {"行": ["háng", "xíng"], "无": []}


def test_fields(spark):
    one = lambda f, s: list(spark.createDataFrame([(s,)], "s string").select(f(F.col("s"))).first()[0])
    assert one(fields.split_each, "a  b ") == ["a", "", "b", ""] and one(fields.split_runs, " a \t b ") == ["a", "b"]
    assert one(fields.split_csv, 'a, "b, ""c""",,d') == ["a", 'b, "c"', "", "d"] and one(fields.split_csv, "") == [""]


def test_store_on_disk(spark, tmp_path):
    path = str(tmp_path / "store")
    assert wordstore.open_store(spark, path).count() == 0
    wordstore.add(path, spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], wordstore.SCHEMA))
    wordstore.add(path, spark.createDataFrame([("a", 3, 3)], wordstore.SCHEMA))
    assert [tuple(r) for r in wordstore.items(wordstore.open_store(spark, path)).collect()] == [("b", 2), ("a", 3)]


def test_orders(spark):
    strokes = spark.createDataFrame([("一", 1), ("山", 3)], "ch string, strokes int")
    words = spark.createDataFrame([("山",), ("一山",), ("一",), ("x",), ("山",), (None,), ("",)], "word string")
    assert [r["word"] for r in ordering.stroke_keys(words, strokes).orderBy("key").collect()] == ["一", "一山", "山"]


def test_stream_counts(spark, tmp_path):
    src = tmp_path / "in"
    spark.sql("SELECT timestamp'2024-01-01 00:01:00' AS ts, '中国。中' AS line UNION ALL SELECT timestamp'2024-01-01 00:12:00', '中。'").write.parquet(str(src))
    stream = spark.readStream.schema("ts timestamp, line string").parquet(str(src))
    q = tokens.token_counts(stream).writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r["start"].minute, r["token"]): r["n"] for r in spark.table("counts").collect()} == {
        (0, "中"): 2, (0, "国"): 1, (0, "。"): 1, (10, "中"): 1, (10, "。"): 1,
    }
