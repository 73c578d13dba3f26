"""Word filters, lookups, routes and the word store."""

import pytest
from pyspark.sql import functions as F

from lexmill.functions import hits
from lexmill.operators import lexicon, wordfilter, wordstore


def _reason(spark, word):
    return spark.createDataFrame([(word,)], "word string").select(wordfilter.killed_by(F.col("word"))).first()[0]


@pytest.mark.parametrize(
    "word,reason",
    [
        ("很多", "is_stop_word"), ("每个", "is_stop_word"), ("吃的", "is_stop_word"), ("图中", "is_stop_word"), ("Chinese", "is_not_chinese_word"), ("[", "is_single_character"),
        ("   ", "is_not_chinese_word"), ("", "is_not_chinese_word"), ("天天", "is_AA"), ("年年", "is_AA"), ("千万", "is_number"), ("几个亿", "is_number"), ("一九三八", "is_number"),
        ("十三万二千五百三十五", "is_number"), ("知识", None),
    ],
)
def test_reasons(spark, word, reason):
    assert _reason(spark, word) == reason


def test_known_words_and_routes(spark):
    words = spark.createDataFrame([("知识",), ("新词",), ("冷词",), ("中",), (None,)], "word string")
    known = spark.createDataFrame([("知识",), ("知识",), (None,)], "word string")
    assert {r["word"] for r in wordfilter.keep(words, known).collect()} == {"新词", "冷词"}
    freqs = spark.createDataFrame([("新词", 9), ("知识", 2)], "word string, freq bigint")
    routes = {r["word"]: (r["freq"], r["route"]) for r in wordfilter.route(words.where("word IS NOT NULL"), freqs, 5).collect()}
    assert routes == {"知识": (2, "wait"), "新词": (9, "keep"), "冷词": (0, "remove"), "中": (None, "keep")}
    assert [r["word"] for r in wordfilter.above(words, freqs, 9).collect()] == []


def test_store(spark):
    writes = spark.createDataFrame([("a", 1, 1), ("b", 2, 2), ("a", 3, 3), (None, 4, 4), ("c", None, 5)], "word string, freq bigint, seq bigint")
    store = wordstore.upsert(writes)
    assert {tuple(r) for r in store.collect()} == {("a", 3, 3), ("b", 2, 2), ("c", None, 5)}
    gone = spark.createDataFrame([("a",)], "word string")
    assert {r["word"] for r in wordstore.delete(store, gone).collect()} == {"b", "c"}
    assert wordstore.upsert(writes.limit(0)).count() == 0


def test_resume(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "line_no int, word string")
    assert [r["line_no"] for r in wordstore.resume_after(rows, "a").orderBy("line_no").collect()] == [2, 3, 4]
    assert wordstore.resume_after(rows, "x").count() == 0


def test_hits(spark):
    page = lambda text, engine: spark.createDataFrame([(text,)], "p string").select(hits.hit_count(F.col("p"), engine)).first()[0]
    assert page("找到相关结果约1,234,567个", "baidu") == 1234567
    assert page("没有", "baidu") == 0
    assert page("未找到和您的关键词", "baidu_dict") == 0
    with pytest.raises(ValueError):
        hits.hit_count(F.lit(""), "other")


def test_shrink_lint_and_numbers(spark):
    rows = spark.createDataFrame(
        [(1, "中", ["zhong1:3"], 1), (2, "中国", ["zhong'guo"], 9000), (3, "中山", ["zhong'shan"], 10), (4, "山", ["shan"], None), (5, "国国", None, None), (6, None, None, 5)],
        "line_no int, word string, readings array<string>, freq bigint",
    )
    assert [r["line_no"] for r in lexicon.shrink(rows).orderBy("line_no").collect()] == [1, 2, 4]
    assert {tuple(r) for r in lexicon.lint(rows).collect()} == {("中", "zhong", "中国"), ("中", "zhong", "中山"), ("国", "guo", "中国")}
    ids = lexicon.assign_ids(rows).orderBy("id").collect()
    assert [r["id"] for r in ids] == [100, 101, 102, 103, 104, 105]
    assert ids[0]["readings"] == ["zhong:3"]
    assert lexicon.with_head(lexicon.assign_ids(rows)).count() == 6 + len(lexicon.HEAD)
    assert lexicon.assign_ids(rows.limit(0)).count() == 0
