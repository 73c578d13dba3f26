"""Sentences and tokens: the fixed cases, and the expressions against a state machine."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexmill.functions import chars
from lexmill.operators import corpus

CASES = {
    "hehe, 我爱北京天安门。": [["hehe", "我", "爱", "北", "京", "天", "安", "门", "。"]],
    "3.14中": [["314", "中"]],
    "中abc": [["中"]],
    "中abc def": [["中", "abc"]],
    "abc": [],
    "中！！！国": [["中", "！"], ["国"]],
    "中；国。": [["中", "；", "国", "。"]],
    "，，。中": [["中"]],
    "a,b 中": [["ab", "中"]],
    "中 国": [["中", "国"]],
    "中　国。": [["中", "　", "国", "。"]],
    "Ａ中…": [["Ａ", "中", "…"]],
    "": [],
}


def _sentences(spark, texts):
    rows = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "key long, line_no int, line string")
    out = {i: [] for i in range(len(texts))}
    for r in corpus.sentences(rows).orderBy("key", "sent_no").collect():
        out[r["key"]].append(list(r["tokens"]))
    return [out[i] for i in range(len(texts))]


def test_fixed_cases(spark):
    assert _sentences(spark, list(CASES)) == list(CASES.values())


def _machine(line):
    """Marks end a sentence, characters and punctuation are tokens, spaces part runs of others."""
    han = re.compile("[⺀-⿯㐀-䶿一-龻豈-龎\U00020000-\U0002a6df]")
    out, tokens, run = [], [], ""
    for ch in line:
        o = ord(ch)
        ascii_mark = 32 < o < 127 and not ch.isalnum()
        mark = ascii_mark or 0x2000 <= o <= 0x206F or 0x3000 <= o <= 0x303F or 0xFF00 <= o <= 0xFFEF or 0xFE30 <= o <= 0xFE4F
        if ch in chars.TERMINATORS:
            if tokens:
                out.append(tokens + ([run] if run else []) + [ch])
                tokens, run = [], ""
        elif mark or han.match(ch) or ch in " \t":
            if run:
                tokens.append(run)
            run = ""
            if ch not in " \t":
                tokens.append(ch)
        else:
            run += ch
    return out + [tokens] if tokens else out


def test_against_state_machine(spark):
    rng = random.Random(1)
    letters = "中国的ab3 \t.,!。！；-“é豈𠀀　"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    for text, got in zip(texts, _sentences(spark, texts)):
        assert got == _machine(text), text


def test_nulls_empty_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, 9), (2, "", 9), (None, "中。", 9), (2, "中。", 9), (2, "中。", 9)], "doc_id long, text string, line long")
    assert corpus.process(docs).count() == 3
    assert corpus.process(docs.limit(0)).count() == 0
    assert corpus.segmented_words(docs).count() == 0


def test_segmented_words_are_distinct_per_document(spark):
    docs = spark.createDataFrame([(1, "一/二//一\n无"), (2, "一/")], "doc_id long, text string")
    assert sorted(map(tuple, corpus.segmented_words(docs).collect())) == [(1, "一"), (1, "二"), (2, "一")]


@pytest.mark.parametrize("n,want", [(1, {"a": 2, "b": 1}), (2, {"a b": 1, "b a": 1}), (3, {"a b a": 1}), (4, {})])
def test_ngrams(spark, n, want):
    rows = spark.createDataFrame([(["a", "b", "a"],), ([],)], "tokens array<string>")
    assert {r["gram"]: r["n"] for r in corpus.ngrams(rows, n).collect()} == want
    both = corpus.ngrams(rows, n, 9).collect()
    assert {(r["gram"], r["order"]): r["n"] for r in both} == {(g, n): k for g, k in want.items()}


def test_strip_takes_spaces_of_any_script(spark):
    row = spark.createDataFrame([("　 中 国\xa0\t",)], "s string").select(chars.strip_line(F.col("s"))).first()
    assert row[0] == "中 国"
