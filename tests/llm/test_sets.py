"""Term counts, packing and leaked passages against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.llm import leakage, packing, termcount


def test_term_counts(spark):
    rng = random.Random(5)
    rows = [(f"f{rng.randint(0, 30)}", rng.choice(["热", None, *[f"w{k}" for k in range(300)]]) if rng.random() < 0.6 else "热", rng.choice([None, 1, 5])) for _ in range(3000)]
    rows += [(None, "热", 3), ("f1", "", 2)]
    df = spark.createDataFrame(rows, "file string, word string, freq long").withColumn("term", F.lit(1))
    once: dict = {}
    for f, w, n in rows:
        if w is not None:
            once[f, w] = max(once.get((f, w), 0), n or 0)
    files = {f for f, _ in once if f is not None}
    got = {r["term"]: r for r in termcount.term_marks(df).collect()}
    assert set(got) == {w for _, w in once}
    total, records, entries = Counter(), Counter(), Counter()
    for (f, w), n in once.items():
        total[w] += n
        records[w] += f is not None
        entries[w] += 1
    for w, r in got.items():
        assert (r["total_freq"], r["n_records"], r["n_entries"]) == (total[w], records[w], entries[w])
        assert r["rare"] == (total[w] < 5) and r["common"] == (records[w] > 0.3 * len(files))
    assert termcount.term_marks(df.limit(0)).count() == 0


def test_dictionary_has_no_gaps(spark):
    df = spark.createDataFrame([(f"w{k % 700}",) for k in range(2000)] + [(None,)], "term string")
    assert sorted(r["term_id"] for r in termcount.global_dictionary(df).collect()) == list(range(700))


@settings(max_examples=60, deadline=None)
@given(st.text(min_size=0, max_size=300), st.integers(8, 60))
def test_pieces_cover_the_bytes(text, capacity):
    data = text.encode("utf-8", "ignore")
    pieces = packing.byte_pieces(data, capacity)
    assert sum(n for _, n in pieces) == len(data) + 1 and all(n <= capacity for _, n in pieces)
    for a, n in pieces:
        data[a : a + n].decode()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 64), st.integers(0, 64)), max_size=80), st.integers(1, 6))
def test_packing_keeps_every_limit(items, segments):
    tokens = np.array([t for t, _ in items], np.int64)
    loss = np.minimum(np.array([x for _, x in items], np.int64), tokens) if items else np.array([], np.int64)
    limit = 50 if (loss <= 50).all() else 64
    bins = packing.pack(tokens, loss, 64, segments, limit)
    assert (bins >= 0).all()
    for b in set(bins):
        assert tokens[bins == b].sum() <= 64 and (bins == b).sum() <= segments and loss[bins == b].sum() <= limit


def test_packing_ends_and_looks_below_the_largest_loss():
    with pytest.raises(ValueError):
        packing.pack(np.array([300, 10]), np.array([200, 5]), 4096, 64, 100)
    bins = packing.pack(np.array([100, 100, 100]), np.array([60, 60, 10]), 4096, 64, 100)
    assert bins.max() == 1 and sorted(np.bincount(bins)) == [1, 2] and (bins == bins[2]).sum() == 2


@settings(max_examples=40, deadline=None)
@given(st.text(min_size=0, max_size=200), st.integers(0, 50), st.integers(8, 40))
def test_pieces_keep_the_loss_limit(text, prompt, max_loss):
    data = text.encode("utf-8", "ignore")
    pieces = packing.byte_pieces(data, 64, prompt, max_loss)
    assert sum(n for _, n in pieces) == len(data) + 1
    for a, n in pieces:
        assert n <= 64 and n - max(0, min(prompt - a, n)) <= max_loss
        data[a : a + n].decode()


def test_packing_is_tight():
    rng = np.random.default_rng(1)
    tokens = rng.integers(100, 2500, 4000)
    bins = packing.pack(tokens, tokens, 4096, 64, 4096)
    assert tokens.sum() / ((bins.max() + 1) * 4096) > 0.99


def test_packed_documents(spark):
    docs = [(1, "题\n" + "甲" * 4000, "题"), (2, "x" * 4095, None), (3, "x" * 4096, None), (4, "", ""), (5, None, "t"), (None, "abc", None), (2, "x" * 4095, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, title string").withColumn("tokens", F.lit(0))
    out = packing.pack_documents(df).collect()
    assert sum(r["tokens"] for r in out) == sum(len(t.encode()) + 1 for _, t, _ in docs if t is not None)
    assert {r["doc_id"] for r in packing.split_documents(df).collect()} == {1, 3}
    first = next(r for r in out if r["doc_id"] == 1 and r["piece_no"] == 0)
    assert first["tokens"] - first["loss_tokens"] == 4
    assert packing.pack_documents(df.limit(0)).count() == 0


def test_split_documents_come_from_the_containers(spark):
    docs = [(1, "甲" * 3000, None), (1, "甲" * 3000, None), (2, "x" * 4095, None), (3, None, None), (None, "x" * 9000, "x")]
    out = packing.split_documents(spark.createDataFrame(docs, "doc_id long, text string, title string"))
    assert "FlatMapGroupsInPandas" in out._jdf.queryExecution().toString()  # packed, not only measured
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == [1, 1, None]


def _common(a: str, b: str) -> int:
    best, row = 0, [0] * (len(b) + 1)
    for ch in a:
        new = [0]
        for j, other in enumerate(b):
            new.append(row[j] + 1 if ch == other else 0)
        best, row = max(best, *new), new
    return best


def test_leaks_against_brute_force(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdef") for _ in range(n))
    items = [(k, word(120)) for k in range(6)] + [(6, None), (None, word(80)), (7, "ab"), (1, word(60))]
    docs = []
    for k in range(60):
        text = word(rng.randint(0, 150))
        if k % 2:
            source = rng.choice(items[:6])[1]
            a = rng.randint(0, 60)
            part = source[a : a + rng.randint(44, 60)].upper()
            text = text[:40] + " ".join([part[:20], part[20:]]) + "，！" + text[40:]
        docs.append((k, text))
    docs += [(100, None), (None, items[0][1]), (101, ""), (3, docs[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1))
    ev = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = {
        (d, i) for d, t in docs for i, e in items
        if None not in (d, t, i, e) and _common(leakage.skeleton(t), leakage.skeleton(e)) >= 50
    }
    got = [(r["doc_id"], r["item_id"]) for r in leakage.leaked_runs(df, ev).collect()]
    assert set(got) == want and len(got) == len(set(got)) and want
    clean = leakage.remove_leaks(df, ev)
    assert leakage.leaked_runs(clean, ev).count() == 0 and clean.count() == len(docs)
    assert leakage.leaked_runs(df, ev.limit(0)).count() == 0


WIDE = "ｶﾞﾗｽﾉﾊﾟﾈﾙｦﾊﾞﾗﾊﾞﾗﾆｼﾃｶﾞﾗﾝﾄﾞｳﾆｵｲﾀ" * 3
MARKED = "e\u0301te\u0301 a\u0300 la fore\u0302t de\u0301serte pre\u0300s du cha\u0302teau ou\u0300 il e\u0301tait ne\u0301 " * 2


@pytest.mark.parametrize("passage", [WIDE, MARKED, "Strasse İstanbul ΟΔΟΣ " * 6])
def test_runs_are_removed_in_any_form(passage):
    items = [(1, leakage.skeleton(passage))]
    grams = leakage._grams(items, 50)
    for text in (passage, f"甲{passage}乙", f"before, {passage.upper()} after"):
        assert leakage.find_runs(leakage.skeleton(text), items, grams, 50)
        clean = leakage.remove_runs(text, items, grams, 50)
        assert not leakage.find_runs(leakage.skeleton(clean), items, grams, 50) and len(clean) < len(text) / 2 + 20


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from("abΣςİﬁｶﾞﾊﾟe\u0301\u0323각각①ⅣＡ９，. "), max_size=30))
def test_mapped_skeleton_is_the_skeleton(text):
    s, where = leakage.mapped_skeleton(text)
    assert s == leakage.skeleton(text) and len(where) == len(s)


def test_block_sums_are_handed_on_at_a_bound(monkeypatch):
    monkeypatch.setattr(termcount, "HELD", 2)
    ids = np.arange(0, 10 * termcount.BLOCK, 1000)
    import pandas as pd

    parts = list(termcount._accumulate(iter([pd.DataFrame({"term_id": np.tile(ids, 2), "freq": 1, "in_record": 1})])))
    assert sum(int(x) for p in parts for x in p["occ"].iloc[0]) == 2 * len(ids)


@pytest.mark.parametrize("text,want", [("Ａ-b Ｃ９。é", "abc9é"), ("", ""), ("…！", "")])
def test_skeleton(text, want):
    assert leakage.skeleton(text) == want
