"""Look-alikes, markup, page frames, sentences, encodings, cut texts: small cases and odd input."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexmill.llm import boilerplate, encoding, lookalike, markup, sentences, truncation

PLAIN = {
    "Ａｂｃ１２，": "Abc12，",
    "ｶﾞﾗｽﾉﾊﾟ": "ガラスノパ",
    "⽔⻋更": "水车更",
    "e\u0301te\u0301 n\u0303": "été ñ",
    "か\u3099": "が",
    "a\u200bb\u00adc\ufeff": "abc",
    "a\u00a0b\u2003c": "a b c",
    "сlоck": "clock",
    "кapтa": "карта",
    "ロ音": "口音",
    "师ニ星": "师二星",
    "白ヶ原のキロ": "白ヶ原のキロ",
    "❤\ufe0f 👨\u200d👩\u200d👧": "❤\ufe0f 👨\u200d👩\u200d👧",
    "α = 3° (км)": "α = 3° (км)",
    "": "",
}


@pytest.fixture(scope="module")
def rewriter():
    return lookalike.Rewriter(lookalike.representatives({}), {"Latin": 2, "Cyrillic": 1})


@pytest.mark.parametrize("raw,plain", PLAIN.items())
def test_plain_forms(rewriter, raw, plain):
    assert rewriter.plain(raw) == plain
    assert rewriter.plain(plain) == plain


def test_patterns_are_looked_for_only_where_they_can_stand(rewriter, monkeypatch):
    class Watched:
        def __init__(self, automaton):
            self.automaton, self.given = automaton, []

        def iter_long(self, text):
            self.given.append(text)
            return self.automaton.iter_long(text)

    long = "今天下雨，明天放晴。" * 50
    text = f"{long}e\u0301t{long}ｶﾞ{long}❤\ufe0f{long}Ａ"
    watched = Watched(rewriter.automaton)
    monkeypatch.setattr(rewriter, "automaton", watched)
    assert rewriter.plain(text) == f"{long}ét{long}ガ{long}❤\ufe0f{long}A"
    assert watched.given[:4] == ["e\u0301", "。ｶﾞ", "❤\ufe0f", "。Ａ"]
    monkeypatch.setattr(rewriter, "_word", None)  # nor are words looked at where no two scripts meet
    assert rewriter.plain("карта и clock\u200b, Ａ") == "карта и clock, A"


def test_frequent_spellings_represent_a_class():
    known = lookalike.Frequencies()
    for word, n in [("paper", 9), ("карта", 5), ("ニ重", 40), ("口音", 7)]:
        known.counts[known.place(word)] += n
    r = lookalike.Rewriter(lookalike.representatives({}), {"Latin": 2, "Cyrillic": 1}, known)
    assert r.plain("ρapеr Рaper") == "paper Paper" and r.plain("кapтa") == "карта"
    assert r.plain("ニ重") == "ニ重" and r.plain("ロ音") == "口音"
    # without a known spelling a letter that is only similar stays
    plain = lookalike.Rewriter(lookalike.representatives({}), {"Latin": 2})
    assert plain.plain("σx ρaper") == "σx ρaper" and plain.plain("Տest ԝord Ꭺpple") == "Sest word Apple"


def test_strings_are_counted():
    import pandas as pd

    texts = ["The paper, Paper PAPER карта", "口音 a 口音", "e\u0301te paper"]
    parts = pd.concat(lookalike._count(["e\u0301", "é"])(iter([pd.DataFrame({"text": texts}), pd.DataFrame({"text": ["paper"]})])))
    counts = parts[parts["member"].isna()].groupby("place")["n"].sum()
    for string, n in [("paper", 5), ("the", 1), ("карта", 1), ("口音", 2)]:
        assert counts[lookalike.Frequencies.place(string)] >= n
    assert counts.sum() == 10 + 4 and parts[parts["member"] == "e\u0301"]["n"].sum() == 1


def test_union_find_is_transitive():
    sets = lookalike.UnionFind()
    for a, b in [("a", "b"), ("c", "d"), ("b", "d")]:
        sets.union(a, b)
    assert len({sets.find(x) for x in "abcd"}) == 1 and sets.find("e") == "e"


def test_prefilter_loses_nothing(spark, rewriter):
    import random

    rng, signs = random.Random(2), "aB１Ａｶﾞ\u0301e\u00a0\u200b⽔水ロニ口カp р ο Տ Ꭺ ーのあ中文。，\n\t\x85é"
    texts = [*PLAIN, *("".join(rng.choice(signs) for _ in range(rng.randint(0, 9))) for _ in range(4000))]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, text string")
    looked = {r["k"] for r in df.where(lookalike.may_differ(F.col("text"))).collect()}
    by_one = {r["k"] for r in df.where(F.col("text").rlike(lookalike.CANDIDATE)).collect()}
    assert looked == by_one
    assert not [t for k, t in enumerate(texts) if rewriter.plain(t) != t and k not in looked]


def test_plain_forms_of_rows(spark):
    rows = [("w", 1, "Ａ"), ("w", 1, "Ａ"), ("w", 2, None), ("w", 3, ""), ("w", None, "好"), ("w", 4, "x" * 50000 + "\u200b")]
    df = spark.createDataFrame(rows, "field string, row_id long, text string").withColumn("plain", F.lit(1))
    out = lookalike.plain_forms(df).collect()
    assert len(out) == 6 and {r["plain"] for r in out if r["row_id"] == 1} == {"A"}
    assert lookalike.plain_forms(df, changed_only=True).count() == 3
    assert lookalike.plain_forms(df.limit(0)).count() == 0


MARKED = ["<b>a</b>中", "&nbsp;甲", "# 甲\n\n乙", "- a\n- b", "[[甲|乙]]", "{{a|b=1}}", "\\textbf{甲}", "$x_{1} \\le 2$ 甲", "`seg -i`甲", "> 甲\n> 乙", "'''甲'''乙", "甲\\\\ 乙", "~~甲~~ 乙"]
SOUND = ["3 < 5 > 2", "7 * 7 * 7 = 343 甲。", "甲 ($5 – $36)。", "R&D / 甲 & 乙。", "C# / C++ 4 [甲]。", "D:\\seg\\71.txt 甲。", "甲_15_old = 乙。", "1. 甲 2. 乙。", "甲 -> 乙。", "2^66 – 甲", "{甲, 乙} 丙", "[27] 甲", ""]


@pytest.mark.parametrize("text,marked", [(t, True) for t in MARKED] + [(t, False) for t in SOUND])
def test_markup_is_told_from_signs(text, marked):
    (_, found), = markup.judge([text], markup.model())
    assert found.any() == marked


def test_markup_of_held_out_forms():
    trees = markup.fitted(held_out=False)
    texts = markup.labelled_texts(600, seed=99, held_out=True)
    judged = markup.judge([t for t, _ in texts], trees)
    right = sum(found.any() == bool(spans) for (_, found), (_, spans) in zip(judged, texts)) / len(texts)
    assert right >= 0.85, right


def _clean(text):
    (nodes, found), = markup.judge([text], markup.model())
    return markup.cleaned(text, nodes, found)


NESTED = {
    "# **题** [甲](b)": "# 题 甲",
    "- 甲 [链](u) 和 **粗**\n- 乙": "- 甲 链 和 粗\n- 乙",
    "| **甲** | 乙 |\n|---|---|\n| [丙](u) | 4 |": "甲\t乙\n\n丙\t4",
    '{| class="x"\n|-\n| 甲 || 乙\n|-\n| 丙 || [[丁|戊]]\n|}': "甲\t乙\n丙\t戊",
    "\\section{\\textbf{题}}\n文": "# 题\n文",
    "<p>甲<b>乙</b></p>": "甲乙",
    "`**x**` 甲": "`**x**` 甲",
}


@pytest.mark.parametrize("text,want", NESTED.items())
def test_markup_within_markup(text, want):
    assert _clean(text) == want
    assert _clean(want) == want


def test_clean_text_stays_clean():
    texts = [t for t, spans in markup.labelled_texts(400, seed=5) if spans]
    once = [_clean(t) for t in texts]
    assert sum(_clean(t) == t for t in once) >= 0.97 * len(once)


def test_candidates_miss_no_node():
    import random

    import regex

    rng, signs = random.Random(3), "<>&#*+-_=~`|[](){}!^$'\\/;:. \nab1甲"
    pattern = regex.compile(markup.CANDIDATE)
    texts = [t for t, _ in markup.labelled_texts(500, seed=7)] + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 14))) for _ in range(20000)]
    for t in texts:
        assert pattern.search(t) or all(n.kind == "sign" for n in markup.parse(t)), t


def test_markup_keeps_structure(spark):
    rows = [(1, "<h2>题</h2>\n<p>文</p>"), (2, "<ul>\n<li>甲</li>\n<li>乙</li>\n</ul>"), (3, "$a^2$ 甲"), (4, None), (5, ""), (5, ""), (6, "```\nx = 1\n```\n甲")]
    out = {r["row_id"]: r["clean"] for r in markup.strip_markup(spark.createDataFrame(rows, "row_id long, text string")).collect()}
    assert out[1].startswith("## 题") and "- 甲" in out[2] and "$a^2$" in out[3] and out[4] is None and "x = 1" in out[6]
    assert markup.marked_rows(spark.createDataFrame(rows, "row_id long, text string").limit(0)).count() == 0


def test_nothing_within_code_is_markup():
    for text, kinds in [("<!-- <b>x</b> --><i>y</i>", ["comment", "tag", "tag"]), ("`**x**` 甲", ["code", "strong"])]:
        (nodes, found), = markup.judge([text], markup.model())
        assert [n.kind for n in nodes] == kinds and found[0] and not found[1]


ENDS = [
    ("zh", "甲乙……丙丁。“怎么？”他问，“好吗？”后来下雨。", ["甲乙……丙丁。", "“怎么？”他问，“好吗？”", "后来下雨。"]),
    ("zh", "他说：“一。二。”《怎么？》好（见第1.2节）。", ["他说：“一。二。”", "《怎么？》好（见第1.2节）。"]),
    ("zh", "山村小记\n他留在村里.又来了！！！", ["山村小记", "他留在村里.", "又来了！！！"]),
    ("ja", "「行く。」と言った。ver.2.3を使う。", ["「行く。」と言った。", "ver.2.3を使う。"]),
    ("th", "ราคา 31 บาท ชาวบ้าน", ["ราคา 31 บาท", "ชาวบ้าน"]),
    ("hi", '"वह गया।" लेखक ने कहा। डॉ. वह 4.2 किलो।', ['"वह गया।" लेखक ने कहा।', "डॉ. वह 4.2 किलो।"]),
    ("en", 'He left at 4 p.m. The cat sat. "Is it?" asked Tom. See No. 4.', ["He left at 4 p.m.", "The cat sat.", '"Is it?" asked Tom.', "See No. 4."]),
    ("en", "", []),
    ("en", "  \n ", []),
]


@pytest.mark.parametrize("lang,text,want", ENDS)
def test_sentences(lang, text, want):
    known = sentences.Statistics({"p.m", "no", "डॉ"}, {"The", "See"})
    starts = [0, *sentences.sentence_ends(text, lang, known)]
    assert [text[a:b].strip() for a, b in zip(starts, starts[1:])] == want


def test_statistics_are_learned(spark):
    text = "The smith saw Mr. Brown there. The potter there again met Mr. Green again. He kept approx. 4 cows there and cows again. "
    rows = [(k, "en", text * 20) for k in range(3)] + [(9, None, None), (10, "x", "")]
    known = sentences.learn(spark.createDataFrame(rows, "row_id long, lang string, text string"))
    assert all(a in known["en"].abbreviations for a in ("mr", "approx")) and "there" not in known["en"].abbreviations
    assert all(s in known["en"].starters for s in ("The", "He")) and "Brown" not in known["en"].starters
    assert "mr" in known["xx"].abbreviations and "mr" not in known["de"].abbreviations and ("mr", "Brown") in known["en"].collocations
    found = sentences.split_sentences(spark.createDataFrame(rows, "row_id long, lang string, text string"))
    assert found.count() == 3 * 60


def test_members_of_several_code_points_are_counted_once_for_each_place():
    members = sorted({m for ms in lookalike.classes().values() for m in ms if m})
    texts = ["e\u0301e\u0301\u0302", "\u0301", "か\u3099ｶﾞﾞ", "a\u0301\n\u0301b", "", "ﾊﾟﾊ甲a\u0323\u0302", "ﾞ"]
    counted = pd.concat(lookalike._count(members)(iter([pd.DataFrame({"text": texts})])))
    found = counted[counted["member"].str.len() > 1].set_index("member")["n"].to_dict()
    want = {m: sum(t.startswith(m, k) for t in texts for k in range(len(t))) for m in members if len(m) > 1}
    assert found == {m: n for m, n in want.items() if n} and len(found) > 5


GARBLED = [("utf-8", "latin-1"), ("gb18030", "latin-1"), ("gb18030", "cp1251"), ("utf-8", "gb18030")]


def test_encodings_round_trip(spark):
    import random

    rng = random.Random(3)
    stock = ["守闸人", "不肯卖", "渔网", "只答应", "借用到", "春天", "编词典的", "老人", "在河边", "登记了", "铜铃", "和木桥"]
    clean = ["".join(rng.choice(stock) for _ in range(8)) + "。" for _ in range(400)]
    rows = [(k, "a", t) for k, t in enumerate(clean)]
    for k, (written, read) in enumerate(GARBLED):
        wrong = clean[k].encode(written).decode(read, "replace")
        rows.append((1000 + k, "b", wrong))
    rows += [(2000, "b", clean[0]), (2001, "b", "São Ângelo © ½"), (2002, None, None), (2003, None, "甲�乙"), (2004, "b", "")]
    df = spark.createDataFrame(rows, "row_id long, source string, text string").withColumn("lost", F.lit(1))
    out = {r["row_id"]: r for r in encoding.garbled(df).collect()}
    assert set(out) == {1000, 1001, 1002, 1003, 2003}
    assert out[1000]["restored"] == clean[0] and out[1001]["restored"] == clean[1] and out[1002]["restored"] == clean[2]
    assert out[2003]["lost"] and out[2003]["restored"] is None
    assert encoding.garbled(df.limit(0)).count() == 0


def test_frequent_garbling_stays_suspect(spark):
    import random

    rng = random.Random(5)
    stock = ["守闸人", "不肯卖", "渔网", "只答应", "借用到", "春天", "编词典的", "老人", "在河边", "登记了", "铜铃", "和木桥"]
    clean = ["".join(rng.choice(stock) for _ in range(8)) + "。" for _ in range(400)]
    for written, read in [("utf-8", "koi8_r"), ("gb18030", "cp866")]:
        wrong = [(1000 + k, "b", t.encode(written).decode(read)) for k, t in enumerate(clean[:200])]
        df = spark.createDataFrame([(k, "a", t) for k, t in enumerate(clean)] + wrong * 2, "row_id long, source string, text string")
        out = [r["row_id"] for r in encoding.garbled(df).collect()]
        assert sorted(out) == sorted(r[0] for r in wrong * 2)


def _stocked(rng, n):
    stock = ["守闸人", "不肯卖", "渔网", "只答应", "借用到", "春天", "编词典的", "老人", "在河边", "登记了", "铜铃", "和木桥"]
    return "".join(rng.choice(stock) for _ in range(n)) + "。"


def _late_garbled():
    """Clean texts, and the same with texts that a cipher garbled beyond their first 1000 characters."""
    import random

    rng = random.Random(7)
    clean = [_stocked(rng, 8) for _ in range(300)]
    wrong = clean[0].encode().decode("koi8_r")
    return clean, clean + [_stocked(rng, 600) + "\n" + wrong for _ in range(100)]


def test_pairs_of_ciphers_are_taken_off_the_counts_wherever_they_stand(spark):
    clean, texts = _late_garbled()
    wrong = texts[-1].split("\n")[1]
    lm = encoding.learn_bigrams(spark.createDataFrame([(t,) for t in texts], "text string"))
    (a, e, _), *_ = encoding.spans(wrong, ("koi8_r", "utf-8"))
    none, known = np.float32(np.log(encoding.SMOOTH)), encoding.pair_hash(encoding.code_points("".join(clean)))
    gone = [h for h in encoding.pair_hash(encoding.code_points(wrong[a:e])) if h not in known]
    assert len(gone) > 5 and (lm.pair[gone] == none).all() and (lm.pair[known] > none).mean() > 0.9


def test_pages_are_restored_of_what_a_frequent_cipher_did(spark, tmp_path):
    from lexmill.llm import queries

    clean, texts = _late_garbled()
    rows = [(k, k // 10, k % 10, "s", "web", t) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "sent_id long, page_id long, line_no int, site string, channel string, sentence string").write.parquet(f"{tmp_path}/baseseg.parquet")
    _, restored = queries._pages(spark, str(tmp_path))
    assert {r["row_id"] for r in restored.collect() if r["text"].endswith("\n" + clean[0])} == set(range(300, 400))


def test_values_of_a_cipher_are_found_wherever_they_stand(spark):
    clean, texts = _late_garbled()
    out = encoding.garbled(spark.createDataFrame([(k, "a", t) for k, t in enumerate(texts)], "row_id long, source string, text string")).collect()
    assert {r["row_id"] for r in out} == set(range(300, 400)) and all(r["restored"].endswith("\n" + clean[0]) for r in out)


def _each_with_a_lost_byte():
    """Pages of clean sentences, each with a lost byte in one of them, and other clean texts as a cipher garbled them."""
    import random

    rng = random.Random(7)
    pages = ["\n".join([*(_stocked(rng, 8) + _stocked(rng, 8) for _ in range(10)), "甲�乙。" + _stocked(rng, 8)]) for _ in range(60)]
    clean = [_stocked(rng, 8) for _ in range(40)]
    return pages, clean, [t.encode("gb18030").decode("cp866") for t in clean]


def test_a_lost_byte_keeps_no_other_sentence_out_of_the_counts(spark):
    texts = ["甲。乙�丙！丁戊\n己", "a b. c\x85\x90 d. e. f", "�", "", "3.5 �.", "ｱｲｳｴ\n\n庚", "clean. text", "辛。�"]
    assert encoding.sound_parts(texts) == ["甲。\n丁戊\n己", "a b.\n e. f", None, "", None, "庚", "clean. text", "辛。"]
    for k in range(len(texts)):  # whatever stands beside a text
        assert encoding.sound_parts(texts[k:] + texts[:k]) == encoding.sound_parts(texts)[k:] + encoding.sound_parts(texts)[:k]
    pages, clean, wrong = _each_with_a_lost_byte()
    whole, parts = (
        encoding.learn_bigrams(spark.createDataFrame([(t,) for t in each], "text string"))
        for each in (pages + wrong, [p.replace("甲�乙。", "\n") for p in pages] + wrong)
    )
    inside = encoding.pair_hash(encoding.code_points("".join(clean)))
    assert len(inside) > 500 and np.allclose(whole.pair[inside], parts.pair[inside], atol=0.01)


def test_pages_are_restored_where_each_has_a_lost_byte(spark, tmp_path):
    from lexmill.llm import queries

    pages, clean, wrong = _each_with_a_lost_byte()
    rows = [(k, k, 1, "a", "web", t) for k, t in enumerate(pages)] + [(1000 + k, 1000, k, "b", "web", t) for k, t in enumerate(wrong)]
    spark.createDataFrame(rows, "sent_id long, page_id long, line_no int, site string, channel string, sentence string").write.parquet(f"{tmp_path}/baseseg.parquet")
    _, restored = queries._pages(spark, str(tmp_path))
    assert {r["row_id"]: r["text"] for r in restored.collect()} == {1000 + k: t for k, t in enumerate(clean)}


def test_values_are_found_where_others_each_have_a_lost_byte(spark):
    pages, clean, wrong = _each_with_a_lost_byte()
    rows = [(k, "a", t) for k, t in enumerate(pages)] + [(1000 + k, "b", t) for k, t in enumerate(wrong)]
    out = {r["row_id"]: r for r in encoding.garbled(spark.createDataFrame(rows, "row_id long, source string, text string")).collect()}
    assert set(out) == set(range(60)) | set(range(1000, 1040)) and all(out[k]["lost"] and out[k]["restored"] is None for k in range(60))
    assert [out[1000 + k]["restored"] for k in range(40)] == clean


def test_values_are_found_where_every_other_sentence_holds_an_unsound_sign(spark):
    import random

    for sign in ("××××", "····", "�"):
        rng = random.Random(7)
        clean = [_stocked(rng, 8) for _ in range(40)]
        rows = [(k, "a", _stocked(rng, 10)[:-1] + sign + _stocked(rng, 10)) for k in range(200)]
        rows += [(1000 + k, "b", t.encode("gb18030").decode("cp866")) for k, t in enumerate(clean)]
        out = {r["row_id"]: r for r in encoding.garbled(spark.createDataFrame(rows, "row_id long, source string, text string")).collect()}
        assert [out[1000 + k]["restored"] for k in range(40)] == clean
        assert all(r["lost"] and r["restored"] is None for k, r in out.items() if k < 200) and len(out) == (240 if sign == "�" else 40)


def test_pairs_beside_lost_bytes_are_not_known():
    long, short = "一二三四五六七八", "一二三"
    cp = encoding.code_points(f"\n{long}�{long}�{short}�\n�{short}\n")
    pairs = [chr(a) + chr(b) for a, b in zip(cp[:-1][encoding.known_pairs(cp)], cp[1:][encoding.known_pairs(cp)])]
    inside = [a + b for a, b in zip(long, long[1:])]
    assert pairs == ["\n一", *inside, *inside, "一二", "二三", "三\n"]


def test_spans_of_a_batch_are_those_of_its_texts():
    import random

    rng = random.Random(9)
    clean = [_stocked(rng, 6) for _ in range(100)] + [_russian(rng, 12) for _ in range(100)] + ["Müller aß dort Käse à la carte, señor; où est l'été"]
    texts = clean + ["", "\n", "a\nﾀ𠀀é😀", "甲乙\x81é"]
    for read, written in encoding.KEYS:
        texts += [rng.choice(clean).encode(written, "ignore").decode(read, "ignore") for _ in range(8)]
    for _ in range(300):
        parts = [(1, 0x100), (0x100, 0x3100), (0x3400, 0xA000), (0xE000, 0x30000)]
        texts.append("".join(chr(rng.randrange(*rng.choice(parts))) for _ in range(rng.randrange(12))) + rng.choice(clean)[:9])
    texts, cp, starts = encoding.sound_texts(texts)
    both = encoding._of_buckets(next(encoding._count(iter([pd.DataFrame({"text": clean})]))))
    lm = encoding._of_counts(both[: encoding.BUCKETS], both[encoding.BUCKETS :])
    found = encoding.spoiled_spans(cp, starts, lm)
    assert len(found) > 10
    for key in encoding.KEYS:
        want = set()
        for text, start in zip(texts, starts.tolist()):
            padded = f"\n{text}\n"
            for a, e, original in encoding.spans(text, key) if encoding._SIGNS[key[0]].search(text) else []:
                if lm.score(padded[a] + original + padded[e + 1]) >= encoding.USUAL * (len(original) + 1):
                    want.add((start + a, start + e, original))
        assert set(found.get(key, [])) == want, key


def test_pages_of_one_byte_are_tried_only_beside_their_letters():
    long = "今天下雨，明天放晴。" * 50
    text = f"{long}“a”{long}é"
    cp, starts = encoding._joined([text])
    tried = {key: (place, some) for key, place, some, _ in encoding.tried_keys(cp, starts)}
    assert "".join(map(chr, tried["cp1252", "big5hkscs"][1])) == "。“a”今天。é\n"
    assert all(np.array_equal(cp[place], some) for place, some in tried.values())
    assert len(tried["gb18030", "utf-8"][1]) == len(text) + 2


def _best_key(text, lm):
    """The search for the best key, span by span."""
    padded, tries = f"\n{text}\n", []
    for k, key in enumerate(encoding.KEYS):
        most = total = 0.0
        out, done = "", 0
        for a, e, original in encoding.spans(text, key) if encoding._SIGNS[key[0]].search(text) else []:
            old = lm.steps(padded[a : e + 2])[: e - a + 1].sum(dtype=np.float64)
            if old <= encoding.USUAL * (e - a + 1):
                most += -old - len(original) * encoding.SUREST
                new = lm.steps(padded[a] + original + padded[e + 1]).sum(dtype=np.float64)
                if new - old > encoding.FLOOR:
                    total, out, done = total + new - old, out + text[done:a] + original, e
        if most:
            tries.append((-most, k, total, out + text[done:]))
    best = (0.0, -1, text)
    for least, k, total, restored in sorted(tries):
        if -least <= best[0]:
            break
        if total > best[0]:
            best = (total, k, restored)
    return best


def test_keys_are_tried_on_all_texts_of_a_batch_at_once(monkeypatch):
    import random

    rng = random.Random(11)
    clean = [_stocked(rng, 6) for _ in range(60)] + [_russian(rng, 12) for _ in range(60)] + ["Müller aß dort Käse à la carte, señor; où est l'été"] * 9
    texts = ["", "\n", "�", "é�\né", "××××", "a\nﾀ𠀀é😀", "甲乙\x81é"]
    for read, written in encoding.KEYS:
        texts += [rng.choice(clean).encode(written, "ignore").decode(read, how) + end for how in ("ignore", "replace") for end in ("", "\nﾀ", rng.choice(clean))]
    texts = [t.replace("Ã", "") for t in texts]  # these are read twice, one by one
    both = encoding._of_buckets(next(encoding._count(iter([pd.DataFrame({"text": clean})]))))
    lm = encoding._of_counts(both[: encoding.BUCKETS], both[encoding.BUCKETS :])
    want = [_best_key(t, lm) for t in texts]
    assert len({k for _, k, _ in want}) > 15

    def one_by_one(*_):
        raise AssertionError("a key was tried on a single text")

    monkeypatch.setattr(encoding, "spans", one_by_one)
    rows = pd.DataFrame({"row_id": [str(i) for i in range(len(texts))], "source": "a", "lost": True, "text": texts})
    out = pd.concat(encoding._analyse(lm)(iter([rows]))).dropna(subset="row_id").set_index("row_id")
    odd = {i: [line for line in t.split("\n") if encoding.suspects([line], lm)[0]] if encoding.suspects([t], lm)[0] else [] for i, t in enumerate(texts)}
    assert sum(map(bool, odd.values())) > 100
    got = encoding.best_keys(texts, lm)
    for i, (text, (gain, k, restored)) in enumerate(zip(texts, want)):
        assert got[i][1:] == (k, restored) and got[i][0] == pytest.approx(gain), text
        if odd[i] == text.split("\n"):
            assert (out.loc[str(i), "key"], out.loc[str(i), "restored"]) == (k, restored)


RUSSIAN = (
    "старик жил у самого моря и каждое утро выходил на берег смотреть как возвращаются лодки рыбаки привозили сети полные рыбы и рассказывали о далёких островах "
    "его дочь работала в школе учила детей читать и писать вечером они пили чай говорили о погоде и о том что зима в этом году будет долгая и холодная мельник "
    "привёз муку кузнец починил старую телегу а соседка принесла свежий хлеб и банку мёда когда выпал первый снег все жители деревни вышли на улицу чтобы помочь "
    "друг другу убрать дорогу после этого они собрались в большом доме и долго пели песни"
).split()


def _russian(rng, n):
    return " ".join(rng.choice(RUSSIAN) for _ in range(n))


def test_cells_are_learned_from_pairs():
    import random

    import numpy as np
    import pandas as pd

    rng = random.Random(8)
    clean = pd.concat(encoding._count(iter([pd.DataFrame({"text": [_russian(rng, 400) for _ in range(60)]})])))
    both = np.zeros(encoding.BUCKETS + encoding.FIRSTS + 1)
    both[clean["bucket"]] = clean["n"]
    lm = encoding._of_counts(both[: encoding.BUCKETS], both[encoding.BUCKETS : -1])
    # a swap of pages that is not among the listed ones
    assert ("mac_greek", "cp1251") not in encoding.KEYS
    text = _russian(rng, 3000)
    wrong = "".join(ch if ch.isascii() else ch.encode("cp1251").decode("mac_greek") for ch in text)
    counts = pd.concat(encoding._count_signs(iter([pd.DataFrame({"source": ["s"], "odd": [wrong]})])))
    cells = encoding._learn_source(lm)(("s",), counts).iloc[0]
    assert encoding.ALPHABETS[cells["alphabet"]] == "cp1251"
    back = wrong.translate(str.maketrans(cells["signs"], cells["letters"]))
    assert sum(a == b for a, b in zip(back, text)) / len(text) > 0.9, back[:200]
    done = pd.concat(encoding._decipher(lm)(iter([pd.DataFrame({"row_id": ["1"], "source": ["s"], "odd": [wrong], "restored": ["a\n" + wrong], **{c: [cells[c]] for c in ("signs", "letters", "alphabet")}})])))
    assert done["restored"].iloc[0] == "a\n" + back


def _cut(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("trailer", F.lit(1))
    return {r["doc_id"]: r["evidence"] for r in truncation.truncated(df).collect()}


def test_cut_texts(spark):
    whole = "今天下雨。"
    rows = [(k, "a", whole * 10 + "明天" * (k % 2) + "晴。") for k in range(8)]
    rows += [(100 + k, "b", (f"{k}号" + whole * 20)[:60]) for k in range(8)]
    rows += [(201, "a", whole + "甲乙"), (202, "a", whole + "<p"), (203, "a", whole + "甲�"), (204, "a", whole + "\n· 树苗")]
    rows += [(205, "a", whole + "\n（全文完）"), (206, "a", None), (207, "a", ""), (208, None, whole)]
    out = _cut(spark, rows)
    assert all(out[100 + k] for k in range(8))
    assert out[201] == "open" and out[202] == "torn" and out[203] == "torn"
    assert out[204] is None and out[205] is None and out[207] is None and out[208] is None and 206 not in out


def test_cut_at_limits_below_the_greatest_length(spark):
    rows = [(k, "a", f"{k}号" + "今天下雨。" * (10 + k)) for k in range(200)]  # far longer ones too
    rows += [(1000 + k, "a", f"{1000 + k}号明天" + "晴" * 394 + "…") for k in range(3)]  # 1.5 % of the source
    rows += [(2000 + k, "a", f"{2000 + k}号后天" + "雪" * 594 + "...") for k in range(3)]
    rows += [(3000, "a", "今天下雨。\n明天又[…]"), (3001, "a", "明天" + "晴" * 300 + "下雨…")]
    out = _cut(spark, rows)
    assert all(out[1000 + k] == out[2000 + k] == "limit" for k in range(3)) and out[3000] == "open"
    assert not any(out[k] for k in range(200)) and out[3001] is None


def test_cut_last_token_by_trie(spark):
    rows = [(k, "a", f"今天下雨。\n——{w}词语小组") for k, w in enumerate(["东山", "东山", "南山"])]
    out = _cut(spark, [*rows, (9, "a", "今天下雨。\n——东山词语小")])
    assert out[9] == "prefix" and out[0] is None


def test_cut_within_words_of_running_text(spark):
    rows = [(200 + k, "a", f"The harbour was quiet and the lantern burned {k}.") for k in range(40)]
    rows += [(100 + k, "a", f"{k}/今天/下雨/，渡船/停在/码头/。") for k in range(40)]
    rows += [(60 + k, "a", f"{k}号没有渡船。The harbour {k} burned. It is {k}.\n昨天/没有/{k}/渡船/。") for k in range(20)]
    rows += [(20, "b", "The lantern was quiet and the harb…"), (21, "b", "It was quiet near the lant."), (22, "b", "今天/下雨/，/渡…")]
    rows += [(23, "b", "昨天下雨所以渡…"), (24, "b", "昨天下雨所以渡船……"), (25, "b", "The harbour burned…"), (26, "c", "It was quiet near the lant.")]
    rows += [(27, "b", "今天/下雨/，/渡船/…"), (28, "b", "The lantern was quiet and the h [...]")]
    out = _cut(spark, rows)
    assert {k for k, e in out.items() if e == "prefix"} == {20, 21, 22, 23, 26, 28}
    assert not any(out[k] for k in [24, 25, 27, *range(60, 80), *range(100, 140), *range(200, 240)])


def test_page_frame(spark):
    rows = []
    for page in range(40):
        lines = ["首页 地图 论坛 帮助", f"下一篇：{page}号", f"{chr(0x4E00 + 50 * page)}{chr(0x6E00 + 7 * page)}村：{chr(0x5E00 + 9 * page)}笼", f"今天{page}号下雨，大家都在家里看书写字。", "点击展开全文", f"后来{page}号天晴，大家又到河边去了。", "返回顶部"]
        rows += [(page * 10 + k, page, k, t) for k, t in enumerate(lines)]
    rows += [(9000, 77, 0, None), (9001, None, 0, "今天下雨，大家都在家。"), (5, 0, 5, rows[5][3])]
    df = spark.createDataFrame(rows, "row_id long, page_id long, line_no int, text string").withColumn("main", F.lit(1))
    out = boilerplate.frame_lines(df).collect()
    frame = {r["row_id"] % 10 for r in out if not r["main"] and r["row_id"] < 9000}
    assert frame == {0, 1, 4, 6}
    assert len(out) == 40 * 7 + 2
    assert boilerplate.frame_lines(df.limit(0)).count() == 0
    again = spark.createDataFrame([(31, 3, 1, "今天又下雨，大家还在家里看书写字。\n返回顶部")], "row_id long, page_id long, line_no int, text string")
    out = boilerplate.frame_lines(df, again).collect()
    assert sorted((r["seg_no"], r["main"]) for r in out if r["row_id"] == 31) == [(1, True), (2, False)] and len(out) == 40 * 7 + 3
