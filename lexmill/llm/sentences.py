"""Problem 5: sentences of running text in many languages.

Per language, without supervision, log-likelihood ratios find the abbreviations
(types that a period follows more often than chance would have it, given their
length), the sentence starters (types that follow a certain break more often
than they occur elsewhere) and collocations around a period. Each period of a
text is then judged by these. Full stops of other scripts, quotations with the
clause that names the speaker, titles in brackets, headings on a line of their
own and scripts that part sentences by spaces follow fixed rules.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Container, Iterator

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.session import map_keyed, write_table

ABBREVIATION = 0.2
STARTER = 10.0
STARTER_RATE = 0.1  # least share of a starter's occurrences that follow a certain break
COLLOCATION = 7.88
EVIDENCE = 200  # occurrences of a type that count; of more, the shares are kept
BITS = 1 << 26  # of the filter that holds what was learned, 8 MB however much that is

# Codes and names under which a language is tagged.
LANGUAGES = {
    "zh": "zh", "zho": "zh", "chi": "zh", "chs": "zh", "cht": "zh", "cn": "zh", "ja": "ja", "jp": "ja", "jpn": "ja", "en": "en", "eng": "en", "de": "de",
    "ger": "de", "deu": "de", "fr": "fr", "fre": "fr", "fra": "fr", "es": "es", "spa": "es", "ru": "ru", "rus": "ru", "th": "th", "tha": "th", "hi": "hi", "hin": "hi",
}
#: Verbs of the clause that names a speaker after a quotation.
_SPEAKER = {
    "zh": regex.compile(r"\s*[^，。！？：；“”「」\n]{1,16}?(?:问|说|道|喊|叫|答|讲|曰)(?:着|了)?(?=\s*[，。！？,.!?])"),
    "hi": regex.compile(r"\s*[^।?!\"“”\n]{1,40}?(?:कहा|पूछा|बोला|बोली|बोले|चिल्लाया|चिल्लाई)(?=\s*[।?!,])"),
}
_PAIRS = {"“": "”", "「": "」", "『": "』", "《": "》", "«": "»", "„": "“", "（": "）", "(": ")", "【": "】", "〈": "〉", "‹": "›"}
_SIGN = regex.compile("[" + regex.escape("".join({*_PAIRS, *_PAIRS.values(), '"'}), special_only=False) + "]")
_QUOTES = "“「『«„\"‹"
_STOP = "。．！？!?.…।॥؟⁇⁈⁉"
_CLOSERS = "”’」』）)»\"'〉》】]›"
_WORD = r"[\p{L}\p{M}\p{Cf}’'.-]*[\p{L}\p{M}]\.?|\d+\.?"
_AFTER = regex.compile(r"\s*[\p{Ps}\p{Pi}\"'“„«¿¡—–-]*\s*([\p{L}\p{M}\p{Cf}’'-]+\.?|\d+)?")
_CF = regex.compile(r"\p{Cf}")


def language(tag: Column, text: Column) -> Column:
    """The language by its tag, else by the script; ``xx`` for Latin script without a tag."""
    short = F.lower(F.regexp_extract(tag, r"^([A-Za-z]+)", 1))
    table = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    script = (
        F.when(text.rlike(r"[\x{3041}-\x{30FF}]"), "ja")
        .when(text.rlike(r"[\x{4E00}-\x{9FFF}]"), "zh")
        .when(text.rlike(r"[\x{400}-\x{4FF}]"), "ru")
        .when(text.rlike(r"[\x{E00}-\x{E7F}]"), "th")
        .when(text.rlike(r"[\x{900}-\x{97F}]"), "hi")
        .otherwise("xx")
    )
    return F.coalesce(F.try_element_at(table, short), script)


def _form(token: str) -> str:
    """The token as it stands; all numbers are one."""
    token = _CF.sub("", unicodedata.normalize("NFKC", token))
    return "0" if token[:1].isdigit() else token.rstrip(".")


def _type(token: str) -> str:
    return _CF.sub("", unicodedata.normalize("NFKC", token)).casefold()


def _log(p: Column) -> Column:
    return F.log(F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12)))


def dunning(with_period: Column, total: Column, share: Column) -> Column:
    """Log-likelihood ratio of a period following as often as it does, against by chance."""
    null = with_period * _log(share) + (total - with_period) * _log(1 - share)
    sure = with_period * math.log(0.99) + (total - with_period) * math.log(0.01)
    return -2 * (null - sure)


def association(a: Column, b: Column, ab: Column, n: Column) -> Column:
    """Log-likelihood ratio of two events, ``a`` and ``b`` times, together ``ab`` times of ``n``."""

    def term(k: Column, m: Column, p: Column) -> Column:
        return k * _log(p) + (m - k) * _log(1 - p)

    p, p1, p2 = b / n, ab / F.greatest(a, F.lit(1e-9)), (b - ab) / F.greatest(n - a, F.lit(1e-9))
    return 2 * (term(ab, a, p1) + term(b - ab, n - a, p2) - term(ab, a, p) - term(b - ab, n - a, p))


class Statistics:
    """What is known of one language: abbreviations, starters and collocations, in anything that answers ``in``."""

    def __init__(self, abbreviations: Container = frozenset(), starters: Container = frozenset(), collocations: Container = frozenset()):
        self.abbreviations, self.starters, self.collocations = abbreviations, starters, collocations


class Learned:
    """A filter of ``BITS`` bits over what was learned of one kind in some languages."""

    def __init__(self, bitmap: np.ndarray, kind: str, langs: tuple[str, ...]):
        self.bitmap, self.kind, self.langs = bitmap, kind, langs

    def __contains__(self, item: str | tuple[str, str]) -> bool:
        text = item if isinstance(item, str) else "\x01".join(item)
        for lang in self.langs:
            bit = xxhash.xxh64(f"{self.kind}\x01{lang}\x01{text}".encode("utf-8", "surrogatepass"), seed=42).intdigest() & (BITS - 1)
            if self.bitmap[bit >> 3] >> (bit & 7) & 1:
                return True
        return False


def _clean(token: Column) -> Column:
    return F.lower(F.regexp_replace(token, r"\p{Cf}|\.\z", ""))


def _start(token: Column) -> Column:
    return F.when(token.rlike(r"^\d"), "0").otherwise(F.regexp_replace(token, r"\p{Cf}|\.\z", ""))


CUT = ("en", "de", "fr", "es", "ru", "hi", "xx")  # languages that write periods


def statistics(rows: DataFrame) -> DataFrame:
    """``(kind, lang, item)``: abbreviations ``a``, starters ``s`` and collocations ``c`` of all rows ``(lang, text)``.

    Every type is tested, on the executors; nothing rare is left out.
    """
    cut = rows.where(F.col("lang").isin(*CUT))
    tokens = cut.select("lang", F.regexp_extract_all("text", F.lit(_WORD), 0).alias("t"))
    single = tokens.select("lang", F.explode("t").alias("a"))
    dotted = F.endswith("a", F.lit("."))
    counts = single.groupBy("lang", _clean(F.col("a")).alias("a"), _start(F.col("a")).alias("s")).agg(F.count("*").alias("n"), F.count_if(dotted).alias("d"))
    # written once, as three tables are made of it
    counts = write_table(counts)
    sums = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.sum("d").alias("periods"))
    types = counts.groupBy("lang", "a").agg(F.sum("n").alias("n"), F.sum("d").alias("d")).join(F.broadcast(sums), "lang")  # a row for each language

    part = F.least(F.lit(1.0), EVIDENCE / F.col("n"))
    n, d = F.col("n") * part, F.col("d") * part
    letters = F.length(F.replace("a", F.lit("."), F.lit("")))
    score = dunning(d, n, F.col("periods") / F.col("total")) * F.exp(-letters) * (F.regexp_count("a", F.lit(r"\.")) + 1) * F.pow(letters.cast("double"), d - n)
    abbreviations = types.where((F.col("d") > 0) & (letters > 0) & ~F.col("a").rlike(r"^\d+$") & (score >= ABBREVIATION)).select("lang", "a")

    pairs = tokens.select("lang", F.explode(F.arrays_zip(F.col("t").alias("a"), F.slice("t", 2, 1_000_000_000).alias("b"))).alias("p"))
    pairs = pairs.select("lang", F.col("p.a").alias("a"), F.col("p.b").alias("b")).where(dotted & F.col("b").isNotNull() & ~F.col("b").rlike(r"^\p{Ll}"))
    after = pairs.groupBy("lang", _clean(F.col("a")).alias("a"), _start(F.col("b")).alias("b")).agg(F.count("*").alias("n"))
    after = after.join(abbreviations.withColumn("short", F.lit(True)), ["lang", "a"], "left").withColumn("unsure", F.coalesce("short", F.col("a").rlike(r"^\d")))
    after = write_table(after.select("lang", "a", "b", "n", "unsure"))
    often = counts.groupBy("lang", F.col("s").alias("b")).agg(F.sum("n").alias("often"))

    sure = after.where("NOT unsure").groupBy("lang", "b").agg(F.sum("n").alias("n"))
    breaks = sure.groupBy("lang").agg(F.sum("n").alias("breaks"))
    starts = sure.join(often, ["lang", "b"]).join(F.broadcast(breaks.join(sums, "lang")), "lang")
    ratio = association(*[F.col(c).cast("double") for c in ("breaks", "often", "n", "total")])
    starters = starts.where((F.col("n") >= STARTER_RATE * F.col("often")) & (ratio >= STARTER)).select("lang", "b")

    dots = types.select("lang", "a", "d")
    follow = after.where("unsure").join(often, ["lang", "b"]).join(dots, ["lang", "a"]).join(F.broadcast(sums), "lang").join(starters, ["lang", "b"], "left_anti")
    ratio = association(*[F.col(c).cast("double") for c in ("d", "often", "n", "total")])
    collocations = follow.where(ratio >= COLLOCATION).select("lang", F.concat_ws("\x01", "a", "b").alias("item"))
    named = lambda df, kind: df.toDF("lang", "item").select(F.lit(kind).alias("kind"), "lang", "item")
    return named(abbreviations, "a").unionAll(named(starters, "s")).unionAll(named(collocations, "c"))


def learn(rows: DataFrame) -> dict[str, Statistics]:
    """Statistics of every language that writes periods, from all rows ``(lang, text)``.

    What was learned comes as a filter of fixed size, made on the executors in pieces of 4 kB.
    """
    key = F.xxhash64(F.concat_ws("\x01", "kind", "lang", "item")).bitwiseAND(F.lit(BITS - 1))
    place = F.bitmap_construct_agg(key.bitwiseAND(F.lit(0x7FFF)))
    bitmap = np.zeros(BITS // 8, np.uint8)
    for r in statistics(rows).groupBy(F.shiftright(key, 15).alias("b")).agg(place.alias("bits")).collect():
        bitmap[r["b"] << 12 : (r["b"] + 1) << 12] = np.frombuffer(bytes(r["bits"]), np.uint8)
    # Latin script without a tag may be any of four languages
    of = {lang: ("en", "de", "fr", "es") if lang == "xx" else (lang,) for lang in CUT}
    return {lang: Statistics(*(Learned(bitmap, kind, langs) for kind in "asc")) for lang, langs in of.items()}


def _quoted(text: str) -> list[tuple[int, int]]:
    """The outermost bracketed or quoted spans, ends exclusive; what is never closed is no span."""
    waiting: list[tuple[str, int]] = []  # closing sign and start
    open_signs: dict[str, int] = {}
    found = []
    for m in _SIGN.finditer(text):
        k, ch = m.start(), m[0]
        if open_signs.get(ch):
            while True:
                end, start = waiting.pop()
                open_signs[end] -= 1
                if end == ch:
                    break
            found.append((start, k + 1))
        elif ch in _PAIRS or ch == '"':
            end = _PAIRS.get(ch, ch)
            waiting.append((end, k))
            open_signs[end] = open_signs.get(end, 0) + 1
    out: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if not out or start >= out[-1][1]:
            out.append((start, end))
    return out


_POINT = regex.compile(rf"[{regex.escape(_STOP)}]+|\n|[“「『«„\"‹（(《【〈]| (?=\S)")


def _continues(text: str, end: int) -> bool:
    """Whether what follows goes on in lower case, maybe after a dash."""
    m = regex.match(r"\s*(?:[—–-]\s*)?(\p{L})", text[end : end + 12])
    return bool(m and m[1].islower())


def _goes_on(text: str, end: int, lang: str) -> bool:
    """Whether the sentence goes on after a quotation that ends at ``end``."""
    rest = text[end : end + 60]
    if regex.match(r"\s*[，,；;：:、。．.！？!?…।]", rest):
        return True
    if lang == "ja":
        return bool(regex.match(r"[ぁ-んァ-ヶ一-鿿]", rest)) and bool(regex.match(r"[とってはがをにのも]", rest))
    if lang in _SPEAKER:
        return bool(_SPEAKER[lang].match(rest))
    return _continues(text, end)


def _period(text: str, start: int, end: int, lang: str, known: Statistics) -> bool:
    """Whether a sentence ends with the period (or periods) at ``start:end``."""
    before, after = text[:start], text[end:]
    if lang in ("zh", "ja"):
        return bool(regex.search(r"[\p{Han}\p{Hiragana}\p{Katakana}ー][\p{Cf}]*\Z", before[-6:]))
    if not after or after[0] not in " \n\t\xa0" and not after[0].isspace():
        return not after or after[0] in _CLOSERS
    m = _AFTER.match(after)
    word = m[1] or ""
    opened = bool(regex.search(r"[¿¡\"“„«—]", m[0][: m.start(1) if m[1] else None]))
    if word and word[0].islower():
        return False
    if end - start > 1:
        return True
    token = regex.search(r"[\p{L}\p{M}\p{Cf}\p{N}’'.-]*\Z", before[-40:])[0]
    t, nxt = _type(token), _form(word)
    number = t.replace(".", "").isdigit() and len(t) <= 2  # of more figures it is no ordinal, but a year or an amount
    initial = len(t) == 1 and t.isalpha()
    if number or initial or t in known.abbreviations or t.rpartition(".")[2] in known.abbreviations:
        if opened or not word:
            return nxt != "0"
        return nxt in known.starters and (t, nxt) not in known.collocations
    return nxt != "0" or nxt in known.starters


def _heading(line: str, after: str, lang: str, known: Statistics) -> bool:
    """Whether a line without an end mark, followed by ``after``, is a heading."""
    if lang in ("zh", "ja"):
        return len(line) <= 30 and not regex.search(r"[，、；：,;:]\s*\Z", line) and not regex.search(r"[，；。]", line)
    m = regex.match(r"[\"“„«¿¡—\s]*([\p{L}\p{M}\p{Cf}’'-]+)", after)
    opened = bool(regex.match(r"\s*[\"“„«¿¡—]", after))
    if lang == "hi":
        return not regex.search(r"[।?!]", line) and len(line) <= 40
    if not m or not (m[1][0].isupper() or opened):
        return False
    return len(line.split()) <= 9 and not regex.search(r"[,;:]\s*\Z", line) and (opened or _form(m[1]) in known.starters)


def sentence_ends(text: str, lang: str, known: Statistics | None = None) -> list[int]:
    """End positions, in code points, of the sentences of ``text``."""
    known = known or Statistics()
    ends: list[int] = []
    last = 0

    def close(end: int) -> None:
        nonlocal last
        while end < len(text) and text[end] in _CLOSERS:
            end += 1
        if text[last:end].strip():
            ends.append(last + len(text[last:end].rstrip()))
        last = end

    if lang == "th":
        for m in regex.finditer(r"\s+|[.!?…]+(?=\s|$)", text):
            a, e = m.span()
            if m[0].isspace() and "\n" not in m[0] and (text[a - 1 : a].isdigit() or text[e : e + 1].isdigit() or text[e : e + 1] in "ๆฯ"):
                continue
            close(a if m[0].isspace() else e)
        close(len(text))
        return ends
    inside = {a: e for a, e in _quoted(text)}
    k = 0
    while k < len(text):
        m = _POINT.search(text, k)
        if not m:
            break
        a, e = m.span()
        k = e
        if m[0] == " ":
            continue
        if a in inside:
            e = k = inside[a]
            body = text[a + 1 : e - 1].rstrip()
            if text[a] in _QUOTES and body and body[-1] in _STOP and not _goes_on(text, e, lang):
                close(e)
            continue
        if m[0] == "\n":
            line = text[last:a].strip()
            if line and _heading(line, text[e:], lang, known):
                close(a)
            continue
        if m[0][0] in _PAIRS or m[0] == '"':
            continue  # never closed
        marks = m[0]
        if set(marks) <= set("…"):
            rest = text[e:]
            # "I... I": within a sentence where a word is taken up again, or little was said yet
            said = regex.sub(r"[\p{Cf}\p{Mn}\s]", "", text[last:a])
            again = len(said) < 5 or said[-1] == regex.sub(r"[\p{Cf}\p{Mn}\s]", "", rest[:3])[:1]
            done = not again or not rest.strip() if lang in ("zh", "ja") else not _continues(text, e) and (not rest or rest[0].isspace())
        elif set(marks) == {"."}:
            done = _period(text, a, e, lang, known)
        elif lang in ("zh", "ja", "hi"):
            done = not (set(marks) <= set("!?") and regex.match(r"[A-Za-z0-9]", text[e : e + 1]) and regex.search(r"[A-Za-z0-9]\Z", text[:a]))
        else:
            done = not _continues(text, e)
        if done:
            close(e)
            k = max(k, last)
    close(len(text))
    return ends


def _split(known: dict[str, Statistics]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, ends, starts = [], [], []
            for row_id, lang, text in zip(pdf["row_id"], pdf["lang"], pdf["text"]):
                found = sentence_ends(text, lang, known.get(lang))
                ids += [row_id] * len(found)
                ends += found
                starts += [0, *found][: len(found)]
            yield pd.DataFrame({"row_id": ids, "start_pos": starts, "end_pos": ends})

    return run


def split_sentences(rows: DataFrame) -> DataFrame:
    """``(row_id, start_pos, end_pos)`` of every sentence of rows ``(row_id, lang, text)``.

    ``start_pos`` is the end of the sentence before. A null text has no sentence,
    nor has one of white space only; repeated rows are split each; a null tag
    leaves the language to the script.
    """
    rows = rows.where(F.col("text").isNotNull()).select("row_id", language(F.col("lang"), F.col("text")).alias("lang"), "text")
    return map_keyed(rows, _split(learn(rows)), "row_id long, start_pos long, end_pos long", "row_id")
