"""Problem 1: one consistent form for text that looks the same.

Look-alike classes are the transitive closure (union-find) of pairs of strings
and code points that look alike: compatibility widths, radicals, compatibility
ideographs, letters with a separate accent, spaces, invisible characters, and
letters of different scripts. A multi-pattern automaton rewrites the text greedily,
longest match first, to the plain member of the same script that occurs most often
in the collection.

Where a class has members of several scripts, whole strings are classes: the
spellings of a word of mixed scripts in one script each, or an ideograph and a kana
with the character beside it. The spelling that occurs most often in the collection
represents the others; only where none occurs do the word's own letters decide (or
the ideographs beside a kana). Frequencies of strings are kept in a table of fixed
size.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.session import map_keyed

# Latin letters, each with the letters of other scripts that look the same.
SAME_LOOK = {
    "A": "АΑᎪ", "B": "ВΒᏴ", "C": "СᏟ", "D": "Ꭰ", "E": "ЕΕᎬ", "H": "НΗᎻ", "I": "ІΙ", "J": "ЈᎫ", "K": "КΚᏦ", "L": "Ꮮ", "M": "МΜᎷ", "N": "Ν", "O": "ОΟՕ", "P": "РΡᏢ",
    "Q": "Ԛ", "S": "ЅՏᏚ", "T": "ТΤᎢ", "U": "Ս", "V": "ѴᏙ", "W": "ԜᎳ", "X": "ХΧ", "Y": "УΥ", "Z": "ΖᏃ", "a": "а", "c": "сϲ", "d": "ԁ", "e": "е", "h": "һհ", "i": "і",
    "j": "јϳ", "n": "ո", "o": "оοօ", "p": "р", "q": "ԛ", "s": "ѕ", "u": "ս", "v": "νѵ", "w": "ԝ", "x": "х", "y": "у",
}
# Letters that look alike in some typefaces only; a word is spelled with them only if the collection knows that spelling.
SIMILAR_LOOK = {"a": "α", "i": "ι", "k": "κк", "l": "ӏ", "p": "ρ", "u": "υ", "x": "χ", "y": "γ"}
# Kana of the look of an ideograph, and that ideograph.
KANA_HAN = {"ロ": "口", "ニ": "二", "エ": "工", "ハ": "八", "カ": "力", "ト": "卜", "タ": "夕", "ミ": "三", "メ": "乄"}
# Radicals without a compatibility mapping, each followed by its ideograph.
RADICALS = (
    "⺁厂⺅亻⺉刂⺋㔾⺎兀⺓幺⺔彑⺖忄⺗㣺⺘扌⺙攵⺛旡⺝月⺞歺⺠民⺡氵⺢氺⺣灬⺤爫⺦丬⺨犭⺩王⺪疋⺫目⺬示⺭礻⺮竹⺯糸⺰纟⺲罒⺶羊⺹耂⺺肀⺻聿⺼月⺽臼"
    "⺾艹⻁虎⻂衤⻃覀⻄西⻅见⻆角⻈讠⻉贝⻊足⻋车⻌辶⻏阝⻐钅⻑長⻒镸⻓长⻔门⻕阜⻖阝⻗雨⻘青⻙韦⻚页⻛风⻜飞⻝食⻟飠⻠饣⻢马⻣骨⻤鬼⻥鱼⻦鸟⻧卤⻨麦⻩黄"
    "⻪黾⻫斉⻬齐⻭歯⻮齿⻯竜⻰龙⻱龜⻲亀⻳龟"
)

_FACTOR, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
SKETCH = 1 << 20  # numbers that hold the frequencies of strings
KNOWN = 2  # occurrences that make a spelling known

_INVISIBLE = (
    r"\x{AD}\x{34F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}"
    r"\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}\x{E0000}-\x{E0FFF}"
)
_SPACE = r"\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}"
#: What a value must hold to differ from its plain form; for Spark and for ``regex`` alike.
CANDIDATE = (
    rf"[{_INVISIBLE}{_SPACE}\x{{300}}-\x{{36F}}\x{{3099}}\x{{309A}}\x{{212A}}\x{{212B}}\x{{1F71}}-\x{{1FFD}}\x{{2E80}}-\x{{2FDF}}"
    r"\x{F900}-\x{FAFF}\x{FF10}-\x{FF19}\x{FF21}-\x{FF3A}\x{FF41}-\x{FF5A}\x{FF66}-\x{FF9F}\x{2F800}-\x{2FA1D}]"
    r"|[A-Za-z\x{C0}-\x{24F}][\x{370}-\x{58F}\x{13A0}-\x{13FF}]|[\x{370}-\x{58F}\x{13A0}-\x{13FF}][A-Za-z\x{C0}-\x{24F}]|[\x{370}-\x{3FF}][\x{400}-\x{58F}\x{13A0}-\x{13FF}]|[\x{400}-\x{52F}][\x{370}-\x{3FF}\x{530}-\x{58F}\x{13A0}-\x{13FF}]"
    r"|[\x{530}-\x{58F}][\x{370}-\x{52F}\x{13A0}-\x{13FF}]|[\x{13A0}-\x{13FF}][\x{370}-\x{58F}]"
    r"|[\x{3400}-\x{9FFF}][ロニエハカトタミメ]|[ロニエハカトタミメ][\x{3400}-\x{9FFF}]"
)

#: What is plain whatever stands beside it, the commonest first; a value of nothing else needs no closer look.
_EVER_PLAIN = r"\x{4E00}-\x{9FFF}[\x20-\x7E\n\t\x{FF01}-\x{FF0F}\x{3001}-\x{3020}\x{FF1A}-\x{FF20}\x{2014}-\x{2026}]"
_OTHER_SCRIPTS = r"\x{370}-\x{58F}\x{13A0}-\x{13FF}"


def consists_of(text: Column, letters: str) -> Column:
    """Whether the text has only characters of the class; one loop, where a search for another would begin anew at each."""
    return text.rlike(rf"\A[{letters}]*\z")


def may_differ(text: Column) -> Column:
    """Whether the text holds ``CANDIDATE``, by the cheapest tests first."""
    first, *scripts, before, after = CANDIDATE.split("|")
    beside = ~consists_of(text, f"^{_OTHER_SCRIPTS}") & text.rlike("|".join(scripts))
    # one range is read much faster than single letters; what else lies in it the pattern tells
    kana = ~consists_of(text, f"^{min(KANA_HAN)}-{max(KANA_HAN)}") & text.rlike(f"{before}|{after}")
    found = ~consists_of(text, _EVER_PLAIN) & (~consists_of(text, f"^{first[1:-1]}") | beside | kana)
    return F.coalesce(found, F.lit(False))

_SCRIPTS = {name: regex.compile(rf"\p{{{name}}}") for name in ("Latin", "Cyrillic", "Greek", "Armenian", "Cherokee")}
_WORD = regex.compile(r"[\p{Latin}\p{Cyrillic}\p{Greek}\p{Armenian}\p{Cherokee}]+")
_NOT_LATIN = regex.compile("[" + "".join(rf"\p{{{name}}}" for name in _SCRIPTS if name != "Latin") + "]")
_MIXED = regex.compile("|".join(rf"\p{{{name}}}[{''.join(rf'\p{{{other}}}' for other in _SCRIPTS if other != name)}]" for name in _SCRIPTS))
_KANA = regex.compile(r"(?<![぀-ヿ])[" + "".join(KANA_HAN) + r"](?![぀-ヿ])")
_HAN = regex.compile(r"[㐀-鿿]")
_KEPT = regex.compile(r"(?<=\p{Extended_Pictographic})️|(?<=[\p{Extended_Pictographic}️\U0001F3FB-\U0001F3FF])‍(?=\p{Extended_Pictographic})")
_EMOJI = regex.compile(r"\p{Extended_Pictographic}")


class UnionFind:
    """Disjoint sets of strings, with path halving and union by the smaller root."""

    def __init__(self):
        self.up: dict[str, str] = {}

    def find(self, a: str) -> str:
        up = self.up
        up.setdefault(a, a)
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    def union(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _compile(pattern: str) -> regex.Pattern:
    """The pattern with Java's ``\\x{...}`` spelled as the characters themselves."""
    return regex.compile(regex.sub(r"\\x\{(\w+)\}", lambda m: regex.escape(chr(int(m[1], 16))), pattern))


def _inside(pattern: str) -> list[str]:
    test = _compile(f"[{pattern}]")
    return [chr(c) for c in [*range(0x80, 0x10000), *range(0xE0000, 0xE1000)] if test.match(chr(c))]


def pairs() -> Iterator[tuple[str, str]]:
    """Pairs of the same look, by the rules of the Unicode tables and the fixed values above."""
    for c in [*range(0xC0, 0x3100), *range(0xF900, 0xFB00), *range(0x2F800, 0x2FA20)]:
        ch = chr(c)
        whole = unicodedata.normalize("NFC", ch)
        if whole != ch:
            yield ch, whole
            continue
        once = unicodedata.decomposition(ch)
        if once and not once.startswith("<"):
            yield "".join(chr(int(x, 16)) for x in once.split()), ch
            yield unicodedata.normalize("NFD", ch), ch
    for c in [*range(0x2F00, 0x2FE0), *range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B), *range(0xFF66, 0xFFA0)]:
        wide = unicodedata.normalize("NFKC", chr(c))
        if wide != chr(c):
            yield chr(c), wide
        for mark in "ﾞﾟ":
            if len(voiced := unicodedata.normalize("NFKC", chr(c) + mark)) == 1:
                yield chr(c) + mark, voiced
                yield wide + mark, voiced
    for k in range(0, len(RADICALS), 2):
        yield RADICALS[k], RADICALS[k + 1]
    for ch in _inside(_SPACE):
        yield ch, " "
    for ch in _inside(_INVISIBLE):
        yield ch, ""
    for latin, others in SAME_LOOK.items():
        for other in others:
            yield other, latin
    yield from KANA_HAN.items()


_CLASSES: dict[str, list[str]] = {}


def classes() -> dict[str, list[str]]:
    """Root to the members of each class of two or more."""
    if _CLASSES:
        return _CLASSES
    sets = UnionFind()
    for a, b in pairs():
        sets.union(a, b)
    out = defaultdict(list)
    for member in sets.up:
        out[sets.find(member)].append(member)
    _CLASSES.update({root: sorted(members) for root, members in out.items() if len(members) > 1})
    return _CLASSES


def script(member: str) -> str:
    """The script to which a member belongs once it is written plainly."""
    if member in ("", " "):
        return member
    plain = unicodedata.normalize("NFKC", dict(zip(RADICALS[::2], RADICALS[1::2])).get(member, member))
    if _IS_INVISIBLE.match(member):
        return ""
    if _IS_SPACE.match(member):
        return " "
    for name in ("Latin", "Cyrillic", "Greek", "Han", "Katakana", "Hiragana"):
        if regex.match(rf"\p{{{name}}}", plain):
            return name
    return "other"


_NOT_PLAIN = _compile(CANDIDATE.split("|")[0])
_IS_INVISIBLE, _IS_SPACE = _compile(f"[{_INVISIBLE}]"), _compile(f"[{_SPACE}]")


def plain_members(members: list[str]) -> list[str]:
    return [m for m in members if m == "" or (unicodedata.normalize("NFC", m) == m and not _NOT_PLAIN.search(m))]


def representatives(counts: dict[str, int]) -> dict[str, str]:
    """Each member that is not plain, to the plain member of its script that occurs most often."""
    out = {}
    for members in classes().values():
        plain = plain_members(members)
        for m in members:
            if m in plain or not plain:
                continue
            same = [p for p in plain if script(p) == script(m)] or plain
            out[m] = max(same, key=lambda p: (counts.get(p, 0), -len(p), [-ord(c) for c in p]))
    return out


def letters(table: dict[str, str]) -> dict[str, dict[str, str]]:
    """Script to a map of the look-alike letters of other scripts to its own."""
    out: dict[str, dict[str, str]] = {name: {} for name in _SCRIPTS}
    for latin, others in table.items():
        of = {ch: next(s for s, p in _SCRIPTS.items() if p.match(ch)) for ch in latin + others}
        for mine, name in of.items():
            out[name] |= {ch: mine for ch, s in of.items() if s != name and ch not in out[name]}
    return out


class Frequencies:
    """How often strings occur in the collection, in ``SKETCH`` numbers: those that share one are counted together."""

    def __init__(self, counts: np.ndarray | None = None):
        self.counts = np.zeros(SKETCH, np.int64) if counts is None else counts

    @staticmethod
    def place(string: str) -> int:
        h = 0
        for k, ch in enumerate(string, 1):
            h += (ord(ch) + 1) * pow(_FACTOR, k, 1 << 64)
        return int(Frequencies.places(np.array([h & ((1 << 64) - 1)], np.uint64))[0])

    @staticmethod
    def places(h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (((h ^ (h >> np.uint64(31))) * np.uint64(_MIX)) >> np.uint64(44)).astype(np.int64)

    def of(self, string: str) -> int:
        return int(self.counts[self.place(string)])


def _any_of(chars: set[str]) -> re.Pattern:
    """Runs of the characters; ``re`` looks each character up in a table."""
    code = sorted(map(ord, chars))
    starts = [c for c in code if chr(c - 1) not in chars]
    ends = [c for c in code if chr(c + 1) not in chars]
    return re.compile("[" + "".join(rf"\U{a:08x}-\U{e:08x}" for a, e in zip(starts, ends)) + "]+" if code else "(?!)")


class Rewriter:
    """Plain form of texts, for given representatives, script frequencies and frequencies of strings."""

    def __init__(self, rewrite: dict[str, str], scripts: dict[str, int], known: Frequencies | None = None):
        self.automaton = ahocorasick.Automaton()
        for member, to in rewrite.items():
            self.automaton.add_word(member, (len(member), to))
        self.automaton.make_automaton()
        self.telling = _any_of({m for m in rewrite if len(m) == 1} | {c for m in rewrite for c in m[1:]})
        self.scripts, self.known = scripts, known or Frequencies()
        self.same = letters(SAME_LOOK)
        similar = letters(SIMILAR_LOOK)
        self.similar = {name: {**similar[name], **self.same[name]} for name in _SCRIPTS}

    def _pass(self, text: str) -> str:
        kept = {m.start() for m in _KEPT.finditer(text)} if _EMOJI.search(text) else ()
        out, done = [], 0
        # a pattern is a telling character, or any character and telling ones: it lies in a run of these with the character before it
        for run in self.telling.finditer(text):
            begin = max(run.start() - 1, 0)
            for end, (n, to) in self.automaton.iter_long(text[begin : run.end()]):
                start = begin + end + 1 - n
                if start in kept:
                    continue
                out += [text[done:start], to]
                done = begin + end + 1
        return "".join(out) + text[done:] if done else text

    def spellings(self, word: str, own: list[str], tables: dict[str, dict[str, str]]) -> dict[str, str]:
        """Script to the word with all its letters in that script, where it has them."""
        out = {}
        for name in dict.fromkeys(own):
            spelled = [ch if s == name else tables[name].get(ch) for ch, s in zip(word, own)]
            if None not in spelled:
                out[name] = "".join(spelled)
        return out

    def _word(self, m: regex.Match) -> str:
        word = m[0]
        if word.isascii() or sum(bool(p.search(word)) for p in _SCRIPTS.values()) < 2:
            return word
        own = [next(s for s, p in _SCRIPTS.items() if p.match(ch)) for ch in word]
        # of the class of its spellings the most frequent one
        often, _, best = max(((self.known.of(w.lower()), -k, w) for k, w in enumerate(self.spellings(word, own, self.similar).values())), default=(0, 0, ""))
        if often >= KNOWN:
            return best
        sure, total = defaultdict(int), defaultdict(int)
        for ch, s in zip(word, own):
            total[s] += 1
            sure[s] += not any(ch in to for to in self.same.values())
        to = max(total, key=lambda s: (sure[s], total[s], self.scripts.get(s, 0)))
        return "".join(self.same[to].get(ch, ch) if s != to else ch for ch, s in zip(word, own))

    def _kana(self, m: regex.Match) -> str:
        text, a, e = m.string, m.start(), m.end()
        before, after, han = text[a - 1 : a], text[e : e + 1], KANA_HAN[m[0]]
        if not any(c and _HAN.match(c) for c in (before, after)):
            return m[0]
        often = [sum(self.known.of(p) for p in (before + ch, ch + after) if len(p) == 2 and _HAN.search(p.replace(ch, ""))) for ch in (m[0], han)]
        # the text itself is among the counted: a kana that is no slip stands there more than once
        return m[0] if often[0] > KNOWN * max(often[1], KNOWN) else han

    def plain(self, text: str) -> str:
        # what is rewritten may become part of a longer pattern; a pass that changes nothing is the last
        while _NOT_PLAIN.search(text) and (new := self._pass(text)) != text:
            text = new
        if _NOT_LATIN.search(text) and _MIXED.search(text):
            text = _WORD.sub(self._word, text)
        return _KANA.sub(self._kana, text)


def _count(members: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        single = np.array([ord(m) for m in members if len(m) == 1])
        total = np.zeros(0x110000, np.int64)
        longer: dict[str, int] = defaultdict(int)
        strings = np.zeros(SKETCH, np.int64)
        automaton = ahocorasick.Automaton()
        for m in members:
            if len(m) > 1:
                automaton.add_word(m, m)
        automaton.make_automaton()
        kind = np.zeros(0x110000, np.uint8)  # 1: letter of a word, 2: ideograph or kana of one look, 4: second part of a longer member
        kind[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250), *range(0x370, 0x590), *range(0x13A0, 0x1400), *range(0x1E00, 0x2000)]] = 1
        kind[[ord(c) for kv in KANA_HAN.items() for c in kv]] = 2
        kind[[ord(c) for m in members for c in m[1:]]] |= 4
        lower = np.array([ord(chr(c).lower()[0]) for c in range(0x2000)], np.uint64)
        power = back = np.zeros(0, np.uint64)
        for pdf in batches:
            joined = "\n".join(pdf["text"])
            cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            total += np.bincount(cp, minlength=0x110000)
            kinds = kind[cp]
            later = np.concatenate([[False], (kinds & 4) > 0, [False]])
            if later.any():
                # a longer member is a character and second parts: each run of these with the character before it
                edges = np.flatnonzero(later[1:] != later[:-1])
                runs = "\n".join(joined[max(a - 1, 0) : e] for a, e in zip(edges[::2].tolist(), edges[1::2].tolist()))
                for _, m in automaton.iter(runs):
                    longer[m] += 1
            with np.errstate(over="ignore"):
                at = np.flatnonzero(kinds & 1)
                if len(at):
                    if len(power) <= len(at):
                        power = np.multiply.accumulate(np.full(len(at) + 1, _FACTOR, np.uint64))
                        back = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(len(at) + 1, pow(_FACTOR, -1, 1 << 64), np.uint64))])
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((lower[cp[at]] + np.uint64(1)) * power[: len(at)], dtype=np.uint64)])
                    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
                    ends = np.concatenate([starts[1:], [len(at)]])
                    strings += np.bincount(Frequencies.places((sums[ends] - sums[starts]) * back[starts]), minlength=SKETCH)
                at = np.flatnonzero(kinds & 2)  # with the neighbour on either side
                for first in (at[at > 0] - 1, at[at < len(cp) - 1]):
                    h = (cp[first].astype(np.uint64) + np.uint64(1)) * np.uint64(_FACTOR) + (cp[first + 1].astype(np.uint64) + np.uint64(1)) * np.uint64(_FACTOR**2 % (1 << 64))
                    strings += np.bincount(Frequencies.places(h), minlength=SKETCH)
        found = single[total[single] > 0]
        places = np.flatnonzero(strings)
        if len(found) or longer or len(places):
            yield pd.DataFrame(
                {
                    "member": [chr(c) for c in found] + list(longer) + [None] * len(places),
                    "place": [-1] * (len(found) + len(longer)) + places.tolist(),
                    "n": [int(total[c]) for c in found] + list(longer.values()) + strings[places].tolist(),
                }
            )

    return run


def member_counts(texts: DataFrame) -> tuple[dict[str, int], Frequencies]:
    """How often each member of a class, and each string, occurs in all values.

    As many numbers reach the driver as there are members, and ``SKETCH`` more.
    """
    members = sorted({m for ms in classes().values() for m in ms if m})
    counted = texts.where(F.col("text").isNotNull()).select("text").mapInPandas(_count(members), "member string, place int, n long")
    found = counted.groupBy("member", "place").agg(F.sum("n").alias("n")).toPandas()
    strings = found["member"].isna()
    counts = np.zeros(SKETCH, np.int64)
    counts[found.loc[strings, "place"].to_numpy(np.int64)] = found.loc[strings, "n"].to_numpy(np.int64)
    return dict(zip(found.loc[~strings, "member"], found.loc[~strings, "n"].astype(int))), Frequencies(counts)


def _rewriting(rewrite: dict[str, str], scripts: dict[str, int], known: Frequencies):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = Rewriter(rewrite, scripts, known)
        for pdf in batches:
            yield pdf.assign(plain=[r.plain(t) for t in pdf["text"]])

    return run


def plain_forms(rows: DataFrame, changed_only: bool = False) -> DataFrame:
    """``(field, row_id, text, plain)`` of rows ``(field, row_id, text)``.

    Values that hold nothing that could look like something else never leave the
    JVM. Null texts stay null; an empty text is plain; repeated rows are kept.
    """
    rows = rows.select("field", "row_id", "text")
    counts, known = member_counts(rows)
    by_script: dict[str, int] = defaultdict(int)
    for m, n in counts.items():
        by_script[script(m)] += n
    odd = may_differ(F.col("text"))
    rewriting = _rewriting(representatives(counts), dict(by_script), known)
    done = map_keyed(rows.where(odd), rewriting, "field string, row_id long, text string, plain string", "row_id")
    if changed_only:
        return done.where("plain <> text")
    return done.unionAll(rows.where(~odd).withColumn("plain", F.col("text")))
