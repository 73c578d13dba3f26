"""Problem 6: text decoded with the wrong character encoding.

A wrong code page is a substitution cipher: each letter (or byte of a letter)
was replaced by the letter that the wrong page has in its place. The key of the
cipher is unknown and belongs to a source. Candidate keys are pairs of pages
(read as, written as), with pages of several bytes a letter among them, so that
the byte-to-letter mapping is a page's table and not thousands of free cells.

1. Language bigrams: hashed counts of adjacent characters in all running text,
   less those that lie in spans which a key restores to usual text.
2. For every value and key: the spans the key can read, translated, and the gain
   in bigram log-likelihood over the span as it stands.
3. Expectation-maximization per source: how probable each key (and no key) is,
   given the gains of all its values; a value's posterior then decides.
4. Values that no listed key explains, of letters of pages of one byte a letter:
   their source's cipher is learned cell by cell, which letter each of its signs
   stands for, by expectation-maximization of the pairs of signs against the
   bigrams of each alphabet.
5. The probable key's or the learned table is applied with ``translate()``; bytes are then read
   in the page in which they were written.

A character that stands for lost bytes (U+FFFD) belongs to no page; a value
that holds one was decoded wrongly whatever the rest says.
"""

from __future__ import annotations

import codecs
import math
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import cut_lineage, map_keyed

BUCKETS = 1 << 20
PAIRS = 1048573  # hashes of pairs, a prime
FIRSTS = 65521
UNSOUND = BUCKETS + FIRSTS  # buckets of sentences with unsound signs follow those of all others
DOUBT = 0.1  # weight of such a sentence where keys are judged, until it is known whether it is garbled
SMOOTH = 0.02
RARE = -12.5  # log of the share of all pairs below which a pair is rare
FLOOR = 2.0
SUREST = 0.3  # least surprise of a letter, on average
USUAL = -3.5  # mean log-probability of a character in text that reads well
FAIR = -5.5  # the same where the text has lost its unsound signs
GAIN_BIN = 0.5
SURE_GAIN = 100.0  # beyond it a gain makes no difference to a key's weight
PRIOR = 1e-4  # weight of a key in a source before anything is known of it
CLEAN = 50.0  # values of which nothing is known but the prior, per source
ROUNDS = 20
VALUES = -2  # in place of a key: the row counts the values of a source
SURE_OF_KEY = -math.log(PRIOR)  # gain that speaks for a key of which nothing else is known
DEBRIS = 8  # between two lost signs, fewer characters than these are what is left of others

KEPT = 50_000  # texts of at most so many characters that a task remembers, as many are repeated
KEPT_CHARS = 200

LEARNED_ROUNDS = 80
LEAST_CHANGED = 8  # letters of a value that a learned cipher must change
LEAST_PAIRS = 400  # pairs of signs of a source from which a cipher is learned
MOST_SIGNS = 128  # a page of one byte a letter has no more
#: Pages whose letters are the alphabets of which a cipher may be.
ALPHABETS = ["cp1251", "cp1252", "cp1253", "cp874"]

# Pages in which a text may have been written, and as which it may have been read.
WRITTEN = {
    "utf-8": ["cp1252", "cp1251", "koi8_r", "cp866", "cp437", "mac_roman", "cp874", "gb18030", "big5hkscs", "cp932"],
    "gb18030": ["cp1252", "cp1251", "koi8_r", "cp866", "cp932", "big5hkscs"],
    "big5hkscs": ["cp1252", "gb18030"],
    "cp932": ["cp1252", "gb18030"],
    "euc_jp": ["cp1252", "gb18030"],
    "cp1251": ["cp1252", "koi8_r", "cp866"],
    "koi8_r": ["cp1252", "cp1251"],
    "cp866": ["cp1252", "cp1251"],
    "cp874": ["cp1252"],
    "cp1252": ["cp1251"],
}
MULTI = {"gb18030", "big5hkscs", "cp932"}
KEYS = [(read, written) for written, reads in WRITTEN.items() for read in reads]
REVERSIBLE = [key for key in KEYS if key[::-1] in KEYS]
TWICE = ("cp1252", "utf-8")

_SHAPES = {
    "utf-8": r"(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})+",
    "gb18030": r"(?:[\xa1-\xf7][\xa1-\xfe])+",
    "big5hkscs": r"(?:[\xa1-\xf9][\x40-\x7e\xa1-\xfe])+",
    "cp932": r"(?:[\x81-\x9f\xe0-\xfc][\x40-\x7e\x80-\xfc]|[\xa1-\xdf])+",
    "euc_jp": r"(?:[\xa1-\xf4][\xa1-\xfe])+",
}
_SINGLE_SHAPE = r"[\x80-\xff]+"
_CONTROL = regex.compile(r"[\x00-\x1f\x7f-\x9f]")

# What a text must hold for a key to be tried on it.
_LATIN, _CYRILLIC, _EAST = r"[\x80-\u024f\u02c0-\u02df\u2010-\u203a\u20ac\u2122]", r"\p{Cyrillic}", r"[\u3000-\u9fff\uac00-\ud7a3\uff61-\uff9f]"
_SIGNS = {
    page: regex.compile(sign)
    for page, sign in {
        "cp1252": _LATIN, "mac_roman": _LATIN, "cp1251": _CYRILLIC, "koi8_r": _CYRILLIC, "cp866": _CYRILLIC,
        "cp874": r"\p{Thai}", "cp437": r"[\u2500-\u259f]", "gb18030": _EAST, "big5hkscs": _EAST, "cp932": _EAST,
    }.items()
}


# Tables that a task makes as it needs them. A cached function would be looked up by
# the package's name, which a worker need not have.
_TABLES: dict[tuple, object] = {}


def _once(make, *key):
    """What ``make`` returns for the key, made once in a task."""
    at = (make.__name__, *key)
    if at not in _TABLES:
        _TABLES[at] = make(*key)
    return _TABLES[at]


def table_of(page: str) -> dict[int, int]:
    """Letter to byte (as a Latin-1 code point) for the page's upper half, for ``translate()``.

    Bytes without a letter keep their own code point, as lenient readers do.
    """
    back = {b: b for b in range(0x80, 0x100)}
    for b in range(0x80, 0x100):
        try:
            back[ord(bytes([b]).decode(page))] = b
        except UnicodeDecodeError:
            continue
    return back


def _shape(written: str) -> regex.Pattern:
    return regex.compile(_SHAPES.get(written, _SINGLE_SHAPE))


class _Wide(dict):
    """Letter to its bytes in a page of several bytes a letter, filled as letters come."""

    def __init__(self, page: str):
        self.page = page

    def __missing__(self, ch: str) -> str:
        try:
            b = ch.encode(self.page).decode("latin-1")
        except UnicodeEncodeError:
            b = "\u0100"
        self[ch] = b
        return b


def _narrow(page: str) -> dict[int, int]:
    """``table_of`` with a stop for every other character below U+3100."""
    return {c: 0x100 for c in range(0x80, 0x3100)} | _once(table_of, page)


_LAST: dict[str, object] = {}


def as_bytes(text: str, read: str) -> tuple[str, list[int] | None]:
    """The bytes that were read as ``text``, as Latin-1, and where each letter starts if they vary in length.

    Those of the last text are kept, as keys of one page come one after another.
    """
    if _LAST.get("text") != text:
        _LAST.clear()
        _LAST["text"] = text
    if read not in _LAST:
        if read not in MULTI:
            _LAST[read] = (text.translate(_once(_narrow, read)), None)
        else:
            wide = _once(_Wide, read)
            parts = [wide[ch] for ch in text]
            _LAST[read] = ("".join(parts), list(accumulate(map(len, parts), initial=0)))
    return _LAST[read]


def spans(text: str, key: tuple[str, str], controls: bool = False) -> list[tuple[int, int, str]]:
    """``(start, end, original)`` of each span of ``text`` that the key can read, without control characters."""
    read, written = key
    out: list[tuple[int, int, str]] = []
    data, starts = as_bytes(text, read)
    for m in _once(_shape, written).finditer(data):
        a, e = m.span()
        if starts is not None:
            if e - a < 2:
                continue
            a2, e2 = bisect_left(starts, a), bisect_right(starts, e) - 1
            if e2 <= a2:
                continue
            skip = starts[a2] - a
            raw = m[0][skip : skip + starts[e2] - starts[a2]]
            a, e = a2, e2
        else:
            raw = m[0]
        try:
            original = raw.encode("latin-1").decode(written, "ignore" if starts is not None else "strict")
        except UnicodeDecodeError:
            continue
        if original and original != text[a:e] and (controls or not _CONTROL.search(original)):
            out.append((a, e, original))
    return out


class Bigrams:
    """Log-probabilities of a character after another, from hashed counts."""

    def __init__(self, buckets: np.ndarray, counts: np.ndarray, firsts: np.ndarray):
        n = max(1.0, float(counts.sum()))
        pair = np.zeros(BUCKETS, np.float64)
        pair[buckets] = counts
        self.joint = np.log(pair / n + 1e-9).astype(np.float32)
        scale = 1e6 / n  # the smoothing keeps its weight whatever the size of the collection
        self.pair = np.log(pair * scale + SMOOTH).astype(np.float32)
        self.first = np.log(firsts * scale + SMOOTH * 5000).astype(np.float32)

    def steps(self, text: str) -> np.ndarray:
        """Log-probability of each character after the one before it."""
        return self.steps_of(code_points(text))

    def steps_of(self, cp: np.ndarray) -> np.ndarray:
        """The ``steps`` of code points."""
        at = cp.astype(np.intp)  # the kind of number by which arrays are indexed
        return self.pair[pair_hash(at).astype(np.intp)] - self.first[first_hash(at[:-1])]

    def score(self, text: str) -> float:
        return float(self.steps(text).sum()) if len(text) > 1 else 0.0


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _hash_parts() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a code point adds to the hash of a pair as its first and as its second, and its own; all digits are one letter."""
    cp = np.arange(0x110000, dtype=np.int64)
    cp[48:58] = 48
    return (cp * 40503 % PAIRS).astype(np.uint32), (cp * 15731 % PAIRS).astype(np.uint32), (cp % FIRSTS).astype(np.int32)


def pair_hash(cp: np.ndarray) -> np.ndarray:
    first, second, _ = _once(_hash_parts)
    h = first[cp[:-1]]
    h += second[cp[1:]]
    np.minimum(h, h - np.uint32(PAIRS), out=h)  # below PAIRS the difference wraps around
    return h


def first_hash(cp: np.ndarray) -> np.ndarray:
    return _once(_hash_parts)[2][cp]


def _unsound_classes() -> np.ndarray:
    """Code point to the classes of ``unsound``, a bit each."""
    out = np.zeros(0x110000, np.uint8)
    out[[0xFFFD, *range(0x80, 0x85), *range(0x86, 0xA0)]] |= 1
    out[0xA1:0x100] |= 2
    out[0xFF61:0xFFA0] |= 4
    out[[*range(0xA0, 0xC0), 0x192, 0x201A]] |= 8  # after U+00C3
    out[0x430:0x450] |= 16
    out[0x410:0x430] |= 32
    return out


def unsound(cp: np.ndarray) -> np.ndarray:
    """Where characters begin that no page writes in running text, or not so many in a row."""
    kind = _once(_unsound_classes)[cp]
    out = (kind & 1) > 0
    four = kind[:-3] & kind[1:-2] & kind[2:-1] & kind[3:]
    out[:-3] |= (four & 6) > 0
    out[:-1] |= ((cp[:-1] == 0xC3) & ((kind[1:] & 8) > 0)) | (((kind[:-1] & 16) > 0) & ((kind[1:] & 32) > 0))
    return out


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each between line ends, and where each text begins."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return code_points("\n" + "\n".join(texts) + "\n"), 1 + np.cumsum(lengths + 1) - (lengths + 1)


def _end_signs() -> np.ndarray:
    """Code point to whether it ends a sentence wherever it stands; U+2026 and half-width stops are also letters read in a wrong page."""
    out = np.zeros(0x110000, bool)
    out[[ord(ch) for ch in "\n。．！？!?।"]] = True
    return out


def _unsound_sentences(texts: list[str]) -> dict[int, list[tuple[int, int]]]:
    """Of each text that holds anything ``unsound`` the places of the sentences that do."""
    cp, starts = _joined(texts)
    at = np.flatnonzero(unsound(cp))
    out: dict[int, list[tuple[int, int]]] = {}
    if not len(at):
        return out
    end = _once(_end_signs)[cp]
    end[:-1] |= (cp[:-1] == ord(".")) & ((cp[1:] == ord(" ")) | (cp[1:] == ord("\n")))
    ends = np.flatnonzero(end)
    bad = np.unique(np.searchsorted(ends, at))
    lo, hi = ends[bad - 1] + 1, ends[bad] + 1
    of = np.searchsorted(starts, lo, "right") - 1
    for i, a, e in zip(of.tolist(), (lo - starts[of]).tolist(), (hi - starts[of]).tolist()):
        out.setdefault(i, []).append((a, e))
    return out


def _without(text: str, gaps: list[tuple[int, int]]) -> str | None:
    pieces = [text[a:e].strip("\n") for a, e in zip([0, *(e for _, e in gaps)], [*(a for a, _ in gaps), None])]
    return "\n".join(p for p in pieces if p) or None


def sound_and_unsound_parts(texts: list[str]) -> tuple[list[str | None], list[tuple[int, str]]]:
    """The ``sound_parts`` of the texts, and each sentence that these leave out, with the number of its text."""
    sound: list[str | None] = list(texts)
    unsound: list[tuple[int, str]] = []
    for i, gaps in _unsound_sentences(texts).items():
        sound[i] = _without(texts[i], gaps)
        unsound += [(i, texts[i][a:e].strip("\n")) for a, e in gaps]
    return sound, unsound


def sound_parts(texts: list[str]) -> list[str | None]:
    """Of each text what is left without the sentences that hold anything ``unsound``, with a line end in their place; None if nothing is."""
    return sound_and_unsound_parts(texts)[0]


def sound_texts(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The ``sound_parts`` of the texts, and what ``_joined`` makes of them."""
    texts = [t for t in sound_parts(texts) if t is not None]
    return texts, *_joined(texts)


def _lost_signs() -> np.ndarray:
    """Code point to whether it stands for a byte that was lost or is no letter: nothing is known of what stood there."""
    return (_once(_unsound_classes) & 1) > 0


def known_pairs(cp: np.ndarray) -> np.ndarray:
    """Which pairs of adjacent characters hold no lost sign and lie in no debris, that is, fewer than ``DEBRIS`` characters between two lost signs."""
    at = np.flatnonzero(_once(_lost_signs)[cp])
    out = np.ones(len(cp) - 1, bool)
    if len(at):
        out[at - 1] = out[at] = False
        line = np.cumsum(cp == 10)
        near = np.flatnonzero((np.diff(at) <= DEBRIS) & (line[at[1:]] == line[at[:-1]]))
        for k in range(1, DEBRIS):
            out[np.minimum(at[near] + k, at[near + 1])] = False
    return out


class _Counts:
    """Pairs of characters and their firsts, by hash."""

    def __init__(self):
        self.pairs, self.firsts = np.zeros(BUCKETS, np.int64), np.zeros(FIRSTS, np.int64)

    def add(self, texts: list[str], sound: bool = False) -> None:
        cp, _ = _joined(texts)
        pairs, firsts = pair_hash(cp), first_hash(cp[:-1])
        if not sound:  # sound texts have no lost signs
            known = known_pairs(cp)
            pairs, firsts = pairs[known], firsts[known]
        for counts, at in ((self.pairs, pairs), (self.firsts, firsts)):
            if len(at) < len(counts) // 16:
                np.add.at(counts, at, 1)
            else:
                counts += np.bincount(at, minlength=len(counts))

    def frame(self, offset: int = 0) -> pd.DataFrame:
        at, first_at = np.flatnonzero(self.pairs), np.flatnonzero(self.firsts)
        return pd.DataFrame({"bucket": offset + np.concatenate([at, BUCKETS + first_at]), "n": np.concatenate([self.pairs[at], self.firsts[first_at]])})


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = _Counts()
    for pdf in batches:
        if len(pdf):
            counts.add(pdf["text"].tolist())
    yield counts.frame()


def _count_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """As ``_count``, with the ``unsound_parts`` counted by themselves, from the bucket ``UNSOUND`` on."""
    sound, rest = _Counts(), _Counts()
    for pdf in batches:
        if len(pdf):
            parts, apart = sound_and_unsound_parts(pdf["text"].tolist())
            sound.add([t for t in parts if t is not None], sound=True)
            if apart:
                rest.add([t for _, t in apart])
    yield pd.concat([sound.frame(), rest.frame(UNSOUND)])


def _of_buckets(found: pd.DataFrame) -> np.ndarray:
    both = np.zeros(BUCKETS + FIRSTS)
    both[found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
    return both


def _of_counts(pairs: np.ndarray, firsts: np.ndarray) -> Bigrams:
    at = np.flatnonzero(pairs)
    return Bigrams(at, pairs[at], firsts)


def learn_bigrams(texts: DataFrame) -> Bigrams:
    """Bigram counts of a one-column DataFrame ``text`` over all its rows, without what ciphers have put among them.

    Sentences with characters that no page writes in running text (lost bytes, C1
    controls and the like) are counted as well, but for pairs with a lost byte and
    what little stands between two. Until the keys have been tried on them they
    weigh less; where a key then explains such a sentence, all of it is taken off.
    A cipher of many values makes its own pairs usual. But what its key restores
    is usual too, which a sound text read by a key is not, however usual itself.
    The pairs that lie in such spans are taken off the counts. Where a key and
    its reverse both restore usual text, one's clean texts are the other's
    garbled ones (see ``plainer``). However large the collection, at most
    ``BUCKETS + FIRSTS`` numbers reach the driver at once.
    """
    texts = texts.where(F.col("text").isNotNull())
    found = texts.mapInPandas(_count_parts, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    sound, rest = _of_buckets(found[found["bucket"] < UNSOUND]), _of_buckets(found[found["bucket"] >= UNSOUND].assign(bucket=lambda x: x["bucket"] - UNSOUND))
    both, judge = sound + rest, sound + rest * DOUBT
    lm = _of_counts(judge[:BUCKETS], judge[BUCKETS:])
    counted = texts.mapInPandas(_count_spoiled(lm), "bucket int, keys int, text binary, n long")
    # a text that a key and its reverse both restore counts once, however often it is there
    once = counted.groupBy("bucket", "keys", "text").agg(F.sum("n").alias("n"))
    spoiled = cut_lineage(once.groupBy("bucket", "keys").agg(F.sum("n").alias("n"), F.count("text").alias("texts")))
    marks = {(-r["bucket"] - 1, r["keys"]): r["texts"] or r["n"] for r in spoiled.where("bucket < 0").collect()}
    of_key = [np.array([marks.get((what, k), 0) for what in range(10)]).reshape(2, 5) for k in range(len(REVERSIBLE))]
    guilty = 1  # what no reverse speaks for
    for k, key in enumerate(REVERSIBLE):
        here, back = of_key[k], of_key[REVERSIBLE.index(key[::-1])]
        # a cipher makes unsound texts of sound ones, so these count as texts only where there are no others
        others = 1 if here[0, 0] and back[0, 0] else 2
        here, back = ([int(x[:others, 0].sum()), *x[:, 1:].sum(0).tolist()] for x in (here, back))
        if not back[0] or plainer(here, back):
            guilty |= 2 << k
    less = spoiled.where((F.col("bucket") >= 0) & (F.col("keys").bitwiseAND(F.lit(guilty)) != 0)).groupBy("bucket").agg(F.sum("n").alias("n"))
    both = np.maximum(both - _of_buckets(less.toPandas()), 0)
    return _of_counts(both[:BUCKETS], both[BUCKETS:])


def plainer(of_key: list[int], back: list[int]) -> bool:
    """Whether the spans of a key are the garbled ones, and not those of its reverse.

    Of each: different texts; common and all ideographs as they stand; the same as restored.
    Of ideographs, the common ones are more in what was written; otherwise the
    more different texts are clean.
    """
    texts, common_read, read, common_written, written = of_key
    if read and written:
        return common_written / written > common_read / read
    return texts < back[0]


_UNDECODED = "\udfff"  # in place of bytes that are no letter; no page has it


def _byte_classes(written: str) -> tuple[np.ndarray, ...]:
    """Which bytes may be the first and the second of a letter of two bytes, and which a letter of one, as in ``_SHAPES``."""
    inside = lambda *ranges: np.isin(np.arange(256), [b for lo, hi in ranges for b in range(lo, hi + 1)])
    return {
        "gb18030": (inside((0xA1, 0xF7)), inside((0xA1, 0xFE)), inside()),
        "big5hkscs": (inside((0xA1, 0xF9)), inside((0x40, 0x7E), (0xA1, 0xFE)), inside()),
        "cp932": (inside((0x81, 0x9F), (0xE0, 0xFC)), inside((0x40, 0x7E), (0x80, 0xFC)), inside((0xA1, 0xDF))),
        "euc_jp": (inside((0xA1, 0xF4)), inside((0xA1, 0xFE)), inside()),
    }[written]


def _those_of(raw: bytes, kind: np.ndarray) -> np.ndarray:
    """Which bytes are of the kind."""
    return np.frombuffer(bytearray(raw.translate(kind.tobytes())), bool)


def shaped(data: np.ndarray, written: str) -> np.ndarray:
    """Which bytes lie in a match of the page's shape; each run of them is one match of ``_shape(written)``."""
    if written == "utf-8":
        more = np.zeros(len(data) + 3, bool)
        more[:-3] = (data >= 0x80) & (data < 0xC0)
        two, three = more[1:-2] & (data >= 0xC2), more[2:-1]
        out = np.zeros(len(data) + 3, bool)
        for n, begins in ((2, two & (data < 0xE0)), (3, two & three & (data >= 0xE0) & (data < 0xF0)), (4, two & three & more[3:] & (data >= 0xF0) & (data <= 0xF4))):
            if begins.any():
                for k in range(n):
                    out[k : k + len(data)] |= begins
        return out[: len(data)]
    if written not in _SHAPES:
        return data >= 0x80
    first, second, single = _once(_byte_classes, written)
    raw = data.tobytes()
    pair = _those_of(raw, first)
    pair[:-1] &= _those_of(raw, second)[1:]
    pair[-1:] = False
    # a letter is read from the start of each run of possible first bytes: the byte after a run is none
    rise = pair.copy()
    rise[1:] &= ~pair[:-1]
    begins = np.flatnonzero(rise)
    if len(begins):
        odd = np.zeros(len(data), bool)
        odd[1::2] = True
        pair[begins[0] :] &= odd[begins[0] :] == np.repeat(odd[begins], np.diff(begins, append=len(data)))
    out = pair.copy()
    out[1:] |= pair[:-1]
    return out | _those_of(raw, single) if single.any() else out


def _narrow_bytes(page: str) -> np.ndarray:
    """Code point to its byte in the page, 0 where there is none."""
    out = np.zeros(0x110000, np.uint8)
    out[:0x80] = np.arange(0x80)
    for c, b in _once(_narrow, page).items():
        if b < 0x100:
            out[c] = b
    return out


def _wide_bytes(page: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code point below U+10000 to its bytes in the page, a single 0 where there are none, in four places, which of these are in use, and how many."""
    each = "\n".join(map(chr, range(0x10000))).encode(page, "replace").split(b"\n")
    each[10:12] = [b"\n"]  # the line end itself was split in two
    rows = np.array(each, "S4").view(np.uint8).reshape(-1, 4).copy()
    rows[(rows[:, 0] == 0x3F) & (np.arange(0x10000) != 0x3F)] = 0
    used = (rows > 0) | (np.arange(4) == 0)
    return rows, used, used.sum(1)


def bytes_of(cp: np.ndarray, read: str) -> tuple[np.ndarray, np.ndarray | None]:
    """The bytes that were read as the code points, and where each letter starts (and the last ends) if they vary in length."""
    if read not in MULTI:
        return _once(_narrow_bytes, read)[cp], None
    rows, used, sizes = _once(_wide_bytes, read)
    if cp.max(initial=0) > 0xFFFF:
        beyond, at = np.unique(cp[cp > 0xFFFF], return_inverse=True)
        each = [chr(c).encode(read, "ignore") or b"\0" for c in beyond.tolist()]
        rows = np.concatenate([rows, np.array(each, "S4").view(np.uint8).reshape(-1, 4)])
        used = np.concatenate([used, np.array([[k < len(b) for k in range(4)] for b in each])])
        sizes = np.concatenate([sizes, np.array([len(b) for b in each])])
        cp = cp.copy()
        cp[cp > 0xFFFF] = 0x10000 + at
    four = used.view(np.uint32)[cp, 0]  # the four places of a letter at once
    data = rows.view(np.uint32)[cp, 0].view(np.uint8)[four.view(bool)]
    return data, np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes[cp])])


def _undecoded(e: UnicodeDecodeError) -> tuple[str, int]:
    return _UNDECODED, e.end


Read = tuple[np.ndarray, "np.ndarray | None", "np.ndarray | None"]


def read_as(cp: np.ndarray, read: str) -> Read:
    """What ``restorable`` needs of a page: bytes, starts of letters, and the letter of each byte."""
    data, starts = bytes_of(cp, read)
    if starts is None:
        return data, None, None
    letter = np.zeros(len(data) + 1, np.int32)
    letter[starts[1:]] = 1
    return data, starts, np.cumsum(letter, dtype=np.int32)


def readable(bytes_read: Read, written: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where the spans begin and end, as in ``spans``, whatever they are read as: their letters and their bytes."""
    data, starts, letter = bytes_read
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = shaped(data, written)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    lo, hi = edges[::2], edges[1::2]
    a, e = lo, hi
    if starts is not None:
        wide = hi - lo >= 2
        lo, hi = lo[wide], hi[wide]
        a, e = letter[lo], letter[hi]
        a = a + (starts[a] != lo)
        whole = e > a
        a, e = a[whole], e[whole]
        lo, hi = starts[a], starts[e]
    return a, e, lo, hi


def read_again(bytes_read: Read, written: str, lo: np.ndarray, hi: np.ndarray) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The spans of bytes in the page in which they were written, in a row between two line ends each; its code points, and where these line ends are."""
    data, starts, _ = bytes_read
    taken = np.zeros(len(data) + 1, np.int8)
    taken[lo] = 1
    taken[hi] -= 1
    last = np.cumsum(hi - lo + 2) - 1
    filled = np.ones(int(last[-1]) + 1, bool)
    filled[last] = filled[last[:-1] + 1] = filled[0] = False
    row = np.full(len(filled), 10, np.uint8)
    row[filled] = data[np.cumsum(taken[:-1], dtype=np.int8).view(bool)]
    if starts is None:
        codecs.register_error("lexmill.undecoded", _undecoded)
    text = row.tobytes().decode(written, "lexmill.undecoded" if starts is None else "ignore")
    q = code_points(text).copy()
    ends = np.flatnonzero(q == 10)
    return text, q, ends[::2], ends[1::2]


def restorable(cp: np.ndarray, bytes_read: Read, written: str, lm: Bigrams) -> list[tuple[int, int, str]]:
    """``(start, end, original)`` of the spans, as in ``spans``, that read well once they are restored.

    ``cp`` has code points of any number of texts between line ends; no shape has a line end.
    """
    a, e, lo, hi = readable(bytes_read, written)
    if not len(a):
        return []
    text, q, left, right = read_again(bytes_read, written, lo, hi)
    q[left], q[right] = cp[a - 1], cp[e]  # its neighbours beside each span
    # beside a lost sign nothing speaks for or against the first or the last letter
    lost = _once(_lost_signs)
    begins, stops = left + lost[q[left]], right - lost[q[right]]
    sums = np.zeros(len(q))
    np.cumsum(lm.steps_of(q), out=sums[1:])
    steps = stops - begins
    well = (sums[stops] - sums[begins] >= USUAL * steps) & (steps > np.where(steps < right - left, 2, 1))
    at = np.flatnonzero(well)
    differs = right[at] - left[at] - 1 != e[at] - a[at]
    if len(alike := at[~differs]):  # many are signs that two pages have in the same place
        n = e[alike] - a[alike]
        begins = np.cumsum(n) - n
        inside = np.arange(n.sum()) - np.repeat(begins, n)
        differs[~differs] = np.logical_or.reduceat(cp[np.repeat(a[alike], n) + inside] != q[np.repeat(left[alike] + 1, n) + inside], begins)
    out = []
    for k in at[differs].tolist():
        original = text[left[k] + 1 : right[k]]
        if _UNDECODED not in original and not _CONTROL.search(original):
            out.append((int(a[k]), int(e[k]), original))
    return out


def _sign_classes() -> tuple[list[regex.Pattern], np.ndarray]:
    """The different patterns of ``_SIGNS``, and code point to those that it matches, a bit each."""
    every = "".join(chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000)
    signs, out = list(dict.fromkeys(_SIGNS.values())), np.zeros(0x110000, np.uint8)
    for k, sign in enumerate(signs):
        out[[ord(ch) for ch in sign.findall(every)]] |= 1 << k
    return signs, out


def beside_upper(data: np.ndarray) -> np.ndarray:
    """Where the bytes of the upper half are, and those that a span or its neighbours may need of the others.

    A letter begins with such a byte, so a span ends at the latest with the byte
    after one. What is left out lies between two neighbours of spans, of which none
    begins a letter: the same spans begin and end at the same bytes without it.
    """
    upper = data >= 0x80
    near = upper.copy()
    near[:-1] |= upper[1:]
    near[1:] |= upper[:-1]
    near[2:] |= upper[:-2]
    return np.flatnonzero(near)


def tried_keys(cp: np.ndarray, starts: np.ndarray) -> Iterator[tuple[tuple[str, str], np.ndarray, np.ndarray, Read]]:
    """Each key with the places of the texts on which it is to be tried, their code points, and what ``read_as`` makes of them.

    Of a page of one byte a letter only the places ``beside_upper`` are given.
    """
    signs, of_char = _once(_sign_classes)
    has = np.bitwise_or.reduceat(of_char[cp], starts)
    sizes = np.diff(np.append(starts, len(cp)))
    for k, sign in enumerate(signs):
        tried = (has & (1 << k)) > 0
        if not tried.any():
            continue
        place = np.flatnonzero(np.concatenate([[True], np.repeat(tried, sizes)]))  # the first line end, and each text with the one after it
        some = cp[place]
        for page in [page for page in _SIGNS if _SIGNS[page] is sign]:
            of_page, chars, bytes_read = place, some, read_as(some, page)
            if page not in MULTI:
                near = beside_upper(bytes_read[0])
                of_page, chars, bytes_read = place[near], some[near], (bytes_read[0][near], None, None)
            for key in KEYS:
                if key[0] == page:
                    yield key, of_page, chars, bytes_read


def spoiled_spans(cp: np.ndarray, starts: np.ndarray, lm: Bigrams) -> dict[tuple[str, str], list[tuple[int, int, str]]]:
    """The spans of each key in all the texts that read well once they are restored."""
    out: dict[tuple[str, str], list[tuple[int, int, str]]] = {}
    for key, place, some, bytes_read in tried_keys(cp, starts):
        if found := restorable(some, bytes_read, key[1], lm):
            out[key] = [(int(place[a]), int(place[e - 1]) + 1, original) for a, e, original in found]
    return out


class Spans(NamedTuple):
    """The spans of a key in texts between line ends, in order."""

    of: np.ndarray  # number of the text
    start: np.ndarray
    end: np.ndarray
    old: np.ndarray  # log-likelihood as it stands
    new: np.ndarray  # and restored
    size: np.ndarray  # letters of the original
    sound: np.ndarray  # whether the original holds nothing unsound
    text: str  # all originals
    at: np.ndarray  # where in it each begins


def _unreadable_signs() -> np.ndarray:
    """Code point to whether no original may hold it."""
    out = np.zeros(0x110000, bool)
    out[[*range(0x20), *range(0x7F, 0xA0), ord(_UNDECODED)]] = True
    return out


def all_spans(cp: np.ndarray, starts: np.ndarray, lm: Bigrams, wanted: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, Spans]]:
    """The ``spans`` of each key in all the texts of which ``wanted`` is true, given their starts, ends and log-likelihoods as they stand."""
    sums = np.zeros(len(cp))
    np.cumsum(lm.steps_of(cp), out=sums[1:])
    for key, place, some, bytes_read in tried_keys(cp, starts):
        a, e, lo, hi = readable(bytes_read, key[1])
        start, end = place[a], place[e - 1] + 1
        old = sums[end] - sums[start - 1]
        if not (kept := wanted(start, end, old)).any():
            continue
        a, e, lo, hi, start, end, old = (x[kept] for x in (a, e, lo, hi, start, end, old))
        text, q, left, right = read_again(bytes_read, key[1], lo, hi)
        inside = np.arange(len(q)) - np.repeat(left, right - left + 1)  # place in its span, the line end before it being 0
        of = np.repeat(np.arange(len(left)), right - left + 1)
        unreadable, odd = _once(_unreadable_signs)[q], unsound(q)
        unreadable[left] = unreadable[right] = False
        same = some[np.minimum(a[of] + inside - 1, len(some) - 1)] == q
        same[left] = same[right] = True
        same = (np.bincount(of, ~same, len(left)) == 0) & (right - left - 1 == e - a)
        readable_ = (right > left + 1) & ~same & (np.bincount(of, unreadable, len(left)) == 0)
        sound = np.bincount(of, odd, len(left)) == 0
        q[left], q[right] = some[a - 1], some[e]
        steps = lm.steps_of(q)
        steps[right[:-1]] = 0
        # added up span by span: what two keys read alike is as likely by both, to the last bit
        new = np.bincount(of[:-1], steps, len(left))
        if readable_.any():
            text_of = np.searchsorted(starts, start, "right") - 1
            columns = (text_of, start, end, old, new, right - left - 1, sound)
            yield KEYS.index(key), Spans(*(x[readable_] for x in columns), text, left[readable_] + 1)


def key_bit(key: tuple[str, str]) -> int:
    """The key's bit in ``_count_spoiled``."""
    return 2 << REVERSIBLE.index(key) if key in REVERSIBLE else 1


def freeing_keys(texts: list[str], lm: Bigrams) -> list[int]:
    """Of each text a key that makes fair text without unsound signs of a span that holds some (-1: none)."""
    out = [-1] * len(texts)
    if not texts:
        return out
    cp, starts = _joined(texts)
    before = np.concatenate([[0], np.cumsum(unsound(cp) & (cp != 0xFFFD))])
    for k, s in all_spans(cp, starts, lm, lambda start, end, old: before[end] > before[start]):
        for i in set(s.of[s.sound & (s.new >= FAIR * (s.size + 1))].tolist()):
            out[i] = min(k, out[i]) if out[i] >= 0 else k
    return out


def _count_spoiled(lm: Bigrams):
    """Of each bucket how many lie in spans of which keys, and of the reversible keys what ``plainer`` asks for.

    Keys are bits: one for all that have no reverse, then one for each that has.
    What ``plainer`` asks for has the bucket ``-1 - k`` and the key itself.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        without: set[str] = set()  # texts that hold no such span
        for pdf in batches:
            stored = Counter(t for t in pdf["text"] if t not in without)
            times: Counter[str] = Counter()
            often = list(stored.values())
            parts, apart = sound_and_unsound_parts(list(stored))
            for part, n in zip(parts, often):
                if part is not None:
                    times[part] += n
            first = len(times)
            for i, part in apart:  # none of these is a sound part
                times[part] += often[i]
            texts = list(times)
            if not texts:
                continue
            cp, starts = _joined(texts)
            doubted = range(first, len(texts))
            found = spoiled_spans(cp, starts, lm)
            # of which text each span is
            of_text = {key: (np.searchsorted(starts, [a for a, _, _ in of_key], "right") - 1).tolist() for key, of_key in found.items()}
            # unsound sentences that a key explains are garbled as a whole
            spoiled = set().union(*of_text.values())
            whole = dict.fromkeys(doubted, 0)
            known, beyond = known_pairs(cp), cp > 127
            told = known & (beyond[:-1] | beyond[1:])  # pairs that could tell garbled text
            asked_of = [i for i in doubted if i not in spoiled and told[starts[i] - 1 : starts[i] + len(texts[i])].any()]
            freeing = dict(zip(asked_of, freeing_keys([texts[i] for i in asked_of], lm)))
            rest = [i for i in asked_of if freeing[i] < 0]
            freeing |= {i: best if g > SURE_OF_KEY else -1 for i, (g, best, _) in zip(rest, best_keys([texts[i] for i in rest], lm))}
            whole |= {i: key_bit(KEYS[k]) for i, k in freeing.items() if k >= 0}
            spoiled.update(i for i, bits in whole.items() if bits)
            if len(without) > KEPT:
                without.clear()
            without.update({t for t in texts if len(t) <= KEPT_CHARS}.difference(texts[i] for i in spoiled))
            if not spoiled:
                continue
            often = np.array([times[t] for t in texts])
            pairs, firsts, asked = np.zeros(len(cp), np.int32), np.zeros(len(cp), np.int32), []
            for key, of_key in found.items():
                bit = key_bit(key)
                for a, e, _ in of_key:
                    pairs[a - 1 : e] |= bit
                    firsts[a:e] |= bit
                for i in set(of_text[key]).intersection(doubted):
                    whole[i] |= bit
                if bit > 1:
                    k, counts = REVERSIBLE.index(key), [0] * 10
                    for (a, e, original), i in zip(of_key, of_text[key]):
                        for part, at in ((map(chr, cp[a:e].tolist()), 6 if i in whole else 1), (original, 8 if i in whole else 3)):
                            wide = [_once(common, ch) for ch in part if "㐀" <= ch <= "鿿"]
                            counts[at] += sum(wide) * times[texts[i]]
                            counts[at + 1] += len(wide) * times[texts[i]]
                    asked += [(-1 - what, k, None, n) for what, n in enumerate(counts) if n]
                    asked += [(-6 if i in whole else -1, k, blake2b(texts[i].encode("utf-8", "surrogatepass"), digest_size=16).digest(), 0) for i in set(of_text[key])]
            for i, bits in whole.items():
                a, e = starts[i], starts[i] + len(texts[i])
                pairs[a - 1 : e] |= bits
                firsts[a:e] |= bits
            for marked, hashes, offset, second in ((pairs[:-1], pair_hash(cp), 0, 1), (firsts, first_hash(cp), BUCKETS, 0)):
                at = np.flatnonzero((marked[: len(known)] > 0) & known)
                of, place = np.unique(hashes[at].astype(np.int64) << 32 | marked[at], return_inverse=True)
                n = np.bincount(place, often[np.searchsorted(starts, at + second, "right") - 1]).astype(np.int64)
                asked += zip((offset + (of >> 32)).tolist(), (of & 0xFFFFFFFF).tolist(), [None] * len(of), n.tolist())
            yield pd.DataFrame(asked, columns=["bucket", "keys", "text", "n"])

    return run


def common(ch: str) -> bool:
    """Whether an ideograph is in the first level, that of the common ones, of a page."""
    for page, low, high in (("gb2312", 0xB0, 0xD7), ("big5", 0xA4, 0xC6), ("shift_jis", 0x88, 0x97)):
        try:
            if low <= ch.encode(page)[0] <= high:
                return True
        except UnicodeEncodeError:
            continue
    return False


def replaced(text: str, found: list[tuple[int, int, str]]) -> str:
    out, done = [], 0
    for a, e, original in found:
        out += [text[done:a], original]
        done = e
    return "".join(out) + text[done:]


def reread(text: str, key: tuple[str, str], controls: bool) -> str:
    return replaced(text, spans(text, key, controls))


def best_keys(texts: list[str], lm: Bigrams) -> list[tuple[float, int, str]]:
    """Of each text the largest gain in log-likelihood over the spans that gain, its key (-1: none) and what it restores.

    A key is tried on all texts at once, on the spans that read badly as they
    stand. A text that went the same wrong way twice is read twice.
    """
    if not texts:
        return []
    cp, starts = _joined(texts)
    tries: list[list[tuple[float, int, float]]] = [[] for _ in texts]
    gaining: dict[int, Spans] = {}
    for k, s in all_spans(cp, starts, lm, lambda start, end, old: old <= USUAL * (end - start + 1)):
        gains = s.new - s.old > FLOOR
        # what the key could gain if each letter were as sure as can be
        most = np.bincount(s.of, -s.old - s.size * SUREST, len(texts))
        total = np.bincount(s.of, np.where(gains, s.new - s.old, 0), len(texts))
        at = np.unique(s.of)
        for i, m, g in zip(at.tolist(), most[at].tolist(), total[at].tolist()):
            tries[i].append((-m, k, g))
        gaining[k] = Spans(*(x[gains] if isinstance(x, np.ndarray) else x for x in s))
    best = []
    for of_text in tries:
        g, k = 0.0, -1
        for least, tried, now in sorted(of_text):
            if -least <= g:
                break
            if now > g:
                g, k = now, tried
        best.append((g, k))
    chosen, begins = np.array([k for _, k in best]), starts.tolist()
    pieces: dict[int, list[tuple[int, int, str]]] = {}
    for k, s in gaining.items():
        here = np.flatnonzero(chosen[s.of] == k)
        for i, a, e, at, n in zip(*(x[here].tolist() for x in (s.of, s.start, s.end, s.at, s.size))):
            pieces.setdefault(i, []).append((a - begins[i], e - begins[i], s.text[at : at + n]))
    out = [(g, k, replaced(text, pieces.get(i, []))) for i, (text, (g, k)) in enumerate(zip(texts, best))]
    for i, text in enumerate(texts):
        if "\u00c3" in text:
            t = reread(reread(text, TWICE, True), TWICE, False)
            if t != text and (g := lm.score(f"\n{t}\n") - float(np.sum(lm.steps(f"\n{text}\n"), dtype=np.float64))) > out[i][0]:
                out[i] = (g, KEYS.index(TWICE), t)
    return out


def suspects(texts: list[str], lm: Bigrams) -> np.ndarray:
    """Which texts have two adjacent rare pairs around a character beyond ASCII."""
    cp = code_points("\n".join(texts) + "\n")
    rare = lm.joint[pair_hash(cp)] < RARE
    twice = rare[:-1] & rare[1:] & ((cp[1:-1] > 127) | (cp[:-2] > 127) | (cp[2:] > 127))
    ends = np.cumsum([len(t) + 1 for t in texts])
    total = np.concatenate([[0], np.cumsum(twice)])
    stops = np.minimum(ends, len(twice))
    return total[stops] - total[np.concatenate([[0], stops[:-1]])] > 0


_ONE_BYTE, _EASTERN = regex.compile(r"[\u0080-\u25ff]{2}"), regex.compile(r"[\u2e80-\uffef\U00020000-\U0003ffff]")


def _analyse(lm: Bigrams):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            odd: dict[int, list[int]] = {}
            texts = pdf["text"].tolist()
            if texts:
                at = np.flatnonzero(suspects(texts, lm))
                lines = [(r, k, line) for r in at for k, line in enumerate(texts[r].split("\n"))]
                if lines:
                    for i in np.flatnonzero(suspects([line for _, _, line in lines], lm)):
                        odd.setdefault(lines[i][0], []).append(lines[i][1])
            lost = pdf["lost"].to_numpy(bool)
            for source, n in pdf["source"].value_counts().items():
                out.append((None, source, False, VALUES, float(n), None, None))
            rows = sorted(odd.keys() | set(np.flatnonzero(lost)))
            split = [texts[r].split("\n") for r in rows]
            odd_texts = ["\n".join(lines[i] for i in odd.get(r, [])) for r, lines in zip(rows, split)]
            for r, lines, odd_text, (g, k, restored) in zip(rows, split, odd_texts, best_keys(odd_texts, lm)):
                at = odd.get(r, [])
                unexplained = k < 0 and not lost[r] and bool(_ONE_BYTE.search(odd_text)) and not _EASTERN.search(odd_text)
                if lost[r] or k >= 0 or unexplained:
                    for i, line in zip(at, restored.split("\n")):
                        lines[i] = line
                    out.append((pdf["row_id"].iloc[r], pdf["source"].iloc[r], bool(lost[r]), k, g, "\n".join(lines), odd_text if unexplained else None))
            yield pd.DataFrame(out, columns=["row_id", "source", "lost", "key", "gain", "restored", "odd"])

    return run


def alphabet(page: str) -> str:
    """The letters of a page's upper half."""
    letters = bytes(range(0x80, 0x100)).decode(page, "ignore")
    return "".join(ch for ch in letters if ch.isalpha() or regex.match(r"\p{M}", ch))


class Pairs:
    """Log-likelihoods of pairs of given letters, from the bigrams of the collection."""

    def __init__(self, lm: Bigrams, letters: str):
        cp = np.array([ord(c) for c in letters])
        ascii_ = np.arange(0x20, 0x7F)
        n = np.exp(lm.first[first_hash(cp)].astype(float))
        self.single = n / n.sum()
        at = lambda a, b: np.exp(lm.pair[(a[:, None] * 40503 + b[None, :] * 15731) % PAIRS].astype(float))
        self.both, self.before, self.after = at(cp, cp), at(ascii_, cp), at(cp, ascii_)
        for table in (self.both, self.before, self.after):
            table /= table.sum()


def learn_cells(signs: str, both: np.ndarray, before: np.ndarray, after: np.ndarray, lm: Bigrams, letters: str) -> tuple[str, float]:
    """The letter for which each sign stands, and the mean log-likelihood of a pair.

    ``both[x, y]`` counts sign x before sign y, ``before[s, y]`` and
    ``after[x, s]`` count signs beside ASCII characters, which stand for themselves.
    The emission of a letter is learned from what all pairs make of it.
    """
    known = Pairs(lm, letters)
    often = both.sum(0) + both.sum(1) + before.sum(0) + after.sum(1)
    often = often / often.sum()
    # at first, letters stand for signs that are about as frequent
    emit = np.exp(-np.abs(np.log(known.single + 1e-6)[:, None] - np.log(often + 1e-6)[None, :])) * often
    emit /= emit.sum(1, keepdims=True)
    total, score = both.sum() + before.sum() + after.sum(), -np.inf
    for _ in range(LEARNED_ROUNDS):
        d_both, d_before, d_after = emit.T @ known.both @ emit + 1e-30, known.before @ emit + 1e-30, emit.T @ known.after + 1e-30
        score = (both * np.log(d_both)).sum() + (before * np.log(d_before)).sum() + (after * np.log(d_after)).sum()
        r_both = both / d_both
        cells = emit * (known.both @ emit @ r_both.T + known.both.T @ emit @ r_both + known.before.T @ (before / d_before) + known.after @ (after / d_after).T)
        emit = (cells + 1e-3 * often) / (cells + 1e-3 * often).sum(1, keepdims=True)
    return "".join(letters[k] for k in (emit * known.single[:, None]).argmax(0)), float(score / max(total, 1))


_PAIRED = regex.compile(r"[\x20-\x7e\u0080-\u25ff]", regex.S)


def _count_signs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How often two characters stand beside each other in the values of a source, one of them beyond ASCII."""
    counts: dict[tuple[str, str, str], int] = {}
    for pdf in batches:
        for source, text in zip(pdf["source"], pdf["odd"]):
            for x, y in zip(text, text[1:]):
                if (x > "\x7f" or y > "\x7f") and _PAIRED.match(x) and _PAIRED.match(y):
                    counts[source, x, y] = counts.get((source, x, y), 0) + 1
        if len(counts) > 500_000:
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["source", "x", "y", "n"])
            counts = {}
    if counts:  # an empty frame has no types
        yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["source", "x", "y", "n"])


def _learn_source(lm: Bigrams):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"source": [""], "signs": [""], "letters": [""], "alphabet": [0]}).head(0)
        signs = "".join(sorted({ch for ch in [*pdf["x"], *pdf["y"]] if ch > "\x7f"}))
        if not 8 <= len(signs) <= MOST_SIGNS or pdf["n"].sum() < LEAST_PAIRS:
            return none
        at = {ch: k for k, ch in enumerate(signs)}
        both, before, after = np.zeros((len(signs), len(signs))), np.zeros((95, len(signs))), np.zeros((len(signs), 95))
        for x, y, n in zip(pdf["x"], pdf["y"], pdf["n"]):
            if x in at and y in at:
                both[at[x], at[y]] += n
            elif y in at:
                before[ord(x) - 0x20, at[y]] += n
            else:
                after[at[x], ord(y) - 0x20] += n
        tried = [(learn_cells(signs, both, before, after, lm, alphabet(page)), k) for k, page in enumerate(ALPHABETS)]
        (letters, _), k = max(tried, key=lambda x: x[0][1])
        return pd.DataFrame({"source": [key[0]], "signs": [signs], "letters": [letters], "alphabet": [k]})

    return run


def _decipher(lm: Bigrams):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row_id, source, odd, whole, signs, letters, k in zip(*(pdf[c] for c in ("row_id", "source", "odd", "restored", "signs", "letters", "alphabet"))):
                table, before = str.maketrans(signs, letters), odd
                plain = before.translate(table)
                new, old = lm.score(f"\n{plain}\n"), lm.score(f"\n{before}\n")
                signs_here = sum(ch > "\x7f" for ch in before)
                changed = sum(a != b for a, b in zip(before, plain))
                # a cipher changes most letters of a value; a few odd ones in a sound text are none
                if changed >= max(LEAST_CHANGED, signs_here / 2) and new - old > FLOOR * changed / 2 and new >= USUAL * (len(plain) + 1) > old:
                    lines = set(before.split("\n"))
                    restored = "\n".join(line.translate(table) if line in lines else line for line in whole.split("\n"))
                    out.append((row_id, source, len(KEYS) + int(k), restored))
            yield pd.DataFrame(out, columns=["row_id", "source", "key", "restored"])

    return run


def deciphered(unexplained: DataFrame, lm: Bigrams) -> DataFrame:
    """``(row_id, source, key, restored)`` of values ``(row_id, source, odd, restored)`` that a learned cipher restores to usual text.

    A source's pairs of signs are counted first, so what comes together of it is
    bounded by the square of a page's signs; sources with more signs than a page
    has are left alone.
    """
    counted = unexplained.select("source", "odd").mapInPandas(_count_signs, "source string, x string, y string, n long")
    pairs = counted.groupBy("source", "x", "y").agg(F.sum("n").alias("n"))
    few = pairs.groupBy("source").agg(F.approx_count_distinct("x").alias("signs")).where(F.col("signs") <= 3 * MOST_SIGNS).select("source")
    cells = pairs.join(few, "source").groupBy("source").applyInPandas(_learn_source(lm), "source string, signs string, letters string, alphabet int")
    joined = unexplained.join(cells, "source").select("row_id", "source", "odd", "restored", "signs", "letters", "alphabet")
    return map_keyed(joined, _decipher(lm), "row_id long, source string, key int, restored string", "row_id")


def _em(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Weights of the keys in one source, from how many of its values have which gain."""
    k, g, n = pdf["key"].to_numpy(), pdf["bin"].to_numpy() * GAIN_BIN, pdf["n"].to_numpy(float)
    total = float(pdf["total"].iloc[0])
    keys, at = np.unique(k, return_inverse=True)
    weight = np.full(len(keys), PRIOR)
    for _ in range(ROUNDS):
        none = max(1e-3, 1 - weight.sum())
        post = 1 / (1 + none / weight[at] * np.exp(-g))
        weight = (np.bincount(at, post * n, len(keys)) + PRIOR * CLEAN) / (total + CLEAN)
    return pd.DataFrame({"source": key[0], "key": keys, "weight": weight})


def garbled(rows: DataFrame) -> DataFrame:
    """``(row_id, source, key, restored, lost)`` of every value that was decoded wrongly.

    ``rows`` has ``row_id, source, text``; null texts are left out, a null
    source is one source, an empty table gives no row, repeated rows give
    repeated rows. ``restored`` keeps what could not be restored as it stands;
    both it and ``key`` are null where bytes were lost and no key fits.
    """
    rows = rows.where(F.col("text").isNotNull()).select(
        "row_id", F.coalesce("source", F.lit("")).alias("source"), "text"
    )
    lm = learn_bigrams(rows.select("text"))
    lost = F.contains("text", F.lit("�")).alias("lost")
    schema = "row_id long, source string, lost boolean, key int, gain double, restored string, odd string"
    found = cut_lineage(map_keyed(rows.select("*", lost), _analyse(lm), schema, "row_id"))
    totals = found.where(F.col("key") == VALUES).groupBy("source").agg(F.sum("gain").alias("total"))
    bins = found.groupBy("source", "key", F.floor(F.least(F.col("gain"), F.lit(SURE_GAIN)) / GAIN_BIN).alias("bin")).agg(F.count("*").alias("n"))
    weights = bins.where("key >= 0").join(totals, "source").groupBy("source").applyInPandas(_em, "source string, key int, weight double")
    judged = found.join(weights, ["source", "key"], "left").withColumn(
        "posterior", F.col("weight") / (F.col("weight") + (1.0 - F.col("weight")) * F.exp(-F.col("gain")))
    )
    likely = F.coalesce(F.col("posterior") > 0.5, F.lit(False))
    listed = judged.where(F.col("lost") | likely).select(
        "row_id",
        "source",
        F.when(likely, F.col("key")).alias("key"),
        F.when(likely, F.col("restored")).alias("restored"),
        "lost",
    )
    learned = deciphered(found.where("odd IS NOT NULL"), lm)
    return listed.unionByName(learned.select("row_id", "source", "key", "restored", F.lit(False).alias("lost")))
