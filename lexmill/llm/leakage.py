"""Problem 8: passages of evaluation items inside a corpus.

A pair (item, document) is reported if both have a run of at least
``run`` letters and digits in common once everything else is left out and case
and width are ignored. A document is scanned in windows of ``run//2 + 1``
characters that start at every multiple of ``run//2``: a common run of ``run``
characters always holds one of them whole, so looking these up in the broadcast
set of all the items' n-grams misses nothing; each hit is then verified by
extending it to its full length.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import compress

import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import map_keyed

RUN = 50
BLOCK_CHARS = 2_000_000

_DROP = regex.compile(r"[^\p{L}\p{N}]+")
_CLUSTER = regex.compile(r".[\p{M}\uFF9E\uFF9F\u1160-\u11FF]*", regex.S)
_SPANS = "doc_id long, item_id long, start int, length int"


def skeleton(text: str) -> str:
    """Letters and digits of the text in NFKC and lower case; a final sigma is a sigma."""
    return _DROP.sub("", unicodedata.normalize("NFKC", text).lower()).replace("ς", "σ")


def mapped_skeleton(text: str) -> tuple[str, list[tuple[int, int]]]:
    """The skeleton, and of each of its characters the span of the text from which it comes.

    Characters that may become one (a letter and its marks, half-width kana and
    sound marks, parts of a syllable) are normalised together.
    """
    parts, where = [], []
    for m in _CLUSTER.finditer(text):
        s = skeleton(m[0])
        parts.append(s)
        where += [m.span()] * len(s)
    return "".join(parts), where


def _grams(items: list[tuple[int, str]], run: int) -> dict[str, list[tuple[int, int]]]:
    width = run // 2 + 1
    grams: dict[str, list[tuple[int, int]]] = {}
    for k, (_, text) in enumerate(items):
        for i in range(len(text) - width + 1):
            grams.setdefault(text[i : i + width], []).append((k, i))
    return grams


def find_runs(text: str, items: list[tuple[int, str]], grams: dict, run: int) -> list[tuple[int, int, int]]:
    """``(item_id, start, length)`` of the longest verified run with each item."""
    width, step = run // 2 + 1, run // 2
    best: dict[int, tuple[int, int]] = {}
    for p in range(0, len(text) - width + 1, step):
        for k, q in grams.get(text[p : p + width], ()):
            have = best.get(k)
            if have and have[0] <= p < have[0] + have[1] - width:
                continue  # inside the run that is known
            other = items[k][1]
            a, b = p, q
            while a and b and text[a - 1] == other[b - 1]:
                a, b = a - 1, b - 1
            e, g = p + width, q + width
            while e < len(text) and g < len(other) and text[e] == other[g]:
                e, g = e + 1, g + 1
            if e - a >= run and (not have or e - a > have[1]):
                best[k] = (a, e - a)
    return [(items[k][0], a, n) for k, (a, n) in best.items()]


def _scanner(block: Broadcast, run: int):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, grams = block.value
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                s = skeleton(text)
                if len(s) >= run:
                    out += [(doc_id, i, a, n) for i, a, n in find_runs(s, items, grams, run)]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "start", "length"])

    return scan


def _blocks(items: DataFrame, run: int) -> Iterator[list[tuple[int, str]]]:
    """The items' skeletons in blocks of at most ``BLOCK_CHARS`` characters each."""
    block, size = [], 0
    for r in items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").toLocalIterator():
        s = skeleton(r["text"])
        if len(s) < run:
            continue
        if block and size + len(s) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((r["item_id"], s))
        size += len(s)
    if block:
        yield block


def _shared(docs: DataFrame, block: list[tuple[int, str]], run: int) -> Broadcast:
    """A block with its n-grams, once for each executor's workers; ``BLOCK_CHARS`` bounds its size."""
    return docs.sparkSession.sparkContext.broadcast((block, _grams(block, run)))


def leaked_runs(docs: DataFrame, items: DataFrame, run: int = RUN) -> DataFrame:
    """``(doc_id, item_id, start, length)``: the longest common run of each pair.

    ``start`` counts letters and digits of the document. ``docs`` needs
    ``doc_id, text``, ``items`` ``item_id, text``; other columns are ignored; a
    null id or text gives no row; ids that repeat give one row per pair. What
    is broadcast at once is bounded by ``BLOCK_CHARS``; a larger set of items
    takes several scans.
    """
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    found = None
    for block in _blocks(items, run):
        part = map_keyed(docs, _scanner(_shared(docs, block, run), run), _SPANS, "doc_id")
        found = part if found is None else found.unionAll(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], _SPANS)
    best = F.max_by(F.struct("start", "length"), F.struct("length", -F.col("start")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.start", "b.length")


def _cutter(block: Broadcast, run: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, grams = block.value
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": [remove_runs(t, items, grams, run) for t in pdf["text"]]})

    return cut


def shared_runs(s: str, items: list[tuple[int, str]], grams: dict, run: int) -> list[tuple[int, int]]:
    """The spans of a skeleton that it shares with any item, as ``(start, end)``."""
    width, step = run // 2 + 1, run // 2
    out: list[tuple[int, int]] = []
    for p in range(0, len(s) - width + 1, step):
        for k, q in grams.get(s[p : p + width], ()):
            other = items[k][1]
            a, b = p, q
            while a and b and s[a - 1] == other[b - 1]:
                a, b = a - 1, b - 1
            e, g = p + width, q + width
            while e < len(s) and g < len(other) and s[e] == other[g]:
                e, g = e + 1, g + 1
            if e - a >= run:
                out.append((a, e))
    return out


def remove_runs(text: str | None, items: list[tuple[int, str]], grams: dict, run: int) -> str | None:
    """The text without the characters of any run it shares with an item, until it shares none."""
    while text is not None and len(text) and find_runs(skeleton(text), items, grams, run):
        s, where = mapped_skeleton(text)
        keep = bytearray(b"\1") * len(text)
        for a, e in shared_runs(s, items, grams, run):
            lo, hi = where[a][0], where[e - 1][1]
            keep[lo:hi] = bytes(hi - lo)
        if all(keep):
            break
        text = "".join(compress(text, keep))
    return text


def remove_leaks(docs: DataFrame, items: DataFrame, run: int = RUN) -> DataFrame:
    """``(doc_id, text)`` with every shared run cut out; null texts stay null."""
    out = docs.select("doc_id", "text")
    for block in _blocks(items, run):
        out = map_keyed(out, _cutter(_shared(docs, block, run), run), "doc_id long, text string", "doc_id")
    return out
