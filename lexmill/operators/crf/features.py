"""Templates, feature expansion, tag sets and feature dictionaries."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.chars import let
from lexmill.operators.corpus import lines

TEMPLATES = ["U00:%x[-2,0]", "U01:%x[-1,0]", "U02:%x[0,0]", "U03:%x[1,0]", "U04:%x[2,0]", "U05:%x[-1,0]/%x[0,0]", "U06:%x[0,0]/%x[1,0]", "B"]
_CELL = re.compile(r"%x\[(-?\d+),(\d+)\]")


@dataclass(frozen=True)
class Template:
    """Literal pieces with cells ``(row, column)`` between them."""

    text: str

    @property
    def is_unigram(self) -> bool:
        return self.text[0] == "U"

    @cached_property
    def pieces(self) -> list[str | tuple[int, int]]:
        out: list[str | tuple[int, int]] = []
        done = 0
        for m in _CELL.finditer(self.text):
            out += [self.text[done : m.start()], (int(m[1]), int(m[2]))]
            done = m.end()
        return [p for p in [*out, self.text[done:]] if p != ""]


def read_templates(text: str) -> list[Template]:
    """Templates of a file: ``U`` and ``B`` lines; comments and blanks are left out, others are errors."""
    out = []
    for line in text.splitlines():
        if not line.strip() or line[0] == "#":
            continue
        if line[0] not in "UB":
            raise ValueError(f"unknown type: {line}")
        out.append(Template(line.strip()))
    return out


def cell(tokens: list, i: int, row: int, column: int = 0) -> str:
    """The cell at ``row`` from position ``i``; beyond the sentence, a name that counts the distance."""
    k = i + row
    if 0 <= k < len(tokens):
        token = tokens[k]
        return token if isinstance(token, str) else token[column]
    return f"_B{k}" if k < 0 else f"_B+{k - len(tokens) + 1}"


def expand(tokens: list, i: int, templates: list[Template]) -> list[str]:
    """The features of one position; bigram ones from the second position on."""
    out = []
    for t in templates:
        if t.is_unigram or i:
            out.append("".join(p if isinstance(p, str) else cell(tokens, i, *p) for p in t.pieces))
    return out


def gold(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, line_no, tokens, tags)`` of lines segmented by slashes; tags by the place in the word: B, M, E, S."""
    words = F.filter(F.split("line", "/"), lambda w: w != "")
    each = F.flatten(
        F.transform(
            F.col("words"),
            lambda w: F.transform(
                F.split(w, ""),
                lambda c, i: F.struct(
                    c.alias("c"),
                    F.when(F.length(w) == 1, "S").when(i == 0, "B").when(i == F.length(w) - 1, "E").otherwise("M").alias("t"),
                ),
            ),
        )
    )
    rows = lines(docs, key, text).where(F.contains("line", F.lit("/"))).withColumn("words", words).where(F.size("words") > 0)
    pairs = rows.select("key", "line_no", each.alias("x"))
    return pairs.select("key", "line_no", F.col("x.c").alias("tokens"), F.col("x.t").alias("tags"))


def positions(sentences: DataFrame, templates: list[str] = TEMPLATES) -> DataFrame:
    """``(key, line_no, i, features)`` of every position, by expressions alone.

    The features are made within the sentence's row, so its tokens are not
    repeated for every position.
    """

    def at(tokens: Column, i: Column, k: int) -> Column:
        place, n = i + F.lit(k), F.size(tokens)
        before, after = F.concat(F.lit("_B"), place.cast("string")), F.concat(F.lit("_B+"), (place - n + 1).cast("string"))
        return F.when(place < 0, before).when(place >= n, after).otherwise(F.try_element_at(tokens, place + 1))

    def expanded(tokens: Column, i: Column) -> Column:
        found = []
        for t in map(Template, templates):
            feature = F.concat(*[F.lit(p) if isinstance(p, str) else at(tokens, i, p[0]) for p in t.pieces])
            found.append(feature if t.is_unigram else F.when(i > 0, feature))
        return F.array_compact(F.array(*found))

    def every(tokens: Column) -> Column:
        places = F.when(F.size(tokens) > 0, F.sequence(F.lit(0), F.size(tokens) - 1))
        return F.transform(places, lambda i: expanded(tokens, i))

    each = sentences.select("key", "line_no", F.posexplode_outer(let(F.col("tokens"), every)).alias("i", "features"))
    return each.where("i IS NOT NULL")


def feature_counts(sentences: DataFrame, least: int = 1, templates: list[str] = TEMPLATES) -> DataFrame:
    """``(feature, n)`` of the features that occur at least ``least`` times."""
    each = positions(sentences, templates).select(F.explode("features").alias("feature"))
    return each.groupBy("feature").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def tag_set(sentences: DataFrame) -> DataFrame:
    """``(tag, tag_id)``: tags numbered in byte order; there are few, whatever the input."""
    tags = sorted(r["tag"] for r in sentences.select(F.explode("tags").alias("tag")).distinct().collect())
    return sentences.sparkSession.createDataFrame([(t, i) for i, t in enumerate(tags)], "tag string, tag_id int")
