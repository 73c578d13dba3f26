"""Character classes and line predicates as Column functions.

The classes are fixed values; they read the same in Java and in RE2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bodies of character classes.
TERMINATORS = r"!?,;.！？，。…"
PUNCT = (
    r'"#$%&\x27()*+\-/:<=>@\[\\\]^_`{|}~\x{2000}-\x{2025}\x{2027}-\x{206f}\x{3000}\x{3001}\x{3003}-\x{303f}\x{ff00}\x{ff02}-\x{ff0b}'
    r"\x{ff0d}-\x{ff1e}\x{ff20}-\x{ffef}\x{fe30}-\x{fe4f}"
)
HAN = r"\x{2e80}-\x{2fef}\x{3400}-\x{4dbf}\x{4e00}-\x{9fbb}\x{f900}-\x{fad9}\x{20000}-\x{2a6df}"
NUMBERS = "十百千万亿一二三四五六七八九零几"
_ALL_PUNCT = PUNCT + r"!?,;.！？，。…"
STRIP = r"^[\s\x{3000}\x{a0}\x{85}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}]+|[\s\x{3000}\x{a0}\x{85}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}]+$"


def is_zh(ch: Column) -> Column:
    """Whether the first character is Chinese; false for an empty string."""
    return ch.rlike(f"^[{HAN}]")


def is_punct(ch: Column) -> Column:
    return ch.rlike(f"^[{_ALL_PUNCT}]")


def is_terminator(ch: Column) -> Column:
    return ch.isin(*TERMINATORS)


def is_zh_number(ch: Column) -> Column:
    return ch.isin(*NUMBERS)


def is_ascii_line(line: Column) -> Column:
    """Whether the line holds ASCII only; an empty line does."""
    return ~line.rlike(r"[^\x00-\x7f]")


def strip_line(line: Column) -> Column:
    """The line without white space of any script at its ends."""
    return F.regexp_replace(line, STRIP, "")


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``value``, which is computed once however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))
