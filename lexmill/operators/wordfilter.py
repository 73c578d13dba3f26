"""Filters of candidate words, lookups and thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.chars import is_zh, is_zh_number

# Affixes that make a word a stop word.
PREFIXES = "最不很一每的"
SUFFIXES = "的上中啊了么着"


def is_stop_word(word: Column, prefixes: str = PREFIXES, suffixes: str = SUFFIXES) -> Column:
    return F.substring(word, 1, 1).isin(*prefixes) | F.right(word, F.lit(1)).isin(*suffixes)


def affix_lists(affixes: DataFrame) -> tuple[str, str]:
    """Prefixes and suffixes of a table ``(affix, flag)``; there are as many as a list of stop words has."""
    rows = [(r["affix"], r["flag"]) for r in affixes.where("length(affix) = 1").distinct().collect()]
    return "".join(sorted(a for a, f in rows if f == 0)), "".join(sorted(a for a, f in rows if f == 1))


def killed_by(word: Column, prefixes: str = PREFIXES, suffixes: str = SUFFIXES) -> Column:
    """The first filter that kills the word, null if none does; the filters run cheapest first."""
    first, last = F.substring(word, 1, 1), F.right(word, F.lit(1))
    return (
        F.when(F.length(word) == 1, "is_single_character")
        .when(~is_zh(word), "is_not_chinese_word")
        .when(is_zh_number(first) & is_zh_number(last), "is_number")
        .when((F.length(word) == 2) & (first == last), "is_AA")
        .when(is_stop_word(word, prefixes, suffixes), "is_stop_word")
    )


def judge(words: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``words`` with ``killed_by``, a known word (by a join that Spark picks by size) included."""
    out = words.withColumn("killed_by", killed_by(F.col("word")))
    if known is None:
        return out
    marks = known.select("word").distinct().withColumn("is_known", F.lit(True))
    joined = out.join(marks, "word", "left")
    return joined.withColumn("killed_by", F.coalesce("killed_by", F.when(F.col("is_known"), "is_known_word"))).drop("is_known")


def keep(words: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The words that no filter kills; known words are taken out by an anti join. A null is no word."""
    kept = words.where(F.col("word").isNotNull() & killed_by(F.col("word")).isNull())
    return kept.join(known.select("word").distinct(), "word", "left_anti") if known is not None else kept


def with_frequency(words: DataFrame, freqs: DataFrame) -> DataFrame:
    """``words`` with ``freq``, 0 where the source has none."""
    return words.join(freqs.select("word", "freq"), "word", "left").withColumn("freq", F.coalesce("freq", F.lit(0)).cast("bigint"))


def above(words: DataFrame, freqs: DataFrame, threshold: int = 30000) -> DataFrame:
    """The words whose frequency is strictly above the threshold."""
    return with_frequency(words, freqs).where(F.col("freq") > threshold)


def route(words: DataFrame, freqs: DataFrame, threshold: int = 30000, dictionary: DataFrame | None = None) -> DataFrame:
    """``words`` with ``freq`` and ``route``: keep, remove or wait.

    A single character is kept without a lookup, so its frequency is null.
    """
    out = with_frequency(words, freqs)
    listed = F.lit(False)
    if dictionary is not None:
        out = out.join(dictionary.select("word").distinct().withColumn("listed", F.lit(True)), "word", "left")
        listed = F.coalesce("listed", F.lit(False))
    single = F.length("word") == 1
    to = F.when(single | (F.col("freq") > threshold) | listed, "keep").when(F.col("freq") == 0, "remove").otherwise("wait")
    return out.select("word", F.when(~single, F.col("freq")).alias("freq"), to.alias("route"))
