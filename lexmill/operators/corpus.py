"""Corpus operators: lines, sentences, tokens, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.chars import HAN, PUNCT, TERMINATORS, is_ascii_line, let, strip_line

_OTHER = f"[^{TERMINATORS}{PUNCT}{HAN} \\t]"
_OTHER_OR_END = f"[^{PUNCT}{HAN} \\t]"
#: One match is one sentence.
SENTENCE = f"[ \\t{TERMINATORS}]*(?:[{PUNCT}{HAN}]|{_OTHER}{_OTHER_OR_END}*[ \\t{PUNCT}{HAN}])[^{TERMINATORS}]*(?:[{TERMINATORS}]|\\z)"


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, line_no, line)``: the lines of each text, counted from 0; a null text has none."""
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.select("key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def drop_ascii(rows: DataFrame) -> DataFrame:
    """The lines that hold more than ASCII, stripped."""
    return rows.where(~is_ascii_line(F.col("line"))).withColumn("line", strip_line(F.col("line")))


def sentence_tokens(match: Column) -> Column:
    """The tokens of one sentence: a Chinese character, a mark, or a run of others.

    Marks before the first token are no tokens, and a run cut off by the line's end is lost.
    """

    def tokens(s: Column, lead: Column, found: Column) -> Column:
        kept = F.when(s.rlike(f"{_OTHER}\\z"), F.slice(found, F.lit(1), F.greatest(F.size(found) - 1, F.lit(0)))).otherwise(found)
        return F.when(lead == "", kept).otherwise(F.concat(F.array(F.translate(lead, TERMINATORS, "")), kept))

    pattern = F.lit(f"[{HAN}{PUNCT}{TERMINATORS}]|{_OTHER}+")
    return let(
        F.regexp_replace(match, f"^[ \\t{TERMINATORS}]+", ""),
        lambda s: let(
            F.regexp_extract(s, f"^{_OTHER}{_OTHER_OR_END}*", 0),
            lambda lead: let(F.regexp_extract_all(F.substr(s, F.length(lead) + 1), pattern, 0), lambda found: tokens(s, lead, found)),
        ),
    )


def sentences(rows: DataFrame) -> DataFrame:
    """``(key, line_no, sent_no, tokens)`` of rows ``(key, line_no, line)``."""
    found = F.posexplode(F.regexp_extract_all("line", F.lit(SENTENCE), 0)).alias("sent_no", "m")
    return rows.select("key", "line_no", found).select("key", "line_no", "sent_no", sentence_tokens(F.col("m")).alias("tokens"))


def process(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sentences of the lines that are not ASCII only."""
    return sentences(drop_ascii(lines(docs, key, text)))


def segmented_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, word)``: the distinct words of each text whose lines are words joined by slashes."""
    words = F.explode(F.split(strip_line(F.col("line")), "/")).alias("word")
    return lines(docs, key, text).where(F.contains("line", F.lit("/"))).select("key", words).where("word <> ''").distinct()


def each_token(rows: DataFrame) -> DataFrame:
    """``token`` of every place of ``tokens``.

    An inner ``explode`` would have Spark ask for the array's size in a filter
    below, where the tokens would be made a second time.
    """
    return rows.select(F.explode_outer("tokens").alias("token")).where("token IS NOT NULL")


def ngrams(rows: DataFrame, *orders: int) -> DataFrame:
    """``(gram, order, n)``: how often each n-gram of ``tokens``, of each of the orders, occurs within its sentence; in one scan."""

    def grams(tokens: Column, n: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - n, F.lit(0)))
        gram = lambda k: F.concat_ws(" ", *[F.get(tokens, k + j) for j in range(n)])
        found = F.transform(starts, lambda k: F.struct(F.lit(n).alias("order"), gram(k).alias("gram")))
        return F.when(F.size(tokens) >= n, found).otherwise(F.slice(found, 1, 0))

    each = rows.select(F.explode_outer(let(F.col("tokens"), lambda t: F.concat(*[grams(t, n) for n in orders]))).alias("g"))
    return each.where("g IS NOT NULL").groupBy("g.gram", "g.order").agg(F.count("*").alias("n"))
