"""Writers of the text formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slashed(words: Column) -> Column:
    return F.array_join(words, "/")


def spaced(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def lexicon_line(word: Column, readings: Column, freq: Column | None = None) -> Column:
    return F.concat_ws(" ", word, F.array_join(readings, " "), *([freq.cast("string")] if freq is not None else []))


def numbered_line(word: Column, number: Column, readings: Column) -> Column:
    return F.concat_ws(" ", word, number.cast("string"), F.nullif(F.array_join(readings, " "), F.lit("")))


def write_lines(rows: DataFrame, line: Column, path: str, mode: str = "append", order: list[str] | None = None) -> None:
    """Write one column as text; with ``order``, in ranges of files that follow each other."""
    if order:
        rows = rows.orderBy(*order)
    rows.select(line.alias("value")).write.mode(mode).text(path)


def tagged_text(results: DataFrame, verbose: int = 0) -> DataFrame:
    """``(key, line_no, sent_no, text)``: a line per token with its tag, from ``decode.results``; with ``verbose`` the tag's probability.

    A sentence's lines end with an empty one.
    """
    line = F.concat("token", F.lit("\t"), "tag", *([F.lit("/"), F.format_number("prob", 6)] if verbose else []))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", line.alias("line")))), lambda x: x["line"])
    return results.groupBy("key", "line_no", "sent_no").agg(F.concat(F.array_join(ordered, "\n"), F.lit("\n\n")).alias("text"))
