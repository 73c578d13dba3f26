"""Orders of lexicons and n-gram files. The rank is a column: DataFrames have no order of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.operators.lexicon import looked_up


def stroke_keys(words: DataFrame, strokes: DataFrame) -> DataFrame:
    """``(word, key)`` of the distinct words: per character its strokes and code point.

    ``strokes`` has ``(ch, strokes)``; a word with a character that it lacks has no key and is left out.
    """
    table = strokes.select(F.col("ch").alias("item"), F.struct("strokes", F.ascii("ch").alias("cp")).alias("value"))
    return looked_up(words.where("word IS NOT NULL"), "word", F.split("word", ""), table).where("n_missing = 0").select("word", F.col("values").alias("key"))


def collation_keys(word: Column) -> list[Column]:
    """Length, then Chinese collation; the word itself settles what is equal in both."""
    return [F.length(word).alias("n_chars"), F.collate(word, "zh").alias("collated")]


def arpa_sections(rows: DataFrame) -> DataFrame:
    """``(line_no, line, is_header, section)``; a section starts at a line with a backslash.

    A file has one such line per order and a few more, so their numbers are
    collected and no task has to run through the lines one after another.
    """
    header = F.startswith("line", F.lit("\\"))
    starts = [r["line_no"] for r in rows.where(header).select("line_no").collect()]
    passed = F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s <= F.col("line_no")) if starts else F.array()
    return rows.select("line_no", "line", header.alias("is_header"), F.size(passed).alias("section"))


def arpa_keys(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """``(line_no, key)``: the ranks of each line's fields, -1 for what has none.

    ``ranks`` has ``(word, rank)``; the last field ends in a line break and never has one.
    """
    found = looked_up(rows, "line_no", F.split("line", " "), ranks.select(F.col("word").alias("item"), F.col("rank").alias("value")))
    size = F.size("values")
    return found.select("line_no", F.transform("values", lambda v, k: F.when(k == size - 1, F.lit(-1)).otherwise(F.coalesce(v, F.lit(-1)))).alias("key"))
