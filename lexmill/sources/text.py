"""Readers of the text formats: corpora, lexicons, tables, n-gram files. Malformed lines are left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(file, line_no, line)`` of a file or of all files below a directory.

    A large file is read in splits by many tasks: the lines of each split are
    counted first, and a line's number is its place in the split after the lines
    of the splits before.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    read = (reader.option("pathGlobFilter", glob) if glob else reader).text(path)
    rows = read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("place"), F.col("value").alias("line")
    )
    splits = rows.groupBy("file", "start").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file", "start", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return rows.join(splits, ["file", "start"]).select("file", (F.col("place") + F.col("shift")).cast("int").alias("line_no"), "line")


def as_cedict(lines: DataFrame) -> DataFrame:
    """``(word, reading)`` of dictionary lines; comments and lines without a tone in every syllable are left out."""
    from lexmill.functions.readings import cedict_reading, cedict_word

    out = lines.select(cedict_word(F.col("line")).alias("word"), cedict_reading(F.col("line")).alias("reading"))
    return out.where("word IS NOT NULL AND reading IS NOT NULL")


def as_lexicon(lines: DataFrame, with_freq: bool = False) -> DataFrame:
    """``(line_no, word, readings[, freq])`` of lines ``word reading... [freq]``."""
    fields = F.split(F.trim("line"), r"\s+")
    last = F.size(fields) - (2 if with_freq else 1)
    out = lines.where(F.trim("line") != "").select(
        "line_no",
        F.element_at(fields, 1).alias("word"),
        F.slice(fields, F.lit(2), F.greatest(last, F.lit(0))).alias("readings"),
        *([F.element_at(fields, -1).try_cast("bigint").alias("freq")] if with_freq else []),
    )
    return out


def as_affixes(lines: DataFrame) -> DataFrame:
    """``(affix, flag)``: 1 for a suffix, 0 for a prefix; comments, blanks and other flags are left out."""
    fields = F.split(F.trim("line"), r"\s+")
    flag = F.try_element_at(fields, F.lit(2)).try_cast("int")
    rows = lines.where(~F.startswith("line", F.lit("#")) & (F.trim("line") != ""))
    return rows.select(F.element_at(fields, 1).alias("affix"), flag.alias("flag")).where("flag IN (0, 1)")


def as_strokes(lines: DataFrame) -> DataFrame:
    fields = F.split(F.trim("line"), " ")
    return lines.where(F.size(fields) == 2).select(fields[0].alias("ch"), fields[1].try_cast("int").alias("strokes"))


def as_unihan(lines: DataFrame) -> DataFrame:
    """``(line_no, cp, prop, value)`` of tab-separated property lines, all properties in one scan."""
    fields = F.split("line", "\t")
    rows = lines.where((F.size(fields) == 3) & fields[0].rlike(r"^U\+[0-9A-F]+\z"))
    return rows.select("line_no", fields[0].alias("cp"), fields[1].alias("prop"), fields[2].alias("value"))


def as_ranks(lines: DataFrame) -> DataFrame:
    """``(word, rank)``: the running index of lines over all files in order; a word's last line wins."""
    from lexmill.operators.lexicon import numbered

    word = F.element_at(F.split(F.trim("line"), r"\s+"), 1)
    ranked = numbered(lines.select("file", "line_no", word.alias("word")), ["file", "line_no"], 0, "rank")
    return ranked.groupBy("word").agg(F.max("rank").alias("rank"))


def as_blocks(lines: DataFrame, chunk: int = 65536) -> DataFrame:
    """``(file, block, rows)``: blocks of token lines, ended by an empty line or one that starts with white space.

    The ends are counted in chunks of lines, so that no task has to run through a whole file.
    """
    part = F.floor(F.col("line_no") / chunk)
    marked = lines.withColumns({"ends": F.col("line").rlike(r"^(?:[ \t].*)?\z"), "part": part})
    counts = marked.groupBy("file", "part").agg(F.count_if("ends").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("file", "part", F.coalesce(before, F.lit(0)).alias("before"))
    run = Window.partitionBy("file", "part").orderBy("line_no")
    numbered = marked.withColumn("own", F.sum(F.col("ends").cast("int")).over(run)).join(counts, ["file", "part"])
    kept = numbered.where(~F.col("ends")).withColumn("block", F.col("own") + F.col("before"))
    ordered = F.array_sort(F.collect_list(F.struct("line_no", F.split(F.trim("line"), r"[ \t]+").alias("columns"))))
    return kept.groupBy("file", "block").agg(F.transform(ordered, lambda r: r["columns"]).alias("rows"))


def read_options(text: str) -> dict[str, str]:
    """Options of ``key=value`` lines; comments start with a semicolon or number sign, the first value counts."""
    out: dict[str, str] = {}
    for line in text.splitlines():
        key, eq, value = line.partition("=")
        if eq and line[:1] not in ";#":
            out.setdefault(key.strip(), value.strip())
    return out
