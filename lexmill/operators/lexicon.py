"""Operators on lexicons: shrink, lint, numbering, merge, property priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.readings import PUNCTUATION, codepoint_to_chr, normalize_pys, unihan_readings
from lexmill.session import shuffle_partitions, write_table

# Entries at the head of a numbered dictionary.
HEAD = {
    "<unknown>": 0, "<unknown_cn>": 2, "<amigu>": 9, "<stok>": 10, "<Digit>": 20, "<Simbol>": 21, "<NONEWORD_ALLWORD>": 69,
    "，": 70, "。": 71, "；": 72, "？": 73, "！": 74, "：": 75, "“": 76, "”": 77, "、": 78, "…": 79,
}
FIRST_ID = 100
PRIORITY = ["kHanyuPinlu", "kXHC1983", "kHanyuPinyin", "kMandarin"]


def shrink(lexicon: DataFrame, threshold: int = 8000) -> DataFrame:
    """Single characters, and words at or above the threshold; a null frequency is below it."""
    return lexicon.where((F.length("word") == 1) | (F.coalesce("freq", F.lit(0)) >= threshold))


def drop_rare_planes(lexicon: DataFrame) -> DataFrame:
    """Without single characters beyond the basic plane or of the compatibility block."""
    cp = F.ascii("word")
    return lexicon.where(~((F.length("word") == 1) & ((cp > 0xFFFF) | cp.between(0xF900, 0xFAFF))))


def numbered(rows: DataFrame, order: list[str], start: int, name: str = "id") -> DataFrame:
    """``rows`` numbered on from ``start`` in ``order``, which must be total.

    The rows are sorted in ranges; only the ranges' sizes visit the driver, so no
    task sees the whole table as a window without partitions would.
    """
    n = shuffle_partitions(rows.sparkSession)
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    ranged = write_table(ranged)  # so that sizes and numbers come from the same ranges
    part = F.shiftright("_mid", 33)
    sizes = {r["p"]: r["n"] for r in ranged.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    total, starts = start, []
    for p in range(max(sizes, default=0) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    first = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts]), (part + 1).cast("int"))
    return ranged.withColumn(name, first + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))).drop("_mid")


def assign_ids(lexicon: DataFrame) -> DataFrame:
    """``(word, id, readings)``: the lexicon numbered from 100 in line order, readings without tones."""
    body = numbered(lexicon.select("line_no", "word", "readings"), ["line_no"], FIRST_ID)
    return body.select("word", "id", F.transform(F.coalesce("readings", F.array().cast("array<string>")), normalize_pys).alias("readings"))


def with_head(body: DataFrame) -> DataFrame:
    spark = body.sparkSession
    head = spark.createDataFrame([(w, i) for w, i in HEAD.items()], "word string, id bigint")
    return head.withColumn("readings", F.array().cast("array<string>")).unionByName(body)


def lint(lexicon: DataFrame) -> DataFrame:
    """``(ch, py, word)``: readings within words that the character has no entry for."""
    bare = F.transform("readings", lambda r: F.substring_index(r, ":", 1))
    each = lexicon.where("readings IS NOT NULL").select("word", F.explode(bare).alias("py"))
    single = each.where(F.length("word") == 1).select(F.col("word").alias("ch"), "py").distinct()
    chars, syllables = F.split("word", ""), F.split("py", "'")
    size = F.least(F.size(chars), F.size(syllables))
    zipped = F.arrays_zip(F.slice(chars, F.lit(1), size).alias("ch"), F.slice(syllables, F.lit(1), size).alias("py"))
    terms = each.where(F.length("word") > 1).select("word", F.explode(zipped).alias("z")).select("z.ch", "z.py", "word").distinct()
    return terms.join(single, ["ch", "py"], "left_anti")


def new_words(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """The distinct candidates that the lexicon does not have."""
    return candidates.select("word").distinct().join(existing.select("word").distinct(), "word", "left_anti")


def looked_up(rows: DataFrame, key: str, items: Column, table: DataFrame) -> DataFrame:
    """``(key, values, n_missing)`` of each distinct ``key``: the values of its items, in order, and how many have none.

    ``table`` has ``(item, value)`` with unique items; a join looks them up, so it may be of any size.
    """
    each = rows.select(key, items.alias("_items")).dropDuplicates([key]).select(key, F.posexplode_outer("_items").alias("_i", "item"))
    found = each.join(table.select("item", "value"), "item", "left")
    ordered = F.array_sort(F.collect_list(F.struct("_i", "value")))
    return found.groupBy(key).agg(F.transform(ordered, lambda x: x["value"]).alias("values"), (F.count("*") - F.count("value")).alias("n_missing"))


def first_readings(chars: DataFrame) -> DataFrame:
    """``(item, value)``: each character with its first reading; punctuation has readings of its own."""
    own = chars.sparkSession.createDataFrame(list(PUNCTUATION.items()), "item string, value string")
    listed = chars.where("ch IS NOT NULL AND size(readings) > 0").groupBy(F.col("ch").alias("item")).agg(F.first(F.element_at("readings", 1)).alias("value"))
    return own.unionByName(listed.where(~F.col("item").isin(*PUNCTUATION)))


def with_readings(words: DataFrame, chars: DataFrame) -> DataFrame:
    """``words`` with ``reading`` from the characters' first readings, null where one has none."""
    found = looked_up(words.where("word IS NOT NULL"), "word", F.split("word", ""), first_readings(chars))
    read = found.select("word", F.when(F.col("n_missing") == 0, F.array_join("values", "'")).alias("reading"))
    return words.join(read, "word", "left")


def unihan_priority(rows: DataFrame) -> DataFrame:
    """``(ch, prop, readings)``: per character the readings of its first property by priority, first line.

    ``rows`` has ``line_no, cp, prop, value``; characters outside U+3400..U+9FFF are left out.
    """
    rank = F.array_position(F.array(*[F.lit(p) for p in PRIORITY]), F.col("prop"))
    ch = codepoint_to_chr(F.col("cp"))
    known = rows.where(F.col("prop").isin(PRIORITY)).select("line_no", ch.alias("ch"), "prop", "value", rank.alias("rank"))
    known = known.where(F.ascii("ch").between(0x3400, 0x9FFF))
    best = known.groupBy("ch").agg(F.min_by(F.struct("prop", "value"), F.struct("rank", "line_no")).alias("b"))
    return best.select("ch", F.col("b.prop").alias("prop"), F.array_sort(F.array_distinct(unihan_readings(F.col("b.prop"), F.col("b.value")))).alias("readings"))


def unihan_merge(lexicon: DataFrame, unihan: DataFrame) -> DataFrame:
    """``(line_no, word, readings)``: first entries of single characters take the Unihan readings.

    An entry with a weight stays as it is, and so do later entries of the same
    character; characters that the lexicon lacks come last, without a line number.
    """
    nth = F.row_number().over(Window.partitionBy("word").orderBy("line_no"))
    marked = lexicon.select("line_no", "word", "readings", nth.alias("nth"))
    joined = marked.join(unihan.select(F.col("ch").alias("word"), F.col("readings").alias("other")), "word", "left")
    weighted = F.exists("readings", lambda r: F.contains(r, F.lit(":")))
    takes = (F.length("word") == 1) & (F.col("nth") == 1) & F.col("other").isNotNull() & ~F.coalesce(weighted, F.lit(False))
    merged = joined.select("line_no", "word", F.when(takes, F.col("other")).otherwise(F.col("readings")).alias("readings"))
    rest = unihan.select(F.col("ch").alias("word"), "readings").join(lexicon.select("word"), "word", "left_anti")
    return merged.unionByName(rest.select(F.lit(None).cast("int").alias("line_no"), "word", "readings"))
