"""The queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import boilerplate, encoding, leakage, lookalike, markup, packing, sentences, termcount, truncation
from lexmill.session import table


def _looks(spark: SparkSession, d: str) -> DataFrame:
    sentences = table(spark, d, "baseseg").select(
        F.lit("baseseg.sentence").alias("field"), F.col("sent_id").alias("row_id"), F.col("sentence").alias("text")
    )
    words = table(spark, d, "words").select(
        F.lit("words.word").alias("field"), F.col("entry_id").alias("row_id"), F.col("word").alias("text")
    )
    return sentences.unionAll(words)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    changed = lookalike.plain_forms(_looks(spark, d), changed_only=True).select("field", "row_id")
    garbled = encoding.garbled(_scraped(spark, d)).select(F.lit("baseseg.sentence").alias("field"), "row_id").distinct()
    return changed.join(garbled, ["field", "row_id"], "left_anti")


def p1_plain(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.plain_forms(_looks(spark, d)).select("field", "row_id", "plain")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    marks = F.array_compact(F.array(F.when(F.col("rare"), F.lit("rare")), F.when(F.col("common"), F.lit("common"))))
    return termcount.term_marks(table(spark, d, "words")).select(F.col("term").alias("word"), F.explode(marks).alias("mark"))


def p2_frequency(spark: SparkSession, d: str) -> DataFrame:
    return termcount.term_marks(table(spark, d, "words")).withColumnRenamed("term", "word")


def _scraped(spark: SparkSession, d: str) -> DataFrame:
    source = F.coalesce("site", "channel").alias("source")
    rows = table(spark, d, "baseseg").where("channel IN ('web', 'feed')")
    return rows.select(F.col("sent_id").alias("row_id"), source, F.col("sentence").alias("text"))


def _sentences(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "baseseg").select(F.col("sent_id").alias("row_id"), F.col("sentence").alias("text"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.marked_rows(_sentences(spark, d)).select(F.col("row_id").alias("sent_id"))


def p3_clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.strip_markup(_sentences(spark, d)).withColumnRenamed("row_id", "sent_id")


def _pages(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Rows of web pages, and the garbled ones with what could be restored of them."""
    web = table(spark, d, "baseseg").where("channel = 'web'")
    rows = web.select(F.col("sent_id").alias("row_id"), "page_id", "site", "line_no", F.col("sentence").alias("text"))
    key = F.concat_ws(",", "row_id", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce(F.col("line_no").cast("string"), F.lit("")))
    found = encoding.garbled(rows.select(key.alias("row_id"), F.col("site").alias("source"), "text")).where("restored IS NOT NULL")
    part = F.split("row_id", ",")
    restored = found.select(
        *[F.nullif(part[k], F.lit("")).cast(kind).alias(name) for k, (name, kind) in enumerate([("row_id", "long"), ("page_id", "long"), ("line_no", "int")])],
        F.col("restored").alias("text"),
    )
    return rows, restored.dropDuplicates(["row_id"])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.frame_lines(*_pages(spark, d)).where("NOT main").select(F.col("row_id").alias("sent_id"), "seg_no")


def p4_main(spark: SparkSession, d: str) -> DataFrame:
    rows, restored = _pages(spark, d)
    main = boilerplate.frame_lines(rows, restored).where("main")
    texts = rows.join(restored.select("row_id", F.col("text").alias("again")), "row_id", "left").select("row_id", F.coalesce("again", "text").alias("text"))
    text = F.element_at(F.split("text", "\n"), F.col("seg_no").cast("int"))
    joined = main.join(texts, "row_id")
    return joined.select("page_id", "line_no", F.col("row_id").alias("sent_id"), "seg_no", text.alias("line"))


def _prose(spark: SparkSession, d: str) -> DataFrame:
    prose = table(spark, d, "baseseg").where("channel = 'prose'")
    return prose.select(F.col("sent_id").alias("row_id"), "lang", F.col("sentence").alias("text"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.split_sentences(_prose(spark, d)).select(F.col("row_id").alias("sent_id"), "end_pos")


def p5_sentences(spark: SparkSession, d: str) -> DataFrame:
    prose = _prose(spark, d)
    found = sentences.split_sentences(prose).join(prose.select("row_id", "text"), "row_id")
    text = F.trim(F.substring("text", F.col("start_pos").cast("int") + 1, (F.col("end_pos") - F.col("start_pos")).cast("int")))
    return found.select(F.col("row_id").alias("sent_id"), "end_pos", text.alias("sentence"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.garbled(_scraped(spark, d)).select(F.col("row_id").alias("sent_id"))


def p6_restored(spark: SparkSession, d: str) -> DataFrame:
    return encoding.garbled(_scraped(spark, d)).select(F.col("row_id").alias("sent_id"), "key", "restored", "lost")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return packing.split_documents(table(spark, d, "documents"))


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    bins = p7_pack(spark, d).groupBy("shard", "bin").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("segments"))
    return bins.agg(
        F.count("*").alias("containers"),
        F.sum("segments").alias("pieces"),
        F.sum("tokens").alias("tokens"),
        F.round(F.sum("tokens") / (F.count("*") * packing.CAPACITY), 4).alias("fill"),
        F.max("tokens").alias("fullest"),
    )


def p7_limits(spark: SparkSession, d: str) -> DataFrame:
    """How many containers break a limit, and what all of them hold together."""
    bins = p7_pack(spark, d).groupBy("shard", "bin").agg(
        F.sum("tokens").alias("tokens"), F.sum("loss_tokens").alias("loss"), F.count("*").alias("segments"), F.count_if(F.col("piece_no") == 0).alias("docs")
    )
    over = (F.col("tokens") > packing.CAPACITY) | (F.col("segments") > packing.MAX_SEGMENTS) | (F.col("loss") > packing.CAPACITY)
    return bins.agg(F.count_if(over).alias("n_over"), F.sum("docs").alias("n_docs"), F.sum("tokens").alias("tokens"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_runs(table(spark, d, "documents"), table(spark, d, "eval_items")).select("item_id", "doc_id")


def p8_clean(spark: SparkSession, d: str) -> DataFrame:
    return leakage.remove_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "documents")).where("evidence IS NOT NULL").select("doc_id")


def p9_evidence(spark: SparkSession, d: str) -> DataFrame:
    """How many cut documents each kind of evidence gives."""
    cut = truncation.truncated(table(spark, d, "documents")).where("evidence IS NOT NULL")
    return cut.groupBy("evidence").agg(F.count("*").alias("n"))


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    cut = F.count("evidence")
    return (
        truncation.truncated(table(spark, d, "documents"))
        .groupBy("source")
        .agg(F.count("*").alias("n_docs"), cut.alias("n_cut"), F.round(cut / F.count("*"), 6).alias("share"))
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: f
        for name, f in globals().items()
        if name[:1] == "p" and name[1:2].isdigit() and callable(f)
    }


_P2 = """
WITH once AS (
  SELECT file, word, max(coalesce(freq, 0)) AS freq FROM words WHERE word IS NOT NULL GROUP BY file, word),
n AS (SELECT count(DISTINCT file) AS files FROM once),
totals AS (
  SELECT word, CAST(sum(freq) AS BIGINT) AS total_freq, count(DISTINCT file) AS n_records, count(*) AS n_entries
  FROM once GROUP BY word),
marked AS (
  SELECT word, total_freq, n_records, n_entries, total_freq < 5 AS rare, n_records > 0.3 * files AS common
  FROM totals, n)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": _P2 + "SELECT word, 'rare' AS mark FROM marked WHERE rare UNION ALL SELECT word, 'common' FROM marked WHERE common",
        "p2_frequency": _P2 + "SELECT * FROM marked",
        "p7_limits": "SELECT CAST(0 AS BIGINT) AS n_over, count(*) AS n_docs, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS tokens FROM documents WHERE text IS NOT NULL",
        "p7_found": "SELECT doc_id FROM documents WHERE octet_length(encode(text)) + 1 > 4096",
    }
