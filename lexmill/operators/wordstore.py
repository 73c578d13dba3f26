"""A store of words and frequencies: the last write wins."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "word string, freq bigint, seq bigint"


def upsert(writes: DataFrame) -> DataFrame:
    """``(word, freq, seq)``: of each word its last write by ``seq``; a null word is no key.

    A rewritten word moves to the end, so ``seq`` is also the store's order.
    """
    last = F.max_by(F.struct("freq", "seq"), "seq")
    return writes.where("word IS NOT NULL").groupBy("word").agg(last.alias("w")).select("word", "w.freq", "w.seq")


def merge(store: DataFrame, writes: DataFrame) -> DataFrame:
    return upsert(store.select("word", "freq", "seq").unionByName(writes.select("word", "freq", "seq")))


def contains(store: DataFrame, words: DataFrame) -> DataFrame:
    return words.join(store, "word", "left_semi")


def get(store: DataFrame, words: DataFrame) -> DataFrame:
    return words.join(store.select("word", "freq"), "word", "left")


def delete(store: DataFrame, words: DataFrame) -> DataFrame:
    return store.join(words.select("word"), "word", "left_anti")


def resume_after(rows: DataFrame, word: str) -> DataFrame:
    """The rows after the first one with ``word``; none if it does not occur."""
    at = rows.where(F.col("word") == word).agg(F.min("line_no")).first()[0]
    return rows.where(F.col("line_no") > at) if at is not None else rows.limit(0)


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The store kept at ``path``; where there is none, an empty one is made."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException:
        spark.createDataFrame([], SCHEMA).write.parquet(path)
        return spark.read.schema(SCHEMA).parquet(path)


def save(store: DataFrame, path: str) -> None:
    """Replace the store at ``path``; the old one may be what ``store`` is made of, so the new one is written beside it first."""
    spark = store.sparkSession
    beside = f"{path}.new"
    store.select("word", "freq", "seq").write.mode("overwrite").parquet(beside)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old, new = hadoop(path), hadoop(beside)
    files = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(old, True)
    files.rename(new, old)


def add(path: str, writes: DataFrame) -> None:
    """Write ``(word, freq)`` rows with ``seq`` to the store at ``path``; the last write of a word wins."""
    save(merge(open_store(writes.sparkSession, path), writes), path)


def items(store: DataFrame) -> DataFrame:
    """``(word, freq)`` in the order of the writes."""
    return store.orderBy("seq").select("word", "freq")


def from_cedict(entries: DataFrame) -> DataFrame:
    """Writes of the distinct words of dictionary entries, each with the frequency 1."""
    words = entries.select("word").distinct()
    return words.select("word", F.lit(1).cast("bigint").alias("freq"), F.monotonically_increasing_id().alias("seq"))
