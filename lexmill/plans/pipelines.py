"""Whole dataflows, each one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators import lexicon as lex
from lexmill.operators import wordfilter
from lexmill.operators.corpus import process, segmented_words
from lexmill.operators.crf.decode import tag
from lexmill.operators.crf.model import Model


def extract_words(words: DataFrame, known: DataFrame, freqs: DataFrame | None = None, threshold: int = 30000) -> DataFrame:
    """``(word, freq)`` of new words; without frequencies every survivor has 1.

    Duplicates go before the lookup, cheap filters before the joins.
    """
    kept = wordfilter.keep(words.select("word").distinct(), known)
    if freqs is None:
        return kept.select("word", F.lit(1).cast("bigint").alias("freq"))
    return wordfilter.above(kept, freqs, threshold)


def extract_from_segmented(docs: DataFrame, known: DataFrame, freqs: DataFrame | None = None, threshold: int = 30000) -> DataFrame:
    return extract_words(segmented_words(docs), known, freqs, threshold)


def extract_from_text(docs: DataFrame, model: Model, known: DataFrame, freqs: DataFrame | None = None, threshold: int = 30000) -> DataFrame:
    words = tag(process(docs), model, columns=["words"]).select(F.explode("words").alias("word"))
    return extract_words(words, known, freqs, threshold)


def build_dictionary(lexicon: DataFrame, candidates: DataFrame, chars: DataFrame, freqs: DataFrame) -> DataFrame:
    """``(word, id, readings)``: head, lexicon, then new words with readings by their characters."""
    new = lex.with_readings(wordfilter.with_frequency(lex.new_words(candidates, lexicon), freqs), chars).where("reading IS NOT NULL")
    last = lexicon.agg(F.max("line_no")).first()[0] or 0
    added = lex.numbered(new.select("word", "reading"), ["word"], last + 1, "line_no")
    body = lexicon.select(F.col("line_no").cast("bigint").alias("line_no"), "word", "readings").unionByName(
        added.select("line_no", "word", F.array("reading").alias("readings"))
    )
    return lex.with_head(lex.assign_ids(body))
