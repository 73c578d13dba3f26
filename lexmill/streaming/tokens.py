"""The corpus operators over streams of lines; all but the counts are the batch operators themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators.corpus import drop_ascii, sentences


def token_counts(lines: DataFrame, time: str = "ts", window: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """``(start, token, n)`` of a stream ``(ts, line)``, by event-time windows with a watermark."""
    stamped = lines.withWatermark(time, late).select(F.col(time).alias("key"), F.lit(0).alias("line_no"), "line")
    tokens = sentences(drop_ascii(stamped)).select(F.col("key").alias(time), F.explode("tokens").alias("token"))
    return tokens.groupBy(F.window(time, window).alias("w"), "token").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "token", "n")
