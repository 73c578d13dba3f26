"""Problem 2: frequency of every distinct term, by blockwise count arrays.

Steps: one row per (record, term); a global integer dictionary of the terms;
terms encoded by it; count arrays over blocks of identifiers, filled task by
task; the arrays summed by identifier range.

A term as frequent as a third of all rows harms no step: the distinct terms
come from a partially aggregated ``distinct``, the encoding join meets a unique
dictionary (a skewed partition of the other side is split at run time), and
from there on a task hands on at most one cell per term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import shuffle_partitions, write_table

BLOCK = 4096
HELD = 512  # blocks that a task holds at once; each is 98 kB

_PARTIAL = "block long, pos array<int>, occ array<long>, rec array<long>"
_TOTAL = "term_id long, total_freq long, n_records long, n_entries long"


def global_dictionary(terms: DataFrame, col: str = "term") -> DataFrame:
    """``(term, term_id)``: the distinct non-null terms numbered from 0 without gaps.

    Identifiers run on through the hash partitions of the terms, in order within
    each. The places are written once, so that every use sees the same ones
    whatever is computed again. Only the partitions' sizes (one number each)
    visit the driver.
    """
    n = shuffle_partitions(terms.sparkSession)
    placed = (
        terms.where(F.col(col).isNotNull())
        .select(F.col(col).alias("term"))
        .distinct()
        .repartition(n, "term")
        .sortWithinPartitions("term")
        .withColumn("mid", F.monotonically_increasing_id())
    )
    placed = write_table(placed)
    part = F.shiftright("mid", 33)
    sizes = placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()
    offset, starts = 0, []
    by_part = {r["p"]: r["n"] for r in sizes}
    for p in range(max(by_part, default=0) + 1):
        starts.append(offset)
        offset += by_part.get(p, 0)
    first = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), (part + 1).cast("int"))
    return placed.select("term", (first + F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))).alias("term_id"))


def _cells(blocks: dict[int, np.ndarray]) -> Iterator[pd.DataFrame]:
    for b, counts in blocks.items():
        pos = np.flatnonzero(counts[2])
        yield pd.DataFrame(
            {
                "block": [b],
                "pos": [pos.astype(np.int32)],
                "occ": [counts[0][pos]],
                "rec": [counts[1][pos] * (1 << 32) + counts[2][pos]],
            }
        )


def _accumulate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of each block; of ``HELD`` blocks all are handed on, so that no dictionary is too large for a task."""
    blocks: dict[int, np.ndarray] = {}
    for pdf in batches:
        ids = pdf["term_id"].to_numpy(np.int64)
        freq = pdf["freq"].to_numpy(np.int64)
        known = pdf["in_record"].to_numpy(np.int64)
        block = ids // BLOCK
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[order])) + 1
        for rows in np.split(order, cuts):
            if not len(rows):
                continue
            b = int(block[rows[0]])
            if b not in blocks and len(blocks) >= HELD:
                yield from _cells(blocks)
                blocks = {}
            counts = blocks.setdefault(b, np.zeros((3, BLOCK), np.int64))
            pos = ids[rows] % BLOCK
            np.add.at(counts[0], pos, freq[rows])
            np.add.at(counts[1], pos, known[rows])
            np.add.at(counts[2], pos, 1)
    yield from _cells(blocks)


def _sum_block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros((3, BLOCK), np.int64)
    for pos, occ, rec in zip(pdf["pos"], pdf["occ"], pdf["rec"]):
        pos, rec = np.asarray(pos), np.asarray(rec)
        total[0][pos] += np.asarray(occ)
        total[1][pos] += rec >> 32
        total[2][pos] += rec & 0xFFFFFFFF
    pos = np.flatnonzero(total[2])
    return pd.DataFrame(
        {
            "term_id": key[0] * BLOCK + pos,
            "total_freq": total[0][pos],
            "n_records": total[1][pos],
            "n_entries": total[2][pos],
        }
    )


def term_totals(
    entries: DataFrame, record: str = "file", term: str = "word", freq: str = "freq"
) -> DataFrame:
    """``(term, total_freq, n_records, n_entries)`` for every distinct term.

    ``entries`` has one row per delivery of a (record, term). Deliveries of the
    same pair count once, with their largest freq; a null freq counts as 0; a
    null term is left out; a null record is a pair of its own that counts for
    the frequency and the entries, but is no record. An empty table gives no row.
    """
    once = (
        entries.where(F.col(term).isNotNull())
        .select(F.col(record).alias("record"), F.col(term).alias("term"), F.coalesce(F.col(freq), F.lit(0)).cast("long").alias("f"))
        .groupBy("record", "term")
        .agg(F.max("f").alias("freq"))
    )
    dictionary = global_dictionary(once, "term")
    encoded = once.join(dictionary, "term").select(
        "term_id", "freq", F.col("record").isNotNull().cast("int").alias("in_record")
    )
    arrays = encoded.mapInPandas(_accumulate, _PARTIAL)
    totals = arrays.groupBy("block").applyInPandas(_sum_block, _TOTAL)
    return totals.join(dictionary, "term_id").select("term", "total_freq", "n_records", "n_entries")


def term_marks(
    entries: DataFrame,
    record: str = "file",
    term: str = "word",
    freq: str = "freq",
    rare_below: int = 5,
    common_above: float = 0.3,
) -> DataFrame:
    """``term_totals`` with ``rare`` and ``common``.

    ``rare``: total freq below ``rare_below``. ``common``: in more than the share
    ``common_above`` of the records that have at least one non-null term.
    """
    n = entries.where(F.col(term).isNotNull()).agg(F.count_distinct(record)).first()[0]
    return term_totals(entries, record, term, freq).select(
        "*",
        (F.col("total_freq") < rare_below).alias("rare"),
        (F.col("n_records") > F.lit(common_above * n)).alias("common"),
    )
