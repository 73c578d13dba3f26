"""Session helpers: table access and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Only on a single machine, where none is named, a temporary one is set: the
    executors of a cluster could not read each other's parts of it.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lexmill-checkpoint-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back from there."""
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_rdd(spark: SparkSession, rdd: RDD) -> RDD:
    """``rdd`` written to the checkpoint folder, from where it is read henceforth."""
    _shared_folder(spark)
    rdd.checkpoint()
    rdd.count()
    return rdd


def write_table(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the checkpoint folder, and read back: smaller than a checkpoint, pruned by column."""
    path = f"{_shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_keyed(df: DataFrame, func: Callable, schema: str, *keys: str) -> DataFrame:
    """``mapInPandas`` that carries the columns ``keys`` as strings and gives them back as they were.

    Numbers with nulls among them would turn into floating point on the way.
    """

    def filled(batches: Iterator) -> Iterator:
        for out in func(batches):
            if len(out):  # an empty frame has no types
                yield out

    kinds = dict(df.dtypes)
    carried = ", ".join(f"{c.split()[0]} string" if c.split()[0] in keys else c for c in schema.split(", "))
    out = df.withColumns({k: F.col(k).cast("string") for k in keys}).mapInPandas(filled, carried)
    return out.withColumns({k: F.col(k).cast(kinds[k]) for k in keys})
