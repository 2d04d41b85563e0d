"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import materialise


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the session's shared checkpoint folder, so later reads survive a lost executor."""
    return materialise(df)


FEW_ROWS = 100_000
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session sends Python workers at most 16 MB at a time from now on, unless it has a size of its own.

    Texts differ much in length; Spark's 64 MB are held several times over on both sides of the pipe.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_BYTES, None) is None:
        conf.set(BATCH_BYTES, "16m")
    return df


def few(df: DataFrame, most: int = FEW_ROWS) -> DataFrame:
    """``df`` materialised, and marked to be broadcast if it has at most ``most`` (short) rows; else a join shuffles it."""
    held = cut(df)
    return F.broadcast(held) if held.limit(most + 1).count() <= most else held


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and leave every other character alone."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
