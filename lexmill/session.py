"""Sessions, and tables cut from their lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(name: str = "lexmill", **conf: str) -> SparkSession:
    """A session with the settings that the operators expect; settings given win, and a cluster's own stay."""
    builder = SparkSession.builder.appName(name)
    usual = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for k, v in {**usual, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir`` or the one that was set for checkpoints; only a local session may do without, and has a temporary one."""
    sc = spark.sparkContext
    given = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not given and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (given or tempfile.mkdtemp(prefix="lexmill-checkpoint-")).rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: read again as it is, also after the loss of an executor.

    Spark deletes it with the last use of the result where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores if it comes in fewer partitions than there are cores (a few small files); else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df
