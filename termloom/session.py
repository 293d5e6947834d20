"""Sessions and the shared folder in which lineage is cut."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "termloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; anything set outside (spark-submit) wins where not named here."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }.items():
        b = b.config(k, v)
    return b.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """``df`` over as many tasks as shuffles have, for work that is large against its bytes: adaptive execution merges
    partitions by their bytes alone and leaves these as they are."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def large(df: DataFrame) -> DataFrame:
    """``df`` for a join of two sides that both grow with the data: joined by sorting, whatever sizes are estimated.  (An
    array counts as one element in Spark's estimates, so a broadcast may be chosen that no driver can hold.)"""
    return df.hint("merge")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.  Where it is unset a folder of this machine is used in local mode
    (tests, a laptop); elsewhere, where executors couldn't read each other's files, that is an error."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "termloom-checkpoints")


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder where all executors can write; it is deleted at the end."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        delete(spark, path)


def delete(spark: SparkSession, *paths: str) -> None:
    """Deletes these folders of the shared file system, where they exist."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Lets go of the shuffle files of plans that no one holds any more.  Spark deletes them when the driver's garbage is
    collected, which may be long after, while the next step fills the disk."""
    for _ in range(2):  # what ended just now may still be told to listeners when the first one begins
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.1)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once to the checkpoint folder that all executors share, so that a lost executor costs
    no recomputation and two readers cost one run."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
