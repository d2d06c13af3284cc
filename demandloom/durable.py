"""Cutting lineage in a way that outlives a lost executor."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, or none."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named and not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def durable(df: DataFrame) -> DataFrame:
    """The same rows, computed once where several branches read them.

    With a checkpoint folder they are written there, so that a lost executor re-reads
    files. Where the session names none nothing is written: rows stay in the session's
    storage, and what is lost is computed again from the lineage.
    """
    if checkpoint_dir(df.sparkSession) is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df.checkpoint(eager=True)


def release(df: DataFrame) -> None:
    """Free what ``durable`` keeps in the session's storage; checkpoints go with their frames."""
    if checkpoint_dir(df.sparkSession) is None:
        df.unpersist()
