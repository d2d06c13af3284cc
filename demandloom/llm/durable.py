"""Where operators keep what they write between jobs."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Where the session names none (tests), a folder of the warehouse, which executors
    share as well; never a machine-local temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm_scratch"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """The same rows from the checkpoint folder: computed once, safe from lost executors."""
    scratch(df.sparkSession)
    return df.checkpoint(eager=True)


def parts_for(spark: SparkSession, amount: int, each: int) -> int:
    """Buckets of about ``each`` for ``amount``: grows with the input, and never fewer
    than the session's shuffle partitions, which all get work."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, math.ceil((amount or 0) / each))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a Parquet table in the shared folder, for tables that a
    checkpoint, which does not pack columns, would make much larger."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Within it, what a job shuffled goes when the job ends, and not when the driver happens to
    collect garbage; the session's setting comes back behind it. For jobs whose results are
    stored: what reads the shuffle of an ended job again works it out anew."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``fresh`` named, when nothing reads it any more."""
    if not path.startswith(scratch(spark) + "/"):
        raise ValueError(f"{path} is not in the scratch folder")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
