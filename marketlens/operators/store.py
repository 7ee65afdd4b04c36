"""Tables and folders that driver and executors share, and joins whose small side is checked."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most so many rows (of a few short columns) is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 500_000

#: Rows of a few short columns that one task sorts or groups at a time.
TASK_ROWS = 1_000_000


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset, a local master gets a folder of our own (its driver
    and executor are one process); on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark, path = df.sparkSession, folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked(small: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The side with a broadcast hint, if a count shows that it is small."""
    return F.broadcast(small) if small.limit(most + 1).count() <= most else small


def dealt(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """df dealt by keys, if it is large, over so many tasks that each gets about TASK_ROWS rows, whatever its size and the
    session's settings. What is grouped or joined by these keys next needs no other shuffle. rows: of df, else counted
    (which reads few columns of a scan)."""
    tasks = -(-(df.count() if rows is None else rows) // TASK_ROWS)
    return df.repartition(tasks, *keys) if tasks > 1 else df
