"""What the operators of this package share: tables, stored intermediates, checked broadcasts."""

from __future__ import annotations

import math
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.session import scratch_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Largest side that is broadcast, in bytes as counted before the broadcast.
BROADCAST_BYTES = 32 * 2**20


#: Bytes of a batch of rows that Spark hands to a task's Python function at once. The executor's native buffers for it and
#: the worker's texts, words and results of it are several times as large, for every task that runs, and stay reserved.
BATCH_BYTES = 6 * 2**20


#: Bytes of rows in a stored file, by estimate. A shuffle may have far more partitions than its rows make files, and a file
#: for each costs more than what it holds: where Hadoop's native library is missing, an executor even starts two processes
#: a file to set permissions, and each counts as a copy of the executor until it has loaded its program.
FILE_BYTES = 16 * 2**20


#: The folder that holds this package.
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def prepared(spark: SparkSession) -> SparkSession:
    """Let later queries' Python tasks find this package, wherever the application was started, and bound their batches.

    Batches of a bounded size keep long texts from adding up to much memory.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def files_for(size: int, least: int = 1, each: int = FILE_BYTES) -> int:
    """How many files of ``each`` bytes ``size`` bytes of rows fill."""
    return max(math.ceil(size / each), least)


def stored(df: DataFrame, label: str, size: int | None = None, each: int = FILE_BYTES) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors.

    With ``size``, an estimate of the rows' bytes, they are dealt out to files of that size together, ``each`` at most; else
    each partition with rows writes one.
    """
    spark = prepared(df.sparkSession)
    if size is not None:
        df = df.repartition(files_for(size, each=each))
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, row_bytes: int | Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its counted rows, of ``row_bytes`` each, fit the limit, else as it is.

    Without the mark the join shuffles both sides, and adaptive execution splits hot keys.
    ``df`` should be stored, for it is counted here.
    """
    size = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    total = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(df) if total <= limit else df


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(column, ASCII_UPPER, ASCII_UPPER.lower())
