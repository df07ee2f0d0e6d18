"""Session settings and the shared folder used for scratch data."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "fleetlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; pass ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def sizing(data_bytes: int, partition_bytes: int = 256 * 2**20, most: int | None = None) -> dict[str, str]:
    """SQL settings for a job over about ``data_bytes`` of input.

    Adaptive execution merges small shuffle partitions but, joins apart, does not split
    large ones, so their number has to fit the data from the start: one for each
    ``partition_bytes``, and 200 at least. Every map task writes one block per partition; where a
    cluster's shuffle service bears only so many, ``most`` bounds their number, and partitions
    grow beyond ``partition_bytes`` and spill.
    """
    width = max(math.ceil(data_bytes / partition_bytes), 200)
    return {
        "spark.sql.shuffle.partitions": str(width if most is None else min(width, most)),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
    }


def size_for(spark: SparkSession, data_bytes: int, **limits: int) -> SparkSession:
    """Apply :func:`sizing` to a running session."""
    for key, value in sizing(data_bytes, **limits).items():
        spark.conf.set(key, value)
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """All naive timestamps in the lake are UTC, so casts between the two types must be too."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset, scratch lies below the warehouse folder, which a cluster shares as well.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared folder; it goes when the application ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def kept(df: DataFrame, label: str = "kept") -> DataFrame:
    """``df`` stored in the shared folder, so that what several steps read is computed once and stays as it is."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
