"""CSV data sets and relational sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; the declared schema saves the pass that would infer one."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in place of what was there; timestamps keep their microseconds."""
    writer = df.write.mode("overwrite").option("header", True)
    writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 8,
    **options: str,
) -> DataFrame:
    """A database table over JDBC; with ``split_on`` and ``bounds`` it is read in parallel ranges."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split_on and bounds:
        reader = reader.options(
            partitionColumn=split_on, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=str(partitions)
        )
    return reader.load()
