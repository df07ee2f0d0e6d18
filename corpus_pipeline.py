"""From raw documents to packed training sequences: the stages of a corpus pipeline, in order.

Each stage takes what its predecessor kept, as stored in the shared folder, and all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import decontaminate, packing, simhash, suffix_dedup, toxicity
from fleetlake.llm.common import stored, table


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a stage that changes texts."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted to the labels, rejects go."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("grade"))
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that SimHash links, the one of the smallest id stays."""
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that several documents share stay in the one of the smallest id."""
    return _recounted(suffix_dedup.without_repeats(docs))


def cut_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut from all documents."""
    return _recounted(decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of all documents, in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", cut_benchmarks),
    ("packing", pack_sequences),
]

#: SQL can express neither the fitted model nor XXH64 or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *before, (_, last) = STAGES
    for name, stage in before:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
