"""A corpus pipeline of five stages over ``documents``, each one of the operators in ``tablewright.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import decontamination, mixing, near_duplicates, pii, quality
from tablewright.llm.common import table
from tablewright.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled cutoffs."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: four fifths of their shingles of five words are shared."""
    return near_duplicates.deduplicate(docs, size=5)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than one word in twenty inside a benchmark window."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced by its kind."""
    return pii.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents by source weight, in random order, with copy and shuffle_key."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("personal data", personal_data),
    ("source mixing", source_mixing),
]

#: The risk-controlled cutoffs and the component search have no SQL twin; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet in the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
