"""The operators as named queries over the test tables, with SQL where it can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import (
    decontamination, fill_in_middle, licenses, merkle, mixing, near_duplicates, pii, quality, simhash, substrings, token_counts,
    toxicity, warc,
)
from tablewright.llm.common import table
from tablewright.llm.oracles import (
    DECONTAMINATION_SQL, FILL_IN_MIDDLE_SQL, MERKLE_SQL, MIXING_SQL, NEAR_DUPLICATES_SQL, SUBSTRINGS_SQL, WARC_SQL, license_sql,
)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop(
        "hit_chars"
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(back).alias("restored_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_source_mixing": op2_source_mixing,
    "op3_license_scan": op3_license_scan,
    "op4_personal_data": op4_personal_data,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_warc_round_trip": op8_warc_round_trip,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_simhash_near_dedup": op11_simhash_near_dedup,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_merkle_manifest": op13_merkle_manifest,
}

LLM_ORACLES: dict[str, str] = {
    "op2_source_mixing": MIXING_SQL,
    "op5_benchmark_decontamination": DECONTAMINATION_SQL,
    "op3_license_scan": license_sql(licenses.KNOWN),
    "op6_substring_dedup": SUBSTRINGS_SQL,
    "op8_warc_round_trip": WARC_SQL,
    "op9_minhash_near_dedup": NEAR_DUPLICATES_SQL,
    "op12_fill_in_middle": FILL_IN_MIDDLE_SQL,
    "op13_merkle_manifest": MERKLE_SQL,
}
