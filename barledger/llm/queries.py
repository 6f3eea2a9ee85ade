"""One registered query for each corpus operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barledger.llm import (
    decontamination, license_scan, near_dedup, packing, prefix_trie, quality_model, quality_rules, secret_scan, spelling,
    suffix_dedup, toxicity, url_filter, warc,
)
from barledger.llm.oracle import ORACLES
from barledger.llm.shared import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("evidence", F.transform("evidence", lambda e: e["doc_id"]))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.group(table(spark, sf_dir, "documents"), width=3, percent=85)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.scan(table(spark, sf_dir, "documents")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.report(decontamination.contamination(docs, benchmark))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents has no path; a document lies in a directory of its source by hundreds and ten thousands of its id."""
    parts = [F.col("source"), *((F.col("doc_id") / n).cast("long").cast("string") for n in (10_000, 100)), F.col("doc_id")]
    found = license_scan.scan(table(spark, sf_dir, "documents"), F.concat_ws("/", *(p.cast("string") for p in parts)))
    return found.withColumn("cosine", F.round("cosine", 6))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url", "archive", "position")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents")).drop("host")
    return judged.withColumn("host_rate", F.round("host_rate", 9))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(suffix_dedup.cut_texts(table(spark, sf_dir, "documents")))


#: The rules of op11_url_filter.
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), borrow=True)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"), noise=199)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_near_dedup": op2_near_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_packing": op4_packing,
    "op5_quality_model": op5_quality_model,
    "op6_decontamination": op6_decontamination,
    "op7_license_scan": op7_license_scan,
    "op8_warc": op8_warc,
    "op9_quality_rules": op9_quality_rules,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_url_filter": op11_url_filter,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling": op13_spelling,
}

__all__ = ["ORACLES", "REGISTRY"]
