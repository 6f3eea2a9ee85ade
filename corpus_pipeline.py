"""From documents to packed token sequences: five stages, each written as Parquet and read by the next one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barledger.llm import decontamination, near_dedup, packing, quality_rules, secret_scan
from barledger.llm.queries import tokenizer_path
from barledger.llm.shared import SMALL_ROWS, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def row_key() -> Column:
    """A hash of what the rules and near-dedup read of a row: rows that share it are alike and get one verdict."""
    return F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull(), "source", F.col("source").isNull())


def without(docs: DataFrame, rejected: DataFrame, key: Column) -> DataFrame:
    """docs without the rows whose key is among the rejected (gone); broadcast only if a count finds them few."""
    gone = stored(rejected.select("gone").distinct(), "gone")
    few = gone.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
    keyed = docs.select(*COLUMNS, key.alias("gone"))
    return keyed.join(F.broadcast(gone) if few else gone, "gone", "left_anti").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules reject, for themselves or their host, go; others with the same id stay."""
    judged = quality_rules.judge(docs.select(row_key().alias("row"), "text", "source"), id_col="row")
    return without(docs, judged.where(~F.col("kept")).select(F.col("doc_id").alias("gone")), row_key())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group (five words, similarity 0.8) the rows with the smallest id stay; rows outside it keep their own verdict."""
    grouped = near_dedup.keyed_groups(docs, "doc_id", "text", near_dedup.WIDTH, near_dedup.PERCENT)
    id_and_text = lambda text: F.xxhash64("doc_id", F.col("doc_id").isNull(), text)
    rejected = grouped.where(~F.col("kept")).select(id_and_text("key").alias("gone"))
    return without(docs, rejected, id_and_text(near_dedup.text_key("text")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out of the texts; all documents stay."""
    cut = decontamination.cleaned(docs, table(spark, sf_dir, "benchmark"))
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; all documents stay."""
    scanned = secret_scan.scan(docs, others=F.struct("lang", "source"))
    text = secret_scan.redacted(F.col("text"), F.col("spans"))
    return scanned.select("doc_id", text.alias("text"), "others.lang", "others.source").withColumn(
        "n_chars", F.length("text").cast("bigint")
    ).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of tokens."""
    return packing.pack(docs, tokenizer_path()).drop("ids")


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", secrets),
    ("packing", pack),
]
#: SQL can't express the tokenizer and the curve; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
