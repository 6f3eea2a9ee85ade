"""What the corpus operators share: tables in the shared folder, bounded Arrow batches, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barledger.sources import scratch

#: Rows of text in an Arrow batch that goes to Python; with texts of 100 KB a batch stays below 30 MB.
TEXT_ROWS = 256
#: Rows of a table of keys with a few numbers each that may be broadcast, and at which another join is taken.
SMALL_ROWS = 50_000


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir; a cluster without one is an error."""
    return scratch.shared_folder(spark, "llm")


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """df, written once to the shared folder and read back: lineage ends there, lost executors cost nothing before it."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Arrow batches of the session hold at most so many rows, so that a task holds a bounded number of texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str, rows: int = SMALL_ROWS) -> DataFrame:
    """left joined with a table of keys; right is broadcast only if a count finds it small."""
    small = right.limit(rows + 1).count() <= rows
    return left.join(F.broadcast(right) if small else right, on, how)


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod modulus; null stays null."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % modulus


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
