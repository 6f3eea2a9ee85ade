"""Evidence bundles: immutable data, typed rejections, file checksums, manifest last.

A bundle is a directory with ``frame/`` (all rows, partitioned by acceptance), ``rejected/``
(JSON lines), ``positions/``, ``files/`` and ``manifest/``. The manifest is written last and only
bundles that have one count. Every step reads what the step before it wrote, so a lost executor
costs a recomputed partition and never a rerun of the audit.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barledger import fixed_values as fv
from barledger.operators.artifacts import verify_checksums
from barledger.operators.audit import frame_verdicts, rejected_rows, usable_positions

# A data file is hashed as one value of at most 2 GB, so files are far smaller: a row of evidence with
# all its cells has some hundreds of bytes before compression.
ROWS_PER_FILE = 200_000
PARTS = ("frame", "rejected", "positions")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 and length of every data file under ``path``."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    )


def bundle_files(spark: SparkSession, root: str) -> DataFrame:
    """``file`` (below the root), ``sha256``, ``bytes`` and ``rows`` of every data file of a bundle's parts."""
    found = None

    def below(path: Column) -> Column:
        """The part of a path below the root: a task's files of several partitions share a name, not a directory."""
        return F.substring_index(F.url_decode(path), f"{root.rsplit('/', 1)[-1]}/", -1)

    for part in PARTS:
        path = f"{root}/{part}"
        reader = spark.read.option("recursiveFileLookup", True)
        # rows are counted from what was written, without reading a value of them
        # by the path as it is, which is decoded once a file and not once a row
        counted = (reader.text(path) if part == "rejected" else reader.parquet(path)).groupBy(
            F.col("_metadata.file_path").alias("path")
        ).agg(F.count(F.lit(1)).alias("rows"))
        rows = counted.select(below(F.col("path")).alias("file"), "rows")
        digests = file_digests(spark, path).select(below(F.col("path")).alias("file"), "sha256", "bytes")
        joined = digests.join(rows, "file", "left").select("file", "sha256", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"))
        found = joined if found is None else found.unionByName(joined)
    return found


def write_bundle(audited: DataFrame, root: str, metadata: Mapping[str, str]) -> str:
    """Write one observation's bundle under a new ``root`` and commit it with its manifest.

    ``metadata`` carries at least run, attempt and retrieval time. An existing ``root`` is an
    error: observations are never overwritten.
    """
    spark = audited.sparkSession
    root = root.rstrip("/")
    audited.write.mode("errorifexists").option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy("accepted").parquet(
        f"{root}/frame"
    )
    stored = spark.read.schema(audited.schema).parquet(f"{root}/frame")
    rejected_rows(stored).write.mode("errorifexists").option("maxRecordsPerFile", ROWS_PER_FILE).option(
        "compression", "gzip"
    ).json(f"{root}/rejected")
    usable_positions(stored).write.mode("errorifexists").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(
        f"{root}/positions"
    )
    bundle_files(spark, root).write.mode("errorifexists").json(f"{root}/files")

    manifest = frame_verdicts(stored).select(
        "*",
        *[F.lit(value).alias(name) for name, value in metadata.items()],
        F.lit(1).alias("schema_version"),
        F.lit("price_rejection_evidence_not_a_complete_dataset").alias("kind"),
        F.lit(fv.NOT_VERIFIED).alias("historical_completeness"),
        F.lit(False).alias("collector_admission"),
        F.array(*[F.lit(dtype) for _, dtype in stored.drop("reasons", "accepted", "session_date").dtypes]).alias(
            "column_dtypes"
        ),
    )
    manifest.write.mode("errorifexists").json(f"{root}/manifest")
    return root


def is_committed(spark: SparkSession, root: str) -> bool:
    """Whether the manifest's writer finished: its marker is there, and a row of the manifest."""
    manifest = f"{root.rstrip('/')}/manifest"
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{manifest}/_SUCCESS")
    if not marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker):
        return False
    try:
        return not spark.read.schema("schema_version int").json(manifest).isEmpty()
    except AnalysisException:
        return False


def read_bundle(spark: SparkSession, root: str) -> DataFrame:
    """All rows of a committed bundle; without a manifest there is no bundle."""
    if not is_committed(spark, root):
        raise ValueError("Bundle has no manifest")
    return spark.read.parquet(f"{root.rstrip('/')}/frame")


def verify_bundle(spark: SparkSession, root: str) -> DataFrame:
    """Status of every recorded or present data file of a bundle."""
    root = root.rstrip("/")
    recorded = spark.read.schema("file string, sha256 string, bytes bigint").json(f"{root}/files")
    present = None
    for part in PARTS:
        found = file_digests(spark, f"{root}/{part}")
        present = found if present is None else present.unionByName(found)
    relative = F.substring_index(F.url_decode("path"), f"{root.rsplit('/', 1)[-1]}/", -1)
    return verify_checksums(recorded, present.select(relative.alias("file"), "sha256", "bytes"))


def write_manifest(plan: DataFrame, path: str) -> None:
    """Commit a work plan or a run summary as JSON; an existing one is never replaced."""
    plan.write.mode("errorifexists").json(path)
