"""Work plans: outstanding archival work is written and committed before a lookup may be skipped for it.

A plan is a directory with ``requests/`` (one row for each request that is put off), ``files/`` (digests and lengths of
their data files) and ``manifest/`` (one row for each run with its counts). The requests are written first, read back and
checked against the request list; the manifest's marker is written last and commits the plan. Only a committed plan whose
files are as recorded may defer anything, and a plan that could not be written stops its runs before any lookup.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from barledger.operators import ledger
from barledger.operators.artifacts import verify_checksums
from barledger.sources.evidence import file_digests, is_committed, write_manifest

ROWS_PER_FILE = 1_000_000


class PlanNotCommitted(ValueError):
    """There is no plan, or one that was not finished, or one whose files have changed."""


class PlanPersistenceFailed(RuntimeError):
    """The plan was not written. ``coverage`` accounts for the runs that stop here: nothing deferred, nothing looked up."""

    def __init__(self, coverage: DataFrame):
        super().__init__("the archival plan was not persisted; no lookup may be deferred without it")
        self.coverage = coverage


def _files(spark: SparkSession, root: str) -> DataFrame:
    name = F.substring_index("path", f"{root.rsplit('/', 1)[-1]}/", -1)
    return file_digests(spark, f"{root}/requests").select(name.alias("file"), "sha256", "bytes")


def write_plan(requested: DataFrame, worklist: DataFrame, root: str, metadata: Mapping[str, str]) -> str:
    """Write and commit the ``worklist`` of (run_id, ordinal, symbol) ``requested`` under a new ``root``.

    An item whose identity was not requested, or a second one for a request, is an error and leaves the plan uncommitted.
    """
    spark, root = requested.sparkSession, root.rstrip("/")
    worklist.write.mode("errorifexists").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{root}/requests")
    stored = spark.read.schema(worklist.schema).parquet(f"{root}/requests")
    items = stored.groupBy("run_id", F.col("provider_symbol").alias("symbol")).agg(F.count(F.lit(1)).alias("items"))
    odd = items.join(requested.select("run_id", "symbol"), ["run_id", "symbol"], "left_anti").unionByName(items.where("items > 1"))
    if not odd.isEmpty():
        raise ValueError("The worklist names identities that were not requested, or one of them twice")
    _files(spark, root).write.mode("errorifexists").json(f"{root}/files")
    counts = ledger.archival_plan(requested, stored).select(
        "*", *[F.lit(value).alias(name) for name, value in metadata.items()], F.lit(1).alias("schema_version")
    )
    write_manifest(counts, f"{root}/manifest")
    return root


def read_plan(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Requests and manifest rows of a committed plan whose files are the recorded ones."""
    root = root.rstrip("/")
    if not is_committed(spark, root):
        raise PlanNotCommitted(f"No committed plan at {root}")
    recorded = spark.read.schema("file string, sha256 string, bytes bigint").json(f"{root}/files")
    if not verify_checksums(recorded, _files(spark, root)).where("status <> 'verified'").isEmpty():
        raise PlanNotCommitted(f"Files of the plan at {root} are not those it was committed with")
    return spark.read.parquet(f"{root}/requests"), spark.read.json(f"{root}/manifest")


def defer_by_plan(requested: DataFrame, root: str) -> DataFrame:
    """``requested`` with ``deferred``: whether the committed plan at ``root`` holds the request."""
    rows, _ = read_plan(requested.sparkSession, root)
    held = rows.select("run_id", F.col("provider_symbol").alias("symbol"), F.lit(True).alias("__held"))
    base = requested.drop("deferred")
    return base.join(held, ["run_id", "symbol"], "left").select(
        *base.columns, F.coalesce("__held", F.lit(False)).alias("deferred")
    )


def planned_ledger(requested: DataFrame, outcomes: DataFrame, root: str, **options) -> DataFrame:
    """The price ledger, in which nothing but the committed plan at ``root`` defers a lookup."""
    return ledger.price_ledger(defer_by_plan(requested, root), outcomes, **options)


def plan_or_stop(requested: DataFrame, worklist: DataFrame, root: str, metadata: Mapping[str, str]) -> str:
    """write_plan(); any failure becomes PlanPersistenceFailed with the coverage of the runs it stops."""
    try:
        return write_plan(requested, worklist, root, metadata)
    except Exception as error:
        raise PlanPersistenceFailed(ledger.unplanned_coverage(requested, worklist)) from error
