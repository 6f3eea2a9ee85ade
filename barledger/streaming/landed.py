"""Audit landed price files as a stream.

A frame may come in several files and batches, and its verdict and the duplicate-day rule need all of it. What that takes
is kept as counts: per frame the rows by reason, per frame and day the rows and how many of them would pass. A batch judges
the rows it brought, adds its counts to those of the frames it touched and gives these frames new verdicts. It reads its
own rows and the counts of its own frames, whatever else has landed; rows that came before are not read or written again.

Each batch writes under its own number and replaces that when it is run again, which makes the sink exactly-once: a batch
never reads what later ones brought.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from barledger import fixed_values as fv
from barledger.operators.audit import FRAME_KEYS, REASON_COUNTS, audit_rows, numeric_only, verdicts_of_counts
from barledger.sources.lines import number_lines
from barledger.sources.prices import frames_of_lines

FRAME_SCHEMA = (
    "run_id string, symbol string, row_position bigint, ts timestamp_ntz, open double, high double, "
    "low double, close double, adj_close double, volume double"
)
REPEATED = "duplicate_date"
DAY_COUNTS = ("rows", "plain", "clean", "other")
# A run's frames are dealt to so many directories of counts, so that a batch opens few of a large run's.
SLOTS = 256


def stream_frames(spark: SparkSession, landing: str, schema: str = FRAME_SCHEMA) -> DataFrame:
    """Rows of frames that land as typed tables."""
    return spark.readStream.schema(schema).parquet(landing)


def stream_lines(spark: SparkSession, landing: str, pattern: str = "*.csv", files_per_batch: int = 10_000) -> DataFrame:
    """Lines of price files; a batch holds whole files, each with its header."""
    text = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option(
        "maxFilesPerTrigger", files_per_batch
    ).text(landing)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"),
    )


def frames_of_batch(lines: DataFrame, symbol: str = r"^(.*)\.csv$") -> DataFrame:
    """Frames of one batch of stream_lines(), with the faults of each file; a file's directory is its run."""
    numbered = number_lines(lines)
    return frames_of_lines(numbered, F.element_at(F.split("file", "/"), -2), symbol)


def _slot() -> Column:
    """The directory of a frame's counts: a digest of its run, and a part of the run by symbol."""
    part = F.hex(F.pmod(F.xxhash64("symbol"), F.lit(SLOTS)))
    return F.concat_ws("-", F.substring(F.sha2(F.coalesce("run_id", F.lit("")), 256), 1, 24), part)


def day_counts(audited: DataFrame) -> DataFrame:
    """Per frame and day: rows, those without a frame fault, and of these the ones that pass or have a reason beside their
    numbers, repeated days aside."""
    frame_fault = F.arrays_overlap("reasons", F.array(*[F.lit(r) for r in fv.FRAME_REASONS]))
    alone = F.array_remove("reasons", REPEATED)
    return audited.groupBy(*FRAME_KEYS, "session_date").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~frame_fault).alias("plain"),
        F.count_if(~frame_fault & (F.size(alone) == 0)).alias("clean"),
        F.count_if(~frame_fault & ~numeric_only(alone)).alias("other"),
    )


def reason_counts(audited: DataFrame) -> DataFrame:
    """Per frame: rows by reason, repeated days aside."""
    return audited.groupBy(*FRAME_KEYS).agg(*[
        F.count_if(F.array_contains("reasons", reason)).alias(name) for reason, name in REASON_COUNTS.items() if reason != REPEATED
    ])


def combined(days: DataFrame, reasons: DataFrame) -> DataFrame:
    """Verdicts of frames from all their counts: a day that has two rows or more rejects all of them."""
    summed = days.groupBy(*FRAME_KEYS, "session_date").agg(*[F.sum(name).alias(name) for name in DAY_COUNTS])
    repeated = F.col("session_date").isNotNull() & (F.col("rows") > 1)
    frames = summed.groupBy(*FRAME_KEYS).agg(
        F.sum("rows").alias("frame_rows"),
        F.sum(F.when(repeated, 0).otherwise(F.col("clean"))).alias("usable_rows"),
        F.sum(F.col("rows") - F.col("plain") + F.when(repeated, F.col("plain")).otherwise(F.col("other"))).alias("other_rows"),
        F.sum(F.when(repeated, F.col("plain")).otherwise(0)).alias(REASON_COUNTS[REPEATED]),
    )
    others = [name for reason, name in REASON_COUNTS.items() if reason != REPEATED]
    by_reason = reasons.groupBy(*FRAME_KEYS).agg(*[F.sum(name).alias(name) for name in others])
    return verdicts_of_counts(frames.join(by_reason, list(FRAME_KEYS)))


def start_audit(
    frames: DataFrame, output: str, checkpoint: str, start: date, end: date, *, available_now: bool = True,
    frames_of: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write ``rows/batch=…`` (by acceptance), ``counts/…`` and ``verdicts/batch=…`` for every batch.

    ``frames`` are rows of frames, or lines that ``frames_of`` (frames_of_batch) makes frames of; then a file's faults reject
    its rows and its frame.
    """

    def audit_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        brought = frames_of(batch) if frames_of else batch
        audited = audit_rows(
            brought, start, end, frame_errors="frame_errors" if "frame_errors" in brought.columns else None
        )
        rows = f"{output}/rows/batch={batch_id}"
        audited.write.mode("overwrite").partitionBy("accepted").parquet(rows)
        stored = spark.read.schema(audited.schema).parquet(rows)
        if stored.isEmpty():
            return
        now = {}
        for what, counted in (("days", day_counts(stored)), ("reasons", reason_counts(stored))):
            path = f"{output}/counts/{what}"
            counted.withColumns({"slot": _slot(), "batch": F.lit(batch_id)}).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("slot", "batch").parquet(path)
            # only the directories of frames that this batch has are listed or read
            slots = [r["slot"] for r in stored.select(_slot().alias("slot")).distinct().collect()]
            kept = spark.read.option("basePath", path).schema(
                T.StructType([*counted.schema, T.StructField("slot", T.StringType()), T.StructField("batch", T.LongType())])
            ).parquet(*[f"{path}/slot={slot}" for slot in slots])
            touched = stored.select(*[F.coalesce(k, F.lit("")).alias(f"__{k}") for k in FRAME_KEYS]).distinct()
            mine = [F.coalesce(k, F.lit("")) == F.col(f"__{k}") for k in FRAME_KEYS]
            now[what] = kept.where(F.col("batch") <= batch_id).join(touched, mine, "left_semi").drop("slot", "batch")
        verdicts = combined(now["days"], now["reasons"]).withColumn("historical_completeness", F.lit(fv.NOT_VERIFIED))
        verdicts.write.mode("overwrite").parquet(f"{output}/verdicts/batch={batch_id}")

    writer = frames.writeStream.foreachBatch(audit_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current(spark: SparkSession, output: str, what: str = "verdicts") -> DataFrame:
    """``verdicts`` as they hold now, each frame's last one; or all ``rows`` with the days that later batches repeated."""
    if what == "verdicts":
        verdicts = spark.read.parquet(f"{output}/verdicts")
        last = verdicts.groupBy(*FRAME_KEYS).agg(F.max("batch").alias("batch"))
        return verdicts.join(last, [*FRAME_KEYS, "batch"], "left_semi")
    rows = spark.read.parquet(f"{output}/rows")
    days = spark.read.parquet(f"{output}/counts/days").groupBy(*FRAME_KEYS, "session_date").agg(F.sum("rows").alias("__n"))
    repeated = days.where("session_date IS NOT NULL AND __n > 1").withColumn("__repeated", F.lit(True)).drop("__n")
    joined = rows.join(repeated, [*FRAME_KEYS, "session_date"], "left")
    plain = ~F.arrays_overlap("reasons", F.array(*[F.lit(r) for r in fv.FRAME_REASONS]))
    late = F.coalesce(F.col("__repeated") & plain & ~F.array_contains("reasons", REPEATED), F.lit(False))
    added = F.filter(
        F.array(*[F.lit(r) for r in fv.ALL_REASONS]), lambda r: F.array_contains(F.array_append("reasons", REPEATED), r)
    )
    return joined.withColumns({
        "reasons": F.when(late, added).otherwise(F.col("reasons")), "accepted": F.col("accepted") & ~late,
    }).select(*rows.columns)
