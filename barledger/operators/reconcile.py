"""Compare source rows with adapter rows, date by date and cell by cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from barledger import fixed_values as fv
from barledger.functions.market import day_bit
from barledger.functions.values import held

SCOPE_KEYS = ("symbol", "start")
# Adapter columns in the order of the source's fields.
ADAPTER_COLUMNS = dict(zip(fv.CHART_FIELDS, ("open", "high", "low", "close", "volume", "adj_close")))


def adapter_frame_errors(adapter: DataFrame, *, keys: Sequence[str] = SCOPE_KEYS, time: str = "ts") -> DataFrame:
    """One row per adapter frame with ``adapter_error``: null when its dates identify its rows.

    A frame's days are bits of one number for every 64 days, and more dated rows than days make it ambiguous or duplicate.
    Copies of an instant are counted before and after a shuffle of their own, from which only frames that have some go on,
    so no task holds counts of instants and of days at once.
    """
    keys = list(keys)
    missing = [name for name in ADAPTER_COLUMNS.values() if name not in adapter.columns]
    if missing or len(set(adapter.columns)) != len(adapter.columns):
        return adapter.select(*keys).distinct().withColumn("adapter_error", F.lit("ambiguous_adapter_frame"))
    day = F.to_date(time)
    block, bit = day_bit(day)
    blocks = adapter.groupBy(*keys, block.alias("__block")).agg(
        F.count(F.lit(1)).alias("__rows"), F.count(day).alias("__dated"), F.bit_or(bit).alias("__days"),
    ).withColumn("__copied", F.lit(False))
    instants = adapter.where(F.col(time).isNotNull()).groupBy(*keys, time).agg(F.count(F.lit(1)).alias("__copies"))
    none = F.lit(0).cast("bigint")
    copied = instants.where(F.col("__copies") > 1).select(*keys).distinct().select(
        *keys, none.alias("__rows"), none.alias("__dated"), none.alias("__days"), F.lit(True).alias("__copied"),
    )
    frames = blocks.drop("__block").unionByName(copied).groupBy(*keys).agg(
        F.sum("__rows").alias("adapter_rows"), F.sum("__dated").alias("__dated"),
        F.sum(F.bit_count(F.coalesce("__days", none))).alias("__days"), F.bool_or("__copied").alias("__copied"),
    )
    return frames.select(
        *keys, "adapter_rows",
        F.when((F.col("__dated") < F.col("adapter_rows")) | F.col("__copied"), F.lit("ambiguous_adapter_frame"))
        .when(F.col("__dated") > F.col("__days"), F.lit("duplicate_adapter_dates"))
        .alias("adapter_error"),
    )


def _joined_sides(left: DataFrame, right: DataFrame, keys: list[str], known_only: bool) -> DataFrame:
    """Both sides by date; with ``known_only`` only frames that the source has, be it by a row without a date.

    The rows are those of a full outer join by keys and date, which would move both sides by all of these. The sides are
    laid on each other instead, so that sides whose frames are together stay where they are: a row of the adapter takes the
    source's rows of its date, and a row of the source stays if there is none.
    """
    rows = left.withColumn("__adapter", F.lit(None).cast(right.schema["__adapter"].dataType)).unionByName(
        right.withColumn("__source", F.lit(None).cast(left.schema["__source"].dataType))
    )
    # rows that lack a part of their key meet none of the other side
    lacking = F.lit(False)
    for name in (*keys, "date"):
        lacking = lacking | F.col(name).isNull()
    rows = rows.withColumn("__apart", held(F.when(lacking, F.col("__source").isNotNull())))
    if known_only:
        # in the order of the dates, so that these need no other one
        frame = Window.partitionBy(*keys).orderBy("date", "__apart").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        rows = rows.withColumn("__known", F.max(F.col("__source").isNotNull()).over(frame))
        rows = rows.where(F.col("__known") & F.col("date").isNotNull())
    dated = Window.partitionBy(*keys, "date", "__apart")
    met = rows.withColumns({"__sources": F.collect_list("__source").over(dated), "__adapters": F.count("__adapter").over(dated)})
    alone = F.col("__adapter").isNull()
    return met.where(~alone | (F.col("__adapters") == 0)).select(
        *keys, "date", F.explode_outer(F.when(alone, F.array("__source")).otherwise(F.col("__sources"))).alias("__source"),
        "__adapter",
    )


def reconcile_dates(
    source: DataFrame, adapter: DataFrame, *, keys: Sequence[str] = SCOPE_KEYS, known_only: bool = False,
) -> DataFrame:
    """Every date of either side with where it was seen: ``both``, or one side only.

    With ``known_only`` adapter frames without a source document are left out.
    """
    left = source.select(*keys, "date", F.lit(True).alias("__source"))
    right = adapter.select(*keys, "date", F.lit(True).alias("__adapter"))
    return _joined_sides(left, right, list(keys), known_only).select(*keys, "date", _date_class().alias("classification"))


def _date_class() -> Column:
    return (
        F.when(F.col("__source").isNull(), F.lit("adapter_only_date"))
        .when(F.col("__adapter").isNull(), F.lit("source_only_date"))
        .otherwise(F.lit("both"))
    )


def reconcile_cells(
    source: DataFrame, adapter: DataFrame, *, keys: Sequence[str] = SCOPE_KEYS, known_only: bool = False,
) -> DataFrame:
    """One row per cell of the dates both sides have, and one row per date only one side has.

    With ``known_only`` adapter frames without a source document are left out.

    ``source`` has the six source fields per (keys, date), ``adapter`` the adapter columns. The
    sides are joined once per date and only then spread into cells.
    """
    keys = list(keys)
    left = source.select(*keys, "date", F.struct(*[F.col(f).cast("double").alias(f) for f in fv.CHART_FIELDS]).alias("__source"))
    right = adapter.select(
        *keys, "date",
        F.struct(*[F.col(c).cast("double").alias(f) for f, c in ADAPTER_COLUMNS.items()]).alias("__adapter"),
    )
    joined = _joined_sides(left, right, keys, known_only).withColumn("__class", _date_class())
    cells = F.array(*[_compared_cell(field) for field in fv.CHART_FIELDS])
    one_sided = F.array(_cell_record(F.lit(None).cast("string"), F.lit(None).cast("double"),
                                     F.lit(None).cast("double"), F.col("__class")))
    return joined.select(
        *keys, "date", F.explode(F.when(F.col("__class") == "both", cells).otherwise(one_sided)).alias("__cell")
    ).select(*keys, "date", "__cell.*")


def _cell_record(field: Column, source: Column, adapter: Column, classification: Column) -> Column:
    return F.struct(
        field.alias("field"), source.alias("source_value"), adapter.alias("adapter_value"),
        classification.alias("classification"),
    )


def _compared_cell(field: str) -> Column:
    source = F.col(f"__source.{field}")
    raw = F.col(f"__adapter.{field}")
    adapter = F.when(~F.isnan(raw), raw)
    classification = (
        F.when(source.isNull() & adapter.isNull(), F.lit("missing_in_source_and_frame"))
        .when(source.isNull(), F.lit("source_missing_adapter_changed"))
        .when(adapter.isNull(), F.lit("adapter_only_missing"))
        .when(source == adapter, F.lit("agree"))
        .otherwise(F.lit("value_changed"))
    )
    return _cell_record(F.lit(field), source, adapter, classification)


def comparison_counts(comparisons: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    return comparisons.groupBy(*keys, "classification").agg(F.count(F.lit(1)).alias("cells"))


def nonfinite_frames(comparisons: DataFrame, *, keys: Sequence[str] = SCOPE_KEYS) -> DataFrame:
    """Frames with an infinite adapter value in a compared cell; such a comparison is void."""
    infinite = F.abs(F.col("adapter_value")) == float("inf")
    return comparisons.where(infinite).select(*keys).distinct().withColumn("nonfinite", F.lit(True))


def boundary_probe(
    scopes: DataFrame, documents: DataFrame, adapter_errors: DataFrame, verdicts: DataFrame,
    comparisons: DataFrame, *, keys: Sequence[str] = SCOPE_KEYS,
) -> DataFrame:
    """One row per probed scope: complete or not, the first error code, and the overall pass.

    ``documents`` are matching responses with ``status_code`` and ``chart_code`` (null when the
    body decoded). A complete observation passes only if the frame's own audit passed.
    """
    keys = list(keys)
    responses = documents.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("responses"),
        F.count_if((F.col("status_code") == 200) & F.col("chart_code").isNull()).alias("valid_responses"),
        F.min("chart_code").alias("decode_code"),
    )
    compared = comparisons.groupBy(*keys).agg(
        F.count_if(F.col("classification") == "agree").alias("agreeing_cells"),
        F.count_if(F.col("classification") != "agree").alias("differing_cells"),
        F.count_if(F.abs(F.col("adapter_value")) == float("inf")).alias("__nonfinite"),
    )
    joined = (
        scopes.join(responses, keys, "left")
        .join(adapter_errors, keys, "left")
        .join(verdicts.select(*keys, "passed"), keys, "left")
        .join(compared, keys, "left")
    )
    one_valid = F.coalesce((F.col("responses") == 1) & (F.col("valid_responses") == 1), F.lit(False))
    error = (
        F.when(~one_valid, F.lit("expected_one_valid_matching_response"))
        .when(F.col("adapter_rows").isNull(), F.lit("expected_one_adapter_frame"))
        .when(F.col("adapter_error").isNotNull(), F.col("adapter_error"))
        .when(F.col("__nonfinite") > 0, F.lit("nonfinite_adapter_cell"))
    )
    complete = F.col("error_code").isNull()

    def count_when_complete(name: str) -> Column:
        return F.when(complete, F.coalesce(F.col(name), F.lit(0)))

    return joined.withColumn("error_code", error).select(
        *scopes.columns,
        F.coalesce(F.col("responses"), F.lit(0)).alias("responses"),
        "decode_code",
        F.when(complete, F.lit("complete")).otherwise(F.lit("incomplete")).alias("probe_status"),
        "error_code",
        count_when_complete("adapter_rows").alias("adapter_rows"),
        count_when_complete("agreeing_cells").alias("agreeing_cells"),
        count_when_complete("differing_cells").alias("differing_cells"),
        (complete & F.coalesce(F.col("passed"), F.lit(False))).alias("passed"),
    )
